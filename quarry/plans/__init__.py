"""Models as DataFrame -> DataFrame functions, and the whole run."""
