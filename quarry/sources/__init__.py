"""Readers for the raw extracts (sheet text, CSV, GeoJSON, seed) and the
adapters from the driver's test tables to the raw shapes."""
