"""Load stamping, table writes (append / full refresh / split), extracts."""
