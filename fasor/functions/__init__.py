"""Column functions. All are native expressions: no Python runs per row."""
