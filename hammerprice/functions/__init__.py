"""Column expressions; no Python code runs per row."""
