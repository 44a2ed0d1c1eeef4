"""Column functions: pure expressions, no action, no Python UDF."""
