"""Column expressions and SQL functions."""
