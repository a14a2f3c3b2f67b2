"""Column expressions and table functions."""
