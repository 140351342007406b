"""Column expressions: keys and dates."""
