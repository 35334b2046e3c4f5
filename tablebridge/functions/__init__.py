"""Column expressions for values and text forms."""
