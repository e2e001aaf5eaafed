"""Column expressions."""
