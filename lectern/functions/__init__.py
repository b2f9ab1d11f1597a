"""Column expressions without UDFs."""
