"""Column expressions: parsing, cleaning and derived keys. All native, no UDFs."""
