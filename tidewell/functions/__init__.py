"""Column expressions: type mapping, value conversion, temporal text, keys."""
