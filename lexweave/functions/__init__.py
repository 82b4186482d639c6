"""Column expressions: types, nested-value flattening, text."""
