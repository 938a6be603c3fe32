"""Column expressions: object keys, status classes, coercions."""
