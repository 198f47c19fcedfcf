"""Column expressions, row predicates and schema helpers."""
