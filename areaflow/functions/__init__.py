"""Column expressions: parsing and coercion, predicates and bands, ranking."""
