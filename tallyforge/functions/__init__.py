"""Column expressions: parsing, predicates and display labels."""
