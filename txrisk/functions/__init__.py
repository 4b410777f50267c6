"""Column expressions: parsing, rules and display formats."""
