"""Column expressions: numbers, dates, business rules, text cells."""
