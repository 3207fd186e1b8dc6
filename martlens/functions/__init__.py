"""Column expressions: amounts, calendar, reusable fields and filters, vocabulary."""
