"""Column functions: text, numbers, dates and business rules."""
