"""Column expressions: text, numbers, dates, JSON and messages."""
