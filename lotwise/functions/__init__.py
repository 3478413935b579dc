"""Column expressions: text, labels, numbers and dates, web pages."""
