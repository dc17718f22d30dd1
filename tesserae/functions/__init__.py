"""Column expressions: text, URLs, dates and languages."""
