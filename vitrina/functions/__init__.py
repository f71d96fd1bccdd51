"""Column expressions: text, numbers, dates and multi-valued dimensions."""
