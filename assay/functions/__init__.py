"""Column expressions: text, dates and geography."""
