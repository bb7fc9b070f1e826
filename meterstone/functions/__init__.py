"""Column expressions: text clean-up, dates, labels, bands."""
