"""Column -> Column scalar functions: dates, numbers, text."""
