"""Column functions: numbers, dates, printed text."""
