"""Column functions: text, parsing, rates, dates and test statistics."""
