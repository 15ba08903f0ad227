"""Column expressions: text, money, dates and exact ratios."""
