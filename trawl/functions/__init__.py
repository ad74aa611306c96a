"""Column -> Column functions: text analysis, HTML cleaning, URLs."""
