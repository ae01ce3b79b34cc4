"""Column expressions: text, titles, labels, credits."""
