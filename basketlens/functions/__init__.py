"""Column expressions: casts, keys, calendar parts, scores and tail probabilities."""
