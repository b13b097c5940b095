"""Column expressions: casts from text, masks, times."""
