"""Column-level helpers: time windows relative to ``as_of``, text extraction, ratios."""
