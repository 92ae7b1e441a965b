"""The registered queries: two-sided data derived from the given tables, and their SQL twins."""
