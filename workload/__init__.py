"""The registered queries, their inputs derived from the given tables, and their SQL twins."""
