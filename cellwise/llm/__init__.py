"""Operators for training data: language, quality, duplicates, contamination, mixing, tokens."""
