"""Operators for training-data corpora: deduplication, tokens, mixing, scoring, vector search."""
