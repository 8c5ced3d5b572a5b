"""Corpus operators for training data: deduplication, quality, language,
tokens, packing and search."""
