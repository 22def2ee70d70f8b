"""Operators for building training data: deduplication, privacy, filtering, tokens and packing."""
