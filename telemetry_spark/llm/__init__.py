"""Operators for training data: text scoring, extraction, deduplication, search, packing and sharding of corpora."""
