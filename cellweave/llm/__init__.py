"""Operators for training-data corpora: extraction, identification, deduplication, encoding."""
