"""Operators for large text corpora: cleaning, deduplication, scoring, sharding, tokens."""
