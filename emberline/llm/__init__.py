"""Operators for preparing training data: search, deduplication, scoring, filtering and packing of documents."""
