"""Operators for training-data pipelines: text deduplication, cleaning, scoring and sharding."""
