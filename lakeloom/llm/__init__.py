"""Operators for training-data pipelines: extraction, filtering, near-duplicates, sharding, packing, tokenizing."""
