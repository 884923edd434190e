"""Operators of training-data pipelines: sharding, deduplication, scoring, packing."""
