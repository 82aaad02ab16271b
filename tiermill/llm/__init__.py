"""Operators for training-data pipelines: deduplication, filters, archives, search and packing."""
