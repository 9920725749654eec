"""Corpus operators for training-data pipelines: counting, filtering, deduplication, packing, mixing, search."""
