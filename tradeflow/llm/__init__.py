"""Operators that prepare text corpora for training: sharding, mixing, filtering, deduplication, packing."""
