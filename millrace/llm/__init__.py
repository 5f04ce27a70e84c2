"""Operators for preparing training text: deduplication, scoring, masking, mixing, packing, sharding, search."""
