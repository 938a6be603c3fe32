"""Operators for preparing training text: scans, scores, near duplicates, packing, sharding, search."""
