"""Operators for training-data pipelines: scans, near duplicates, sharding, packing, filters."""
