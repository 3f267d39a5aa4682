"""Operators of a training-data pipeline (archive, filters, deduplication, mixing, packing)."""
