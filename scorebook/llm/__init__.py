"""Operators for preparing training data: extraction, formatting, filtering, deduplication, mixing and packing."""
