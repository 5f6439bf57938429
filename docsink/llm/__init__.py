"""Operators for preparing training text: quality, safety, duplicates, leakage, extraction, packing."""
