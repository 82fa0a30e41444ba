"""Operators for preparing training text: archives, quality, duplicates, private data, leaks, packing."""
