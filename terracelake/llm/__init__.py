"""Operators that prepare training text: packing, deduplication, tokens, search, filters."""
