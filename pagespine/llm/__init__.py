"""Operators that prepare training text: scans, deduplication, packing, archives."""
