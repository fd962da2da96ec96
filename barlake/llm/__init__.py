"""Operators for large training corpora: search, sharding, filters, token output, packing, duplicates."""
