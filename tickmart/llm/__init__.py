"""Operators for large training corpora: packing, quality, archives, language, deduplication, search and tokens."""
