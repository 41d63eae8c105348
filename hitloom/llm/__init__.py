"""Operators for preparing text corpora at scale (deduplication, filters, tokens, mixing)."""
