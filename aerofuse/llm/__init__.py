"""Operators for preparing training text: fingerprints, language, duplicates, leaks, packing, tokens, filters."""
