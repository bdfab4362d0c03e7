"""Operators for text corpora: duplicates, packing, tokens, languages, pages, vectors, secrets."""
