"""Operators for text corpora: filtering, fingerprints, duplicates, tokens, packing, archives."""
