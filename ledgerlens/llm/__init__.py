"""Operators for preparing training data: de-duplication, filtering, archives, tokens, packing."""
