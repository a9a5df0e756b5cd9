"""Operators for large training corpora; each module is one of them."""
