"""Operators for building training corpora: dedup, filtering, search, mixing and counting."""
