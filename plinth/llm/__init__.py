"""Corpus preparation: deduplication, filtering, mixing and packing of training documents."""
