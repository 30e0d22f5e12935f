"""Corpus operators for training data: quality, duplicates, mixing, packing, web pages."""
