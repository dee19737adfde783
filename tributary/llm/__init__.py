"""Operators for training data: scans, scoring, tokens, packing, search, extraction and joins on text."""
