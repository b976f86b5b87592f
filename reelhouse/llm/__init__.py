"""Operators for preparing training data: dedup, scans, tokenising, extraction, search, mixing, classifiers."""
