"""Operators for preparing training data: dedup, filtering, extraction, mixing, output."""
