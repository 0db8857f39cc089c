"""Operators and queries for preparing training data from a corpus."""
