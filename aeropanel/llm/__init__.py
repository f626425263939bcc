"""Operators for preparing training data: filters, near copies, contamination, mixing, tokens, pages and vectors."""
