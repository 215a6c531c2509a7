"""Reusable DataFrame operators: series, merge, normalisation, run books, checks."""
