"""Operators for preparing training text: deduplication, language, scoring, mixing, filters."""
