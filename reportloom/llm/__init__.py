"""Operators for preparing training text: quality, personal data, duplicates, tokens, toxicity."""
