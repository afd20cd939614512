"""Operators for preparing training text: quality, duplicates, mixing, extraction, language and output."""
