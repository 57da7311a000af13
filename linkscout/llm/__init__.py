"""Operators that prepare training text: quality, reputation, decontamination, deduplication, mixing, secrets, HTML, WARC."""
