"""Operators of a training-data pipeline: deduplication, filters, scoring and tokenisation of text tables."""
