"""Operators of a training-data pipeline: cleaning, scoring, deduplication, mixing, encoding."""
