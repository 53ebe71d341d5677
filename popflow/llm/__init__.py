"""Operators of a training-data pipeline: scoring, extraction, filtering, deduplication, mixing."""
