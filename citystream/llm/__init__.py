"""Operators of a training-data pipeline: cleaning, deduplication, safety, mixing and search."""
