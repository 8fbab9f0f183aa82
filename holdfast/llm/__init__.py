"""Operators of a training-data pipeline: cleaning, deduplication, decontamination, tokens."""
