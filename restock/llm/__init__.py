"""Operators of a training-data pipeline: filtering, deduplication,
decontamination, scoring, tokenising and formatting of text tables."""
