"""Operators of a training-data pipeline: search, deduplication, decontamination, packing, scoring."""
