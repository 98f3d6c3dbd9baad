"""Operators of a training-data pipeline: extraction, deduplication, decontamination, formatting, tokens, sharding."""
