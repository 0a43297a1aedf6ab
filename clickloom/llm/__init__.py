"""Operators of a training-data pipeline: sharding, filters, duplicates, tokens, privacy."""
