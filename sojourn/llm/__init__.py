"""Operators of a training-data pipeline: scoring, packing, sharding, mixing, rules, search, deduplication."""
