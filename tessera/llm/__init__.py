"""Operators of a training-data pipeline: filters, dedup, mixing, packing, scores."""
