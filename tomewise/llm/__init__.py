"""Operators of a training-data pipeline: language, toxicity, duplicates, private data, packing and more."""
