"""Operators for training-data pipelines: text quality, language, duplicates, packing, tokens."""
