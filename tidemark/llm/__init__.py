"""Operators for training-data pipelines: quality, tokens, duplicates, privacy, mixing, packing.

Nothing outside this subpackage imports it.
"""
