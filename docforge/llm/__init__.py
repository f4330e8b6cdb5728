"""Operators for training-data pipelines (dedup, extraction, quality, tokens, sharding).

Nothing outside this subpackage imports it; it can be removed as a whole.
"""
