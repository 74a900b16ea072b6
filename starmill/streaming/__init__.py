"""Incremental counterparts of the batch plans."""
