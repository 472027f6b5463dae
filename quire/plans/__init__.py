"""Whole jobs: embed a snapshot, build or extend an index, search in batches."""
