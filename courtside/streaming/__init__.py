"""Structured Streaming drivers for the incremental form of the index operators.

The reference runs in batch only; these drivers apply the same operators to
documents that arrive as files, so an index can be kept up to date without a
full rebuild.
"""
