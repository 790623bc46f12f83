"""Operators for training-data pipelines, one module each, and their registered queries.

Nothing else in the library imports this package.
"""
