"""Operators of a training-data pipeline: formatting, filtering, deduplication, search and mixing.

Nothing else in the library imports this package.
"""
