"""Operators for preparing training data: scoring, packing, classifying, deduplicating, mixing.

Nothing else in the library imports this package. ``registry`` holds the registered queries.
"""
