"""Operators of a training-data pipeline: deduplication, filters, classifiers, token files, packing, mixing.

Nothing else in the library imports this package.
"""
