"""Operators for training-data pipelines: filters, deduplication, search, chat, packing and sharding of text tables.

Nothing else in the library imports this package.
"""
