"""Operators of a training-data pipeline: scoring, tokenizing, search, archives, extraction, dedup, filters, packing.

Nothing else in the package imports this subpackage. Every operator takes a
DataFrame and column names, reads only those columns (so extra or clashing
columns do no harm) and returns a new DataFrame.
"""
