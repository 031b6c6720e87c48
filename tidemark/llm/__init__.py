"""Operators of a training-data pipeline: filters, dedupe, scans, token counts, packing.

Nothing else in the package imports this subpackage; it may import the general helpers.
``registry`` holds the registered queries and their SQL.
"""
