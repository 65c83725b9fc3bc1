"""Operators of a training-data pipeline over documents and pages.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_*`` queries. Nothing else in the library imports this package.
"""
