"""Operators for large training-text corpora, one module per operator.

Nothing else in the library imports this package; ``queries`` registers the
``opN_*`` queries and their DuckDB twins.
"""
