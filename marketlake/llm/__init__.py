"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; it imports general helpers
only.  One module per operator, ``queries.py`` holds the registered queries and
their DuckDB oracles.
"""
