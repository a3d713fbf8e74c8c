"""Operators of a training-data pipeline: one module per operator.

Nothing else in the library imports this subpackage; ``queries.py`` holds
its registered queries and their DuckDB statements.
"""
