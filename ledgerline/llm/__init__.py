"""Operators for preparing large language-model training data.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered queries and, where SQL can express them, their DuckDB statements.
"""
