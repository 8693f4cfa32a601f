"""Operators for preparing training corpora.

Nothing else in the library imports this package; ``llm.queries`` holds the
driver queries of these operators and their DuckDB statements.
"""
