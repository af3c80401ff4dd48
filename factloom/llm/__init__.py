"""Operators for preparing training data. Nothing else in the library imports this subpackage."""

from factloom.llm.catalogue import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
