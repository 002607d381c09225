"""Operators of a training-data pipeline, each with the query that applies it to its whole table."""

from strikelake.llm.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
