"""All registered queries, by name."""

from strikelake.queries import files, layers, legacy, research  # noqa: F401  (registration)
from strikelake.queries.registry import QUERIES as ALL

__all__ = ["ALL"]
