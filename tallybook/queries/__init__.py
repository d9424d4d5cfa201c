"""The operators run on the given tables, each next to the same result in SQL."""

from tallybook.queries import completeness, duplicates, extensions, groups, inventory, pairing, sources  # noqa: F401
from tallybook.queries.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
