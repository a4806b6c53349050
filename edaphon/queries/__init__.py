"""Registered queries: each a Spark job over the given tables with its SQL beside it."""

from edaphon.queries import estimators, gold, ingest, scoring, silver, splits  # noqa: F401
from edaphon.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
