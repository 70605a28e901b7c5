"""All queries of the library but those for training data."""

from millrace.plans import changes, commands, incremental, relations, roundtrips, scalars, sites, streams, web  # noqa: F401
from millrace.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
