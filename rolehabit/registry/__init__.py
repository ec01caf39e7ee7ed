"""Named queries over the test tables, each with the SQL it must agree with."""

from rolehabit.registry import activity, alerts, baseline, inputs, streams  # noqa: F401
from rolehabit.registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
