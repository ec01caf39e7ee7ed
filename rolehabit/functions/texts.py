"""Text helpers shared by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain(value: Column) -> Column:
    """A missing value becomes the empty text; double quotes are dropped."""
    return F.replace(F.coalesce(value, F.lit("")), F.lit('"'), F.lit(""))


def action_key(source: Column, name: Column) -> Column:
    return F.concat(source, F.lit(":"), name)


def service_of(action: Column) -> Column:
    return F.split_part(action, F.lit(":"), F.lit(1))


def has_segment(path: Column, segment: str) -> Column:
    """Whole-segment test: ``/x/`` matches, a name merely containing x does not."""
    return F.array_contains(F.split(path, "/"), segment)


def path_tail(path: Column) -> Column:
    return F.regexp_extract(path, r".*/(.*)", 1)


def is_listed(value: Column, names: Iterable[str]) -> Column:
    """Membership that is false, not NULL, for a missing value."""
    names = list(names)
    if not names:
        return F.lit(False)
    return F.coalesce(value.isin(names), F.lit(False))
