"""Helpers for the open metric and tag maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entry(map_col: Column | str, key: str) -> Column:
    """Value at `key`, NULL when absent."""
    return F.try_element_at(map_col, F.lit(key))


def rendered(map_col: Column | str, separator: str = " · ") -> Column:
    """`k=v` pairs in key order."""
    pairs = F.array_sort(F.map_entries(map_col))
    return F.array_join(
        F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))),
        separator,
    )


def without_nulls(map_col: Column) -> Column:
    return F.map_filter(map_col, lambda _, v: v.isNotNull())
