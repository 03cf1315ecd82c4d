"""Lists as native columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def union_ignoring_case(ordered: Column) -> Column:
    """Each element once, letter case ignored; the first spelling in the order of the list stays."""
    keys = F.transform(ordered, F.lower)
    return F.filter(F.transform(ordered, lambda x, i: F.when(F.array_position(keys, F.lower(x)) == i + 1, x)), lambda x: x.isNotNull())


def append_once(a: Column, v: Column) -> Column:
    return F.when(F.array_contains(a, v), a).otherwise(F.array_append(a, v))


def lower_set(a: Column) -> Column:
    return F.array_distinct(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.trim(F.lower(x))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two sets of texts, letter case and outer spaces ignored; null if both are empty."""
    x, y = lower_set(a), lower_set(b)
    n = F.size(F.array_union(x, y))
    return F.when(n > 0, F.size(F.array_intersect(x, y)) / n)
