"""Expressions over array columns used as sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def n_items(items: Column) -> Column:
    return F.size(items).cast("long")


def n_common(a: Column, b: Column) -> Column:
    return n_items(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """Common items over all items; null when both sets are empty."""
    return share(n_common(a, b), n_items(F.array_union(a, b)))


def same_set(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_distinct(a)) == F.sort_array(F.array_distinct(b))
