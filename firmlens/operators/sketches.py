"""Approximate distinct counts that are kept, added up and asked again.

A sketch holds the different values of one group in a few kilobytes. Sketches of small
groups (a firm's category, a day's hits) are written once; any coarser grouping is a union
of them and needs no look at the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of a sketch's size. The relative standard error is about 1.04 / 2 ** (LOG / 2).
LOG = 14


def relative_error(deviations: float = 3.0, log: int = LOG) -> float:
    """The relative error that an estimate of a union stays within, for so many deviations."""
    return deviations * 1.04 / 2 ** (log / 2)


def distinct_sketches(rows: DataFrame, keys: Sequence[str], item: str, log: int = LOG) -> DataFrame:
    """``(*keys, sketch)``: a sketch of the different values of ``item`` in each group. Nulls
    are no values; a group of nulls only has an empty sketch. Partial before the shuffle."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(item).cast("string"), log).alias("sketch"))


def union_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups: ``keys`` are some of those they were made by, or none."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame, name: str = "n") -> DataFrame:
    """The sketches' numbers of different values in place of the sketches."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")
