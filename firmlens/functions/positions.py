"""Places of rows in a total order, without passing them through one task."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.sources.files import stored

RANGE, PLACE, TIE = "__range", "__place", "__tie"
#: ``monotonically_increasing_id`` holds the place in a partition in its lower bits.
PLACE_BITS = (1 << 33) - 1


class Ranges(NamedTuple):
    """Rows dealt to sorted ranges and written; ``sizes`` has one row for each range with
    the number of rows in it and ``before`` it."""

    rows: DataFrame
    sizes: DataFrame


def sorted_ranges(rows: DataFrame, *order: str | Column) -> Ranges:
    """``rows`` in sorted ranges, with their range and their place in it.

    Rows that are equal in ``order`` are told apart by their place in ``rows``, so that many
    equal rows still make several ranges. ``rows`` should be read from files: an order of
    arrival would differ when a lost task is run again.
    """
    told_apart = rows.withColumn(TIE, F.monotonically_increasing_id())
    keys = [*order, F.col(TIE)]
    dealt = told_apart.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)).alias(PLACE)
    placed = stored(dealt.select(*rows.columns, F.spark_partition_id().alias(RANGE), place), "ranges")
    earlier = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)  # over one row for each range
    sizes = placed.groupBy(RANGE).agg(F.count("*").alias("n"))
    return Ranges(placed, sizes.select(RANGE, "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))


def positioned(rows: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """``rows`` with their place in ``order``, from 0."""
    ranges = sorted_ranges(rows, *order)
    placed = ranges.rows.join(F.broadcast(ranges.sizes.drop("n")), RANGE)  # one row for each range
    return placed.select(*rows.columns, (F.col("before") + F.col(PLACE)).alias(name))
