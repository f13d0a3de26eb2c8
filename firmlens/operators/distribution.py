"""How keyword counts are distributed over firms and categories.

The input is ``unique_keywords``: one row per firm and category with ``n_kw`` and
``n_unique``. Curves for several thresholds come out of one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.sources.files import stored


def threshold_counts(counts: DataFrame, thresholds: Sequence[int], value: str = "n_unique") -> DataFrame:
    """Firms per category with at least t, for every t, in long form."""
    names = [f"at_least_{t}" for t in thresholds]
    wide = counts.groupBy("category").agg(
        *[F.count_if(F.col(value) >= t).alias(n) for t, n in zip(thresholds, names, strict=True)]
    )
    long = wide.unpivot(["category"], names, "threshold", "n_firms")
    return long.withColumn("threshold", F.substring_index("threshold", "_", -1).cast("long"))


def match_histogram(counts: DataFrame, *by: str, value: str = "n_kw") -> DataFrame:
    """Number of firms with exactly n matches, per ``by`` or overall."""
    return counts.groupBy(*by, value).agg(F.count("*").alias("n_firms"))


def survival_counts(panel: DataFrame, value: str = "n_kw") -> DataFrame:
    """Firms per (category, n) of a long panel; firms without a category are labelled."""
    return (
        panel.groupBy("category", value).agg(F.count("*").alias("n_firms"))
        .na.fill("No category", ["category"]).na.fill(0, [value])
    )


def survival_curve(counts: DataFrame, value: str = "n_unique") -> DataFrame:
    """Firms with at least n, per category: a falling curve over the values that occur."""
    at_least = W.partitionBy("category").orderBy(value).rowsBetween(W.currentRow, W.unboundedFollowing)
    histogram = match_histogram(counts, "category", value=value)
    return histogram.select(
        "category", value, F.sum("n_firms").over(at_least).alias("n_firms")
    )


def elbow_curve(counts: DataFrame, last: int, value: str = "n_unique") -> DataFrame:
    """(firm, category) pairs with at least t, for t = 1..last."""
    capped = F.least(F.col(value), F.lit(last))
    histogram = (
        counts.filter(F.col(value) >= 1).groupBy(capped.alias("threshold")).agg(F.count("*").alias("n"))
    )
    grid = counts.sparkSession.range(1, last + 1).withColumnRenamed("id", "threshold")
    # Capping puts at most ``last`` rows into this window.
    at_least = W.orderBy("threshold").rowsBetween(W.currentRow, W.unboundedFollowing)
    return grid.join(histogram, "threshold", "left").select(
        "threshold", F.coalesce(F.sum("n").over(at_least), F.lit(0)).alias("n_matches")
    )


def threshold_ratio(counts: DataFrame, loose: int, strict: int, value: str = "n_unique") -> DataFrame:
    """Pairs that survive the strict threshold as a share of those at the loose one."""
    n_strict, n_loose = (F.count_if(F.col(value) >= t) for t in (strict, loose))
    return counts.agg(
        n_loose.alias("n_loose"), n_strict.alias("n_strict"),
        F.try_divide(n_strict.cast("double"), n_loose).alias("ratio"),
    )


def category_cooccurrence(pairs: DataFrame, zeros: bool = False) -> DataFrame:
    """Firms active in both categories, for every ordered pair that has any; the diagonal is
    zero. ``zeros`` adds the pairs without firms, which grow with the square of the categories.

    ``pairs`` holds (id, category). Firms with the same set of categories are counted
    together first, so a set is compared with itself once however many firms share it.
    """
    sets = (
        pairs.filter(F.col("category").isNotNull()).distinct()
        .groupBy("id").agg(F.sort_array(F.collect_list("category")).alias("set"))
        .groupBy("set").agg(F.count("*").alias("n"))
    )
    found = (
        sets.select(F.explode("set").alias("category"), "set", "n")
        .select("category", F.explode("set").alias("other"), "n")
        .groupBy("category", "other").agg(F.sum("n").alias("n"))
    )
    if zeros:
        # Every category is paired with itself, so the diagonal is the axis.
        axis = found.filter(F.col("category") == F.col("other")).select("category")
        names = axis.agg(F.collect_list("category").alias("names")).scalar()
        grid = axis.withColumn("other", F.explode(names))
        found = grid.join(found, ["category", "other"], "left")
    n_firms = F.when(F.col("category") == F.col("other"), 0).otherwise(F.coalesce("n", F.lit(0)))
    return found.select("category", "other", n_firms.alias("n_firms"))


def rank_keywords(hits: DataFrame) -> DataFrame:
    """Keywords with the rank of their count; equally frequent keywords share a rank."""
    counts = hits.groupBy("keyword").agg(F.count("*").alias("n"))
    # One row per different count: far fewer than keywords, and no more than the dictionary.
    tiers = counts.select("n").distinct().select("n", F.row_number().over(W.orderBy(F.desc("n"))).alias("rank"))
    return counts.join(tiers, "n").select("keyword", "n", F.col("rank").cast("long").alias("rank"))


def top_categories(counts: DataFrame, k: int, weight: Column | None = None) -> DataFrame:
    """The k categories with most rows of ``counts`` (or most ``weight``)."""
    total = F.count("*") if weight is None else F.sum(weight)
    return counts.groupBy("category").agg(total.alias("n")).orderBy(F.desc("n"), "category").limit(k)


def category_drilldown(counts: DataFrame, urls: DataFrame, category: str, thresh: int) -> DataFrame:
    """Firms of one category at a threshold with their url, fewest keywords first."""
    found = counts.filter((F.col("category") == category) & (F.col("n_unique") >= thresh))
    return found.join(urls, "id").orderBy("n_unique", "id")


def equal_width_bins(values: DataFrame, column: str, n_bins: int) -> DataFrame:
    """Count per bin between the smallest and largest value; the last bin is closed."""
    counted = values.groupBy(column).agg(F.count("*").alias("n")).filter(F.col(column).isNotNull())
    span = counted.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("span")).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    half = F.when(lo == hi, 0.5).otherwise(0.0)
    lo, hi = lo - half, hi + half
    width = (hi - lo) / n_bins
    raw = F.floor((F.col(column) - lo) / width) + 1
    # Division can land one bin off an edge; the edges decide.
    raw = F.when(F.col(column) < lo + (raw - 1) * width, raw - 1).when(
        F.col(column) >= lo + raw * width, raw + 1).otherwise(raw)
    bin_no = F.greatest(F.lit(1), F.least(raw, F.lit(n_bins))).cast("long")
    return counted.groupBy(bin_no.alias("bin")).agg(F.sum("n").alias("n"))


def describe(values: DataFrame, column: str) -> DataFrame:
    """Count, nulls, mean, sample deviation, extremes and nearest-rank quartiles in one row.

    Equal values are counted together, the different ones sorted in ranges and written.
    A value's rank is its place in its range and the size of the ranges before, of which
    there is one row each.
    """
    counted = values.groupBy(column).agg(F.count("*").alias("n"))
    ranges = counted.repartitionByRange(F.col(column)).withColumn("range", F.spark_partition_id())
    counted = stored(ranges, "values")
    v, up_to = F.col(column), F.col("up_to")
    n = F.when(v.isNotNull(), F.col("n")).otherwise(0)
    total = F.sum(n)
    # Totals first: the deviation is taken around the mean to stay accurate for close values.
    first = counted.agg(
        F.struct(total.alias("n"), (F.sum("n") - total).alias("nulls"), F.try_divide(F.sum(v * n), total).alias("mean"))
    ).scalar()
    n_all, centre = first.getField("n"), first.getField("mean")
    sizes = counted.groupBy("range").agg(total.alias("size"))
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.sum(n).over(W.partitionBy("range").orderBy(column))
    placed = counted.join(sizes, "range").withColumn("up_to", place)

    def quartile(q: float) -> Column:
        rank = F.round(F.lit(q) * (n_all - 1)).cast("long") + 1
        return F.min(F.when(up_to >= rank, v))

    return placed.agg(
        F.coalesce(total, F.lit(0)).alias("count"),
        F.coalesce(first.getField("nulls"), F.lit(0)).alias("null_count"), centre.alias("mean"),
        F.sqrt(F.try_divide(F.sum((v - centre) * (v - centre) * n), total - 1)).alias("std"),
        F.min(v).alias("min"), quartile(0.25).alias("p25"), quartile(0.5).alias("p50"),
        quartile(0.75).alias("p75"), F.max(v).alias("max"),
    )
