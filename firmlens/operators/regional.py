"""Regional specialisation: a category's share in one region against the rest.

Three variants differ only in what the shares are taken of. Input is one row per
firm and category with ``canton`` and ``n_unique``; a null canton is on neither side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.functions.sets import share
from firmlens.operators.firms import firm_flags

RATED = ["count_region", "count_rest", "percent_region", "percent_rest", "ratio", "log_rta"]


def _side(canton: str) -> tuple[Column, Column]:
    return F.col("canton") == canton, F.col("canton") != canton


def _with_ratio(counts: DataFrame, n_region: Column, n_rest: Column) -> DataFrame:
    percent_region = share(F.col("count_region"), n_region)
    percent_rest = share(F.col("count_rest"), n_rest)
    ratio = F.try_divide(F.col("percent_region"), F.col("percent_rest"))
    return (
        counts.withColumn("percent_region", percent_region).withColumn("percent_rest", percent_rest)
        .withColumn("ratio", ratio).withColumn("log_rta", F.log10("ratio"))
    )


def _category_counts(counts: DataFrame, canton: str, thresh: int) -> DataFrame:
    """Firms per category on both sides; categories missing on a side drop out."""
    inside, outside = _side(canton)
    enough = F.col("n_unique") >= thresh
    return (
        counts.groupBy("category")
        .agg(F.count_if(enough & inside).alias("count_region"), F.count_if(enough & outside).alias("count_rest"))
        .filter("count_region > 0 AND count_rest > 0")
    )


def rta_share_of_hits(counts: DataFrame, canton: str, thresh: int, min_count: int = 0) -> DataFrame:
    """Shares of all (firm, category) pairs over the threshold."""
    both = _category_counts(counts, canton, thresh)
    every = W.partitionBy()  # one row per category
    rated = _with_ratio(both, F.sum("count_region").over(every), F.sum("count_rest").over(every))
    return rated.filter(F.col("count_region") > min_count)


def rta_share_of_firms(counts: DataFrame, canton: str, thresh: int, min_count: int = 0) -> DataFrame:
    """Shares of the firms of each side, counted before the threshold."""
    inside, outside = _side(canton)
    firms = firm_flags(counts, "id", region=inside, rest=outside)
    totals = firms.agg(F.struct(F.count_if("region").alias("region"), F.count_if("rest").alias("rest"))).scalar()
    rated = _with_ratio(
        _category_counts(counts, canton, thresh), totals.getField("region"), totals.getField("rest")
    )
    return rated.filter(F.col("count_region") > min_count)


def category_shares(panel: DataFrame, thresh: int | None = None) -> DataFrame:
    """Share of the rows of a long panel per category; rows without a category count below the line."""
    n_rows = panel.agg(F.count("*")).scalar()
    kept = panel if thresh is None else panel.filter(F.col("n_unique") >= thresh)
    counted = kept.groupBy("category").agg(F.count("*").alias("n_firms"))
    return counted.withColumn("percent", share(F.col("n_firms"), n_rows))


def _row_counts(panel: DataFrame, canton: str, thresh: int) -> DataFrame:
    """Firms over the threshold per category, and all rows, for the region, the rest and everywhere.

    The totals add up the same per-category counts, so the panel is read once.
    """
    enough = F.col("n_unique") >= thresh
    inside, outside = _side(canton)
    sides = {"region": inside, "rest": outside, "all": F.lit(True)}
    counts = panel.groupBy("category").agg(
        *[F.count_if(enough & c).alias(f"count_{n}") for n, c in sides.items()],
        *[F.count_if(c).alias(f"rows_{n}") for n, c in sides.items()],
    )
    # One row per category meets in this window.
    counts = counts.select("*", *[F.sum(f"rows_{n}").over(W.partitionBy()).alias(f"total_{n}") for n in sides])
    return counts.filter(F.col("category").isNotNull())


def rta_share_of_rows(panel: DataFrame, canton: str, thresh: int) -> DataFrame:
    """Shares of the rows of a long panel with ``canton``, rows without a category included."""
    both = _row_counts(panel, canton, thresh).filter("count_region > 0 AND count_rest > 0")
    rated = _with_ratio(both, F.col("total_region"), F.col("total_rest"))
    return rated.select("category", *RATED)


def region_report(panel: DataFrame, canton: str, thresh: int) -> DataFrame:
    """Firms, percent and ratio to the whole country per category of a region."""
    counts = _row_counts(panel, canton, thresh)
    percent = share(F.col("count_region"), F.col("total_region"))
    ratio = F.try_divide(percent, share(F.col("count_all"), F.col("total_all")))
    report = counts.filter("count_region > 0").select(
        "category", F.col("count_region").alias("n_firms"), percent.alias("percent"), ratio.alias("ratio")
    )
    return report.orderBy(F.desc_nulls_last("ratio"), "category")


def rta_by_source(counts: DataFrame, canton: str, thresh: int) -> DataFrame:
    """The firm-share variant for patents and, with suffix ``_web``, websites, side by side.

    ``counts`` has a ``source`` column; both sources are rated in one pass.
    """
    inside, outside = _side(canton)
    enough = F.col("n_unique") >= thresh
    cells = counts.groupBy("source", "category").agg(
        F.count_if(enough & inside).alias("count_region"), F.count_if(enough & outside).alias("count_rest")
    ).filter("count_region > 0 AND count_rest > 0")
    firms = firm_flags(counts, "source", "id", region=inside, rest=outside)
    totals = firms.groupBy("source").agg(F.count_if("region").alias("n_region"), F.count_if("rest").alias("n_rest"))
    rated = _with_ratio(cells.join(totals, "source"), F.col("n_region"), F.col("n_rest"))
    side_by_side = rated.groupBy("category").agg(*[
        F.max(F.when(F.col("source") == source, F.col(v))).alias(v + suffix)
        for source, suffix in (("pat", ""), ("web", "_web")) for v in RATED
    ])
    return side_by_side.filter("count_region IS NOT NULL AND count_region_web IS NOT NULL")


def rta_all_regions(counts: DataFrame, thresh: int) -> DataFrame:
    """The firm-share variant for every region at once, each against all others."""
    enough = counts.filter((F.col("n_unique") >= thresh) & F.col("canton").isNotNull())
    cells = enough.groupBy("canton", "category").agg(F.count("*").alias("count_region"))
    # One row per region meets in this window.
    count_all = F.sum("count_region").over(W.partitionBy("category"))
    firms = firm_flags(counts.filter(F.col("canton").isNotNull()), "id", "canton")
    per_region = firms.groupBy("canton").agg(F.count("*").alias("n_region"))
    n_all = per_region.agg(F.sum("n_region")).scalar()
    cells = cells.withColumn("count_rest", count_all - F.col("count_region"))
    joined = cells.join(per_region, "canton").select(
        "canton", "category", "count_region", "count_rest",
        "n_region", (n_all - F.col("n_region")).alias("n_rest"),
    )
    rated = _with_ratio(joined.filter("count_rest > 0"), F.col("n_region"), F.col("n_rest"))
    return rated.drop("n_region", "n_rest")
