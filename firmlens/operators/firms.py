"""From keyword hits to firm x category tables.

Hits have one row per keyword occurrence: ``id`` (firm), ``category``, ``keyword``.
Lists collected here hold at most one entry per category; publication lists, which
have no such bound, are split into parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_keywords(hits: DataFrame, *keys: str) -> DataFrame:
    """Occurrences ``n_kw`` and different keywords ``n_unique`` per key.

    Counting per keyword first lets a hot firm shrink before the shuffle and spreads
    what is left over its keywords.
    """
    keys = keys or ("id", "category")
    per_keyword = hits.groupBy(*keys, "keyword").agg(F.count("*").alias("n"))
    return per_keyword.groupBy(*keys).agg(
        F.sum("n").alias("n_kw"), F.count("keyword").alias("n_unique")
    )


def with_attributes(counts: DataFrame, firms: DataFrame) -> DataFrame:
    """Firm attributes added; firms without attributes drop out."""
    return counts.join(firms, "id")


def firm_flags(counts: DataFrame, *keys: str, **flags: Column) -> DataFrame:
    """One row per key with flags that hold if any of its rows has them.

    ``n_unique`` is read although every firm passes: the plan below then has the columns
    that counting per category needs too, and Spark computes the counts once for both.
    """
    rows = counts.groupBy(*keys).agg(
        *[F.bool_or(c).alias(n) for n, c in flags.items()], F.coalesce(F.max("n_unique"), F.lit(0)).alias("__n")
    )
    return rows.filter("__n >= 0").drop("__n")


def firms_with_n_unique(hits: DataFrame, thresh: int) -> DataFrame:
    """Per firm the sorted categories with at least ``thresh`` unique keywords."""
    return (
        unique_keywords(hits).filter(F.col("n_unique") >= thresh)
        .groupBy("id").agg(F.sort_array(F.collect_list("category")).alias("category"))
        .withColumn("n_unique", F.size("category").cast("long"))
    )


def firm_lists(counts: DataFrame, suffix: str) -> DataFrame:
    """Parallel lists per firm, in category order: ``cat_``, ``n_kw_``, ``n_unique_kw_`` + suffix."""
    entries = F.sort_array(F.collect_list(F.struct("category", "n_kw", "n_unique")))
    return counts.groupBy("id").agg(entries.alias("e")).select(
        "id",
        F.col("e.category").alias(f"cat_{suffix}"),
        F.col("e.n_kw").alias(f"n_kw_{suffix}"),
        F.col("e.n_unique").alias(f"n_unique_kw_{suffix}"),
    )


def firm_panel(firms: DataFrame, web: DataFrame, pat: DataFrame) -> DataFrame:
    """Firms that have web lists, with their patent lists where they have any.

    Firms found only in patents are not part of the panel.
    """
    return firms.join(web, "id").join(pat, "id", "left")


def panel_from_counts(firms: DataFrame, counts: DataFrame) -> DataFrame:
    """The same panel from one table of counts with a ``source`` column, read once."""
    def entries(source: str) -> Column:
        entry = F.when(F.col("source") == source, F.struct("category", "n_kw", "n_unique"))
        return F.sort_array(F.collect_list(entry)).alias(source)

    def columns(source: str) -> list[Column]:
        # Firms without entries have null lists, not empty ones.
        e = F.when(F.size(source) > 0, F.col(source))
        names = {"category": "cat", "n_kw": "n_kw", "n_unique": "n_unique_kw"}
        return [e.getField(f).alias(f"{n}_{source}") for f, n in names.items()]

    lists = counts.groupBy("id").agg(entries("web"), entries("pat")).filter(F.size("web") > 0)
    return firms.join(lists.select("id", *columns("web"), *columns("pat")), "id")


def panel_long(
    panel: DataFrame,
    source: str,
    canton: str | None = None,
    exclude_canton: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per firm and category of ``source``; a firm without any keeps one row of nulls.

    ``keep`` names firm columns to carry along.
    """
    if source not in ("web", "pat"):
        raise ValueError("source is 'web' or 'pat'")
    if canton is not None:
        panel = panel.filter(F.col("canton") == canton)
    if exclude_canton is not None:
        panel = panel.filter(F.col("canton") != exclude_canton)
    entries = F.arrays_zip(
        F.col(f"cat_{source}").alias("category"),
        F.col(f"n_kw_{source}").alias("n_kw"),
        F.col(f"n_unique_kw_{source}").alias("n_unique"),
    )
    return panel.select("id", *keep, F.inline_outer(entries))


def collect_parts(rows: DataFrame, key: str, value: str, max_items: int = 100_000) -> DataFrame:
    """Sorted list of ``value`` per ``key``, in parts of about ``max_items``.

    A key within the limit is one row, part 0. A larger one, the null key too, becomes
    several rows that together hold every value. Equal values of a key are in one part.
    """
    sizes = rows.groupBy(key).agg(F.count(value).alias("n"))
    parts = F.ceil(F.col("n") / max_items)
    large = sizes.filter(F.col("n") > max_items).select(F.col(key).alias("large_key"), parts.alias("parts"))
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(value), F.col("parts")))
    return (
        rows.join(large, F.col(key).eqNullSafe(F.col("large_key")), "left").withColumn("part", part.cast("long"))
        .groupBy(key, "part").agg(F.sort_array(F.collect_list(value)).alias(value))
    )


def publication_lists(publications: DataFrame, panel: DataFrame, max_items: int = 100_000) -> DataFrame:
    """Publications (``id``, ``publication``) listed per firm and joined to the firm table."""
    return panel.join(collect_parts(publications, "id", "publication", max_items), "id")


def applicants(patents: DataFrame, column: str = "applicants", separator: str = "; ") -> DataFrame:
    """One row per publication and applicant from a separated list."""
    names = F.split(F.col(column), rf"\Q{separator}\E")
    return patents.select("publication", F.explode_outer(names).alias("id"))


def firm_url(pages: DataFrame) -> DataFrame:
    """One url per firm: the smallest, so every run picks the same."""
    return pages.filter(F.col("url").cast("string") != "").groupBy("id").agg(F.min("url").alias("url"))
