"""Top-k, slices and samples that come out the same in every run."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.functions.positions import PLACE, RANGE, sorted_ranges
from firmlens.functions.text import hash_fraction


def sample_fraction(rows: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of the key: no shuffle, no order."""
    return rows.filter(hash_fraction(F.col(key), seed) < fraction)


def sample_ids(rows: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """k random different keys."""
    ids = rows.select(key).distinct()
    return ids.orderBy(hash_fraction(F.col(key), seed), key).limit(k)


def slice_rows(rows: DataFrame, offset: int, length: int, *order: str | Column) -> DataFrame:
    """``length`` rows from the place ``offset`` on, in the given order.

    The rows are written in sorted ranges. Only the ranges that the slice meets are read
    again, and no task sees the rows before it.
    """
    if offset < 0 or length < 0:
        raise ValueError("a slice has a place and a length from 0 on")
    ranges = sorted_ranges(rows, *order)
    stop = offset + length
    met = ranges.sizes.filter((F.col("before") < stop) & (F.col("before") + F.col("n") > offset)).collect()
    if not met or not length:
        return ranges.rows.select(*rows.columns).limit(0)
    place, at = F.col(PLACE), F.col(RANGE)
    first, last = min(met, key=lambda r: r[RANGE]), max(met, key=lambda r: r[RANGE])
    own = ranges.rows.filter(at.between(first[RANGE], last[RANGE]))
    own = own.filter((at > first[RANGE]) | (place >= offset - first["before"]))
    own = own.filter((at < last[RANGE]) | (place < stop - last["before"]))
    return own.orderBy(RANGE, PLACE).select(*rows.columns)


def first_per_key(rows: DataFrame, keys: list[str], *order: str, k: int = 1) -> DataFrame:
    """Up to k rows per key in the given order.

    Spark cuts every key to k rows before the shuffle, so a hot key stays small.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__n", position).filter(F.col("__n") <= k).drop("__n")


def review_sample(labels: DataFrame, urls: DataFrame, per_category: int = 10, without: int = 40) -> DataFrame:
    """Firms to check by hand: some per category, no firm twice, and some with none.

    A firm belongs to its first category. ``labels`` is (id, category) with a null
    category for firms that have none; ``urls`` is (id, url).
    """
    own = labels.groupBy("id").agg(F.min("category").alias("category")).join(urls, "id")
    some = first_per_key(own.filter(F.col("category").isNotNull()), ["category"], "id", k=per_category)
    none = own.filter(F.col("category").isNull()).orderBy("id").limit(without)
    return some.unionByName(none.withColumn("category", F.lit("None"))).select("category", "id", "url")


def fill_quotas(edges: list[tuple], quota: int) -> dict:
    """Firms given to categories, as many as can be: ``{firm: category}`` from (firm, category)
    pairs in order. A firm that finds its categories full makes room by moving others on."""
    wanted: dict = {}
    for firm, category in edges:
        wanted.setdefault(firm, []).append(category)
    held: dict = {}
    given: dict = {}
    for firm in wanted:
        came: dict = {}  # category: the firm that asks for it
        queue = [firm]
        for asker in queue:
            for category in wanted[asker]:
                if category in came:
                    continue
                came[category] = asker
                own = held.setdefault(category, [])
                if len(own) < quota:  # room: everyone on the way moves on by one
                    while category is not None:
                        mover = came[category]
                        before = given.get(mover)
                        if before is not None:
                            held[before].remove(mover)
                        held[category].append(mover)
                        given[mover] = category
                        category = before
                    queue.clear()
                    break
                queue.extend(own)
            if not queue:
                break
    return given


def review_quotas(labels: DataFrame, urls: DataFrame, per_category: int = 10, without: int = 40) -> DataFrame:
    """As :func:`review_sample`, but a firm may stand for any of its categories, so that as
    many firms are chosen as the quotas allow.

    With c categories a best choice has at most ``per_category`` x c firms, so the first so
    many firms of each category hold one: a firm further back can be exchanged for a free
    one among them. Only these ``per_category`` x c x c pairs meet in one task.
    """
    pairs = labels.filter("id is not null").select("id", "category").distinct().join(urls.select("id").distinct(), "id")
    known = pairs.filter(F.col("category").isNotNull())
    count = known.select("category").distinct().count()
    first = first_per_key(known, ["category"], "id", k=max(1, per_category * count))

    def assign(batch: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(batch["id"], batch["category"], strict=True))
        return pd.DataFrame(list(fill_quotas(rows, per_category).items()), columns=["id", "category"])

    kinds = {n: t for n, t in labels.dtypes}
    chosen = first.withColumn("__all", F.lit(0)).groupBy("__all").applyInPandas(assign, f"id {kinds['id']}, category {kinds['category']}")
    own = urls.groupBy("id").agg(F.min("url").alias("url"))
    bare = pairs.groupBy("id").agg(F.max("category").alias("category")).filter("category is null").orderBy("id").limit(without)
    none = bare.select("id", F.lit("None").alias("category"))
    return chosen.unionByName(none).join(own, "id").select("category", "id", "url")
