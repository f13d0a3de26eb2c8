"""Aggregates at many thresholds from one pass.

A row counts at every threshold up to its level. So rows are aggregated once per step
between thresholds, and the states of the steps are merged from the highest down.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.sources.files import stored


class Measure(NamedTuple):
    """An aggregate of a caller: how a value's states are made, merged and read."""

    kind: str
    column: str | None = None


def rows() -> Measure:
    return Measure("rows")


def total(column: str) -> Measure:
    return Measure("total", column)


def mean(column: str) -> Measure:
    return Measure("mean", column)


def least(column: str) -> Measure:
    return Measure("least", column)


def greatest(column: str) -> Measure:
    return Measure("greatest", column)


def different(column: str) -> Measure:
    """The number of different values that aren't null."""
    return Measure("different", column)


#: Merging of the states named; a mean has two.
MERGES = {"rows": F.sum, "total": F.sum, "least": F.min, "greatest": F.max, "count": F.sum}


def _states(measures: dict[str, Measure]) -> dict[str, tuple[str, Column]]:
    """Name, merge and first value of each state that isn't a distinct count."""
    out: dict[str, tuple[str, Column]] = {}
    for name, (kind, column) in measures.items():
        if kind == "rows":
            out[name] = ("rows", F.count("*"))
        elif kind in ("total", "mean"):
            out[name] = ("total", F.sum(column))
        elif kind in ("least", "greatest"):
            out[name] = (kind, {"least": F.min, "greatest": F.max}[kind](column))
        if kind == "mean":
            out[f"{name}__n"] = ("count", F.count(column))
    return out


def sweep(table: DataFrame, level: str, thresholds: Sequence[float], by: Sequence[str] = (), **measures: Measure) -> DataFrame:
    """``(threshold, *by, *measures)``: each measure over the rows whose ``level`` is at least the
    threshold, as one run for each threshold would give it.

    A group without a row at a threshold has no line there. Rows with a null level count
    nowhere. The table is read once. A value of a distinct count is counted at its highest
    step only, and so once at every threshold below; what is written has a row for each
    group, step and combination of such values.
    """
    steps = sorted(set(thresholds))
    if not steps or not measures:
        raise ValueError("a sweep has thresholds and measures")
    step = sum([(F.col(level) >= F.lit(v)).cast("int") for v in steps], F.lit(0)).alias("__step")
    items = list(dict.fromkeys(m.column for m in measures.values() if m.kind == "different"))
    states = _states(measures)
    keys = [F.col(c) for c in by]
    first = [value.alias(f"__{name}") for name, (_, value) in states.items()]
    known = table.withColumn("__step", step).filter("__step > 0")
    partial = known.groupBy(*keys, "__step", *[F.col(c).alias(f"__item_{c}") for c in items]).agg(F.count("*").alias("__present"), *first)
    if items:
        partial = stored(partial, "sweep")
    merged = [MERGES[kind](f"__{name}").alias(f"__{name}") for name, (kind, _) in states.items()]
    found = partial.groupBy(*by, "__step").agg(F.sum("__present").alias("__present"), *merged)
    for c in items:
        highest = partial.filter(F.col(f"__item_{c}").isNotNull()).groupBy(*by, f"__item_{c}").agg(F.max("__step").alias("__step"))
        found = found.unionByName(highest.groupBy(*by, "__step").agg(F.count("*").alias(f"__different_{c}")), allowMissingColumns=True)
    # From here on there are at most as many rows as groups times thresholds.
    columns = ["__present", *[f"__{name}" for name in states], *[f"__different_{c}" for c in items]]
    merge = {"__present": F.sum} | {f"__{name}": MERGES[kind] for name, (kind, _) in states.items()} | {f"__different_{c}": F.sum for c in items}
    one = found.groupBy(*by, "__step").agg(*[merge[c](c).alias(c) for c in columns])
    tops = one.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by]).agg(F.max("__step").alias("__top"))
    lines = tops.select("*", F.explode(F.sequence(F.lit(1), "__top")).alias("__at"))
    same = F.col("__at") == F.col("__step")
    for c in by:
        same &= F.col(f"__by_{c}").eqNullSafe(F.col(c))
    filled = lines.join(one, same, "left").select(*[F.col(f"__by_{c}").alias(c) for c in by], F.col("__at").alias("__step"), *columns)
    down = W.partitionBy(*by).orderBy(F.desc("__step")).rowsBetween(W.unboundedPreceding, W.currentRow)
    over = {c: merge[c](c).over(down) for c in columns}

    def read(name: str, measure: Measure) -> Column:
        if measure.kind == "mean":
            return F.try_divide(over[f"__{name}"], over[f"__{name}__n"])
        if measure.kind == "different":
            return F.coalesce(over[f"__different_{measure.column}"], F.lit(0))
        return over[f"__{name}"]

    at = F.element_at(F.array(*[F.lit(v) for v in steps]), F.col("__step")).alias("threshold")
    return filled.select(at, *by, *[read(name, m).alias(name) for name, m in measures.items()])
