"""Principal components of wide rows by a randomised range finder.

A few random directions are sent through the rows and back again and again, until they span
the directions of most variance. Each task multiplies its own rows; Spark adds up what comes
back, one row for each column. No matrix of columns by columns is made, and the driver solves
for a few directions only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.sources.files import stored

#: Directions beside those asked for, and passes over the rows. With as many directions as
#: columns the result is exact.
EXTRA, ROUNDS = 10, 4


class Components(NamedTuple):
    """The mean row, the axes (one column each, of length 1, their largest entry positive) and
    each axis' share of the variance."""

    mean: np.ndarray
    axes: np.ndarray
    explained: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if len(column) and len(values) % len(column):
        raise ValueError("rows must be of one length")
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _added(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``work``'s matrices over all batches. A task adds up its own and sends its rows
    by number; what reaches the driver is one matrix of this shape."""
    n, width = shape
    names = [f"c{i}" for i in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column(0)))
        columns = [pa.array(np.arange(n)), *[pa.array(total[:, i].copy()) for i in range(width)]]
        yield pa.RecordBatch.from_arrays(columns, ["j", *names])

    parts = rows.mapInArrow(add, ", ".join(["j long", *[f"{c} double" for c in names]]))
    out = np.zeros(shape)
    for r in parts.groupBy("j").agg(*[F.sum(c) for c in names]).collect():
        out[r[0]] = r[1:]
    return out


def principal_components(rows: DataFrame, k: int, vector: str = "sims", extra: int = EXTRA, rounds: int = ROUNDS, seed: int = 0) -> Components:
    """The first ``k`` components of the vectors, which are of one length. Null vectors take
    no part. ``rows`` is read ``rounds`` + 2 times; give it from files. A component of no
    variance is any direction at right angles to the others."""
    known = rows.filter(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>").alias("x"))
    first = known.select(F.size("x")).first()
    if first is None or not first[0]:
        raise ValueError("components need rows with columns")
    width = first[0]
    size = min(width, k + extra)
    sums = _added(known, lambda a: np.column_stack([a.sum(0), (a * a).sum(0), np.full(a.shape[1], len(a))]), (width, 3))
    n, mean = sums[0, 2], sums[:, 0] / sums[0, 2]
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
    for _ in range(rounds if size < width else 0):

        def through(a: np.ndarray, basis: np.ndarray = basis) -> np.ndarray:
            own = a - mean
            return own.T @ (own @ basis)

        basis = np.linalg.qr(_added(known, through, (width, size)))[0]

    def gram(a: np.ndarray) -> np.ndarray:
        own = (a - mean) @ basis
        return np.column_stack([own.T @ own, np.full(size, ((a - mean) ** 2).sum())])

    found = _added(known, gram, (size, size + 1))
    value, turn = np.linalg.eigh(found[:, :size])
    order = np.argsort(-value, kind="stable")[:k]
    axes = basis @ turn[:, order]
    axes *= np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1, 1)
    total = found[0, size] if n > 1 else 0.0
    return Components(mean, axes, np.maximum(value[order], 0) / total if total > 0 else np.zeros(len(order)))


def projected(vector: str, components: Components) -> Column:
    """A row's scores on the axes, as an array; null for a null vector."""
    mean, axes = components.mean, components.axes

    @F.arrow_udf("array<double>")
    def scores(batch: pa.Array) -> pa.Array:
        known = batch.drop_null()
        found = (_matrix(known) - mean) @ axes if len(known) else np.zeros((0, axes.shape[1]))
        present = batch.is_valid().to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(present * axes.shape[1])]).astype("int32"), mask=np.append(~present, False))
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))

    return scores.asNondeterministic()(F.col(vector).cast("array<double>"))


def component_scores(sims: DataFrame, key: str, k: int, scores: int = 2, vector: str = "sims") -> DataFrame:
    """``(key, pc1 ..., explained)``: scores on the first components and the variance share of
    each of ``k``. The rows are written first, so that what makes them runs once."""
    rows = stored(sims.filter(F.col(vector).isNotNull()).select(key, vector), "components")
    found = principal_components(rows, k, vector)
    own = rows.select(key, projected(vector, found).alias("p"))
    explained = F.array(*[F.lit(float(v)) for v in found.explained])
    return own.select(key, *[F.col("p")[i].alias(f"pc{i + 1}") for i in range(min(scores, len(found.explained)))], explained.alias("explained"))
