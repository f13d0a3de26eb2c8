"""Embedding similarity between pages and category labels.

A label table is small (one row per category). It is read once, checked against
``MAX_LABELS`` and sent to the tasks as a matrix; pages keep their key and are never
shuffled: similarities are one array per row, in label order.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.functions.text import words
from firmlens.operators.components import component_scores
from firmlens.sources.files import stored

MAX_LABELS = 10_000
UNKNOWN = "unknown"


class Labels(NamedTuple):
    """Label names in order and their unit vectors, one row each."""

    names: list[str]
    matrix: np.ndarray


def read_labels(table: DataFrame, name: str = "label", vector: str = "embedding") -> Labels:
    """Collect a label table of at most ``MAX_LABELS`` rows, ordered by name."""
    rows = table.select(F.col(name).cast("string"), vector).limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: see label_blocks")
    rows = sorted(rows, key=lambda r: r[0])
    matrix = np.array([r[1] for r in rows], dtype="float64").reshape(len(rows), -1)
    return Labels([r[0] for r in rows], unit_rows(matrix))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def similarity(vector: str | Column, labels: Labels) -> Column:
    """Cosine of a vector column with every label, as one array in label order."""
    matrix = labels.matrix
    n_labels, width = matrix.shape

    @F.arrow_udf("array<double>")
    def cosines(batch: pa.Array) -> pa.Array:
        known = batch.drop_null()
        values = known.flatten().to_numpy(zero_copy_only=False).astype("float64")
        if len(values) != len(known) * width:
            raise ValueError(f"vectors must have {width} entries")
        result = unit_rows(values.reshape(len(known), width)) @ matrix.T
        present = batch.is_valid().to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(present * n_labels)]).astype("int32")
        starts = pa.array(offsets, mask=np.append(~present, False))
        return pa.ListArray.from_arrays(starts, pa.array(result.ravel()))

    # Declared non-deterministic so that a filter on the result does not compute it twice.
    return cosines.asNondeterministic()(vector)


def similarity_arrays(pages: DataFrame, labels: Labels, key: str, vector: str = "embedding") -> DataFrame:
    return pages.select(key, similarity(vector, labels).alias("sims"))


def similarity_long(sims: DataFrame, labels: Labels, key: str) -> DataFrame:
    """(key, category, similarity), one row per page and label."""
    names = F.array(*[F.lit(n) for n in labels.names])
    pairs = F.arrays_zip(names.alias("category"), F.col("sims").alias("similarity"))
    return sims.select(key, F.inline(pairs))


def similarity_wide(sims: DataFrame, labels: Labels, key: str, prefix: str = "sim_") -> DataFrame:
    """One column per label."""
    return sims.select(key, *[F.col("sims")[i].alias(f"{prefix}{n}") for i, n in enumerate(labels.names)])


def predicted(sims: DataFrame, labels: Labels, key: str, threshold: float = 0.3) -> DataFrame:
    """Sorted labels at or above the threshold per page, ``["unknown"]`` where there are none."""
    names = F.array(*[F.lit(n) for n in labels.names])
    over = F.filter(F.arrays_zip(names.alias("n"), F.col("sims").alias("s")), lambda e: e.getField("s") >= threshold)
    found = F.sort_array(F.transform(over, lambda e: e.getField("n")))
    some = F.coalesce(F.size(found), F.lit(0)) > 0
    return sims.select(key, F.when(some, found).otherwise(F.array(F.lit(UNKNOWN))).alias("predicted"))


def predicted_pairs(labelled: DataFrame, key: str) -> DataFrame:
    """(key, category) of the pages that got a label."""
    return labelled.select(key, F.explode("predicted").alias("category")).filter(F.col("category") != UNKNOWN)


def best_label(sims: DataFrame, labels: Labels, key: str, threshold: float = 0.5) -> DataFrame:
    """The label with the highest similarity where that is above the threshold; the first on ties."""
    names = F.array(*[F.lit(n) for n in labels.names])
    top = F.array_max("sims")
    label = F.element_at(names, F.array_position("sims", top).cast("int"))
    return sims.filter(top > threshold).select(key, label.alias("category"), top.alias("similarity"))


def top_quantile(
    long: DataFrame, q: float, group: str = "category", value: str = "similarity", accuracy: int = 10_000
) -> DataFrame:
    """Rows at or above the exact q-quantile (nearest rank) of their group, whatever the values.

    A sketch brackets the quantile: the wanted rank lies between two values that have about
    four in ``accuracy`` of a group's rows between them. Rows from the lower one on are
    written once. Equal values between both are counted together and ranked; no group is
    sorted whole, and heavy ties are one row. What is found per group is written, so that
    its size in bytes decides whether it is broadcast. ``long`` is read twice. Nulls and
    NaN take no part; a null group is a group.
    """
    rows = long.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    wide = [max(0.0, q - 2 / accuracy), min(1.0, q + 2 / accuracy)]  # the sketch is off by 1 / accuracy at most
    between = F.percentile_approx(value, wide, accuracy)
    brackets = rows.groupBy(F.col(group).alias("__group")).agg(F.count("*").alias("__total"), between.alias("__between"))
    own = rows.join(stored(brackets, "brackets"), F.col(group).eqNullSafe(F.col("__group")))
    upper = stored(own.filter(F.col(value) >= F.col("__between")[0]), "upper")
    counted = upper.groupBy("__group").agg(F.count("*").alias("__upper"))
    within = upper.filter(F.col(value) <= F.col("__between")[1]).groupBy("__group", "__total", F.col(value).alias("__limit")).agg(F.count("*").alias("n"))
    so_far = W.partitionBy("__group").orderBy("__limit").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = within.withColumn("__up_to", F.sum("n").over(so_far)).withColumnRenamed("__group", "__own")
    ranked = placed.join(counted, F.col("__own").eqNullSafe(F.col("__group")))
    rank = F.round(F.lit(q) * (F.col("__total") - 1)).cast("long") + 1
    reached = ranked.filter(F.col("__total") - F.col("__upper") + F.col("__up_to") >= rank)
    limits = stored(reached.groupBy("__own").agg(F.min("__limit").alias("__limit")), "limits")
    found = upper.drop("__total", "__between").join(limits, F.col("__group").eqNullSafe(F.col("__own")))
    return found.filter(F.col(value) >= F.col("__limit")).select(*long.columns)


def label_means(pages: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """The mean vector per label."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return pages.groupBy(label).agg(mean.alias("m")).select(label, vector_to_array("m").alias(vector))


def embed_hashing(pages: DataFrame, key: str, text: str = "text", size: int = 384) -> DataFrame:
    """Unit-length word-count vectors by feature hashing: the built-in text encoder. A word's
    place is given by its MD5 digest, which any engine has."""
    digest = F.transform(words(F.coalesce(F.col(text), F.lit(""))), lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10))
    places = F.transform(digest, lambda d: (d.cast("long") % size).cast("string"))
    tokens = pages.select(key, places.alias("__places"))
    # All places are the vocabulary, in order, so that the counts come as vectors.
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], "__places", "__tf")
    unit = Normalizer(inputCol="__tf", outputCol="__unit").transform(counter.transform(tokens))
    return unit.select(key, vector_to_array("__unit").alias("embedding"))


def pca_scores(sims: DataFrame, key: str, k: int, scores: int = 2) -> DataFrame:
    """Scores on the first principal components and the variance share of each of ``k``; the
    largest loading of a component is positive. See :mod:`components`."""
    return component_scores(sims, key, k, scores)
