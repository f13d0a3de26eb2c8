"""Grades of texts by cumulative-link regression.

One score, a sum of weights of a text's hashed words, their beginnings and shapes, is
compared with ordered thresholds: the probability of a grade above k is the logistic
function of the score minus threshold k. All grades share the weights. Weights are never
positive: a text loses by what bad texts have, so that length alone changes nothing. The
expected grade and the probability of reaching a grade come out of the same score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.pretokens import Remembered
from firmlens.llm.quality import one_of_key

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUNS = [(re.compile(r"[^\W\d_]+"), ""), (re.compile(r"\d+"), "9")]
EDGES = re.compile(r"^\W+|\W+$")
BUCKETS = 1 << 15
#: Labelled documents that the weights are fitted to.
FIT_DOCUMENTS = 4000
FIT_STEPS = 300
#: A word has its full value from one in so many words on.
FULL_VALUE = 100


def shape(word: str) -> str:
    """The word with letters as ``A`` or ``a`` and numbers as ``9``; punctuation stays."""
    letters = RUNS[0][0].sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", word)
    return RUNS[1][0].sub("9", letters)


def bucket(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) % BUCKETS


REPEATS = [bucket("repeated words"), bucket("words repeated at once")]


def buckets_of(words: list[str]) -> list[tuple[int, int, int]]:
    """Of each word the buckets of its lower-cased core, of the core's beginning, and of its shape."""
    out = []
    for word in words:
        core = EDGES.sub("", word.lower())
        out.append((bucket("w " + core), bucket("p " + core[:4]), bucket("s " + shape(word))))
    return out


@cache
def remembered() -> Remembered:
    return Remembered(buckets_of)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their values, which grow with a bucket's share of the words."""
    words = WORD.findall(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    all_of = np.array(remembered()(words), np.int64)
    core, cores = np.unique(all_of[:, :2], return_counts=True)
    kind, kinds = np.unique(all_of[:, 2], return_counts=True)
    n = len(words)
    again = [8 * (1 - len(set(words)) / n) ** 2, 8 * sum(map(str.__eq__, words, words[1:])) / n]
    return np.concatenate([core, kind, REPEATS]), np.concatenate(
        [np.minimum(1, FULL_VALUE * cores / n), 4 * np.sqrt(kinds / n), again]
    )


@dataclass(frozen=True)
class Grader:
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """Probability of a grade above each threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int, steps: int = FIT_STEPS, rate: float = 0.05, decay: float = 1e-4, sparse: float = 4e-3) -> Grader:
    """Weights and thresholds that make the grades likely, by gradient ascent; ``sparse``
    draws weights to zero. Thresholds stay in order because their distances are
    exponentials. Without two different grades all weights are zero."""
    weights, steps = np.zeros(BUCKETS), steps if len({g for _, _, g in rows}) > 1 else 0
    parts = np.concatenate([[3.0 - 3.0 * grades + 0.0], np.full(grades - 2, np.log(3.0))])
    rows = [r for r in rows if len(r[0])] if steps else []
    if rows:
        bucket, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        size = np.array([len(r[0]) for r in rows])
        begin = np.cumsum(size) - size
        grade = np.array([r[2] for r in rows])
        # Every grade weighs alike, so that a rare one is learned too.
        share = np.bincount(grade, minlength=grades)
        weigh = 1 / share[grade] / np.count_nonzero(share)
    moments = [np.zeros(BUCKETS), np.zeros(BUCKETS), np.zeros(grades - 1), np.zeros(grades - 1)]

    def thresholds() -> np.ndarray:
        return np.cumsum(np.concatenate([parts[:1], np.exp(parts[1:])]))

    for step in range(1, steps + 1 if rows else 1):
        limits = np.concatenate([[-np.inf], thresholds(), [np.inf]])
        score = np.add.reduceat(weights[bucket] * value, begin)
        low = 1 / (1 + np.exp(np.clip(score - limits[grade], -50, 50)))
        high = 1 / (1 + np.exp(np.clip(score - limits[grade + 1], -50, 50)))
        likely = np.maximum(high - low, 1e-9)
        to_score = weigh * (low * (1 - low) - high * (1 - high)) / likely
        slope_limit = np.zeros(grades + 1)
        np.add.at(slope_limit, grade + 1, weigh * high * (1 - high) / likely)
        np.add.at(slope_limit, grade, -weigh * low * (1 - low) / likely)
        down = np.cumsum(slope_limit[1:-1][::-1])[::-1]
        slopes = [
            np.bincount(bucket, np.repeat(to_score, size) * value, BUCKETS) - decay * weights + sparse * (weights < 0),
            down * np.concatenate([[1.0], np.exp(parts[1:])]),
        ]
        for i, (w, g) in enumerate(zip((weights, parts), slopes, strict=True)):
            moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * g
            moments[2 * i + 1] = 0.99 * moments[2 * i + 1] + 0.01 * g * g
            w += rate * (moments[2 * i] / (1 - 0.9**step)) / (np.sqrt(moments[2 * i + 1] / (1 - 0.99**step)) + 1e-6)
        np.minimum(weights, 0, out=weights)
    return Grader(weights, thresholds())


def fit_to_ratings(
    docs: DataFrame, ratings: DataFrame, grade: Column, grades: int, most: int = FIT_DOCUMENTS, key: str = "doc_id", text: str = "text"
) -> Grader:
    """The grader fitted to at most ``most`` rated documents, those with the smallest hashes
    of their keys. ``grade`` is a column of ``ratings`` from 0 to ``grades`` - 1.

    Only this fitting reads a sample. Rows with a null key, grade or text take no part. Of the
    texts of a repeated key the one with the smallest hash is taken.
    """
    rated = ratings.select(F.col(key).alias("k"), grade.cast("int").alias("grade")).filter("k is not null and grade is not null").distinct()
    sample = F.broadcast(rated.orderBy(F.xxhash64(F.lit("fit"), "k"), "k", "grade").limit(most))  # at most this many rows
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[0].astype("<i4").tobytes() for f in found], pa.binary()),
                    pa.array([f[1].astype("<f8").tobytes() for f in found], pa.binary()),
                    batch.column(1),
                ],
                ["buckets", "counts", "grade"],
            )

    rows = one_of_key(own, sample, ["grade"]).mapInArrow(work, "buckets binary, counts binary, grade int").collect()
    parts = sorted((r.grade, bytes(r.buckets), bytes(r.counts)) for r in rows)
    return fit([(np.frombuffer(b, "<i4").astype(np.int64), np.frombuffer(v, "<f8"), g) for g, b, v in parts], grades)


def graded(
    docs: DataFrame, grader: Grader, reach: int, key: str = "doc_id", text: str = "text", least: float = 0.4
) -> DataFrame:
    """``(key, expected_grade, tail_probability, selected)``: one row for each row of ``docs``.

    ``tail_probability`` is that of grade ``reach`` or better; rows that have at least
    ``least`` of it are selected. A null or empty text has the score zero. Null and
    repeated keys stay; other columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            score = np.array([grader.weights[b] @ v for b, v in found])
            above = grader.above(score)
            tail = above[:, reach - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(1)), pa.array(tail), pa.array(tail >= least)],
                [key, "expected_grade", "tail_probability", "selected"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        work, f"`{key}` {kind}, expected_grade double, tail_probability double, selected boolean"
    )
