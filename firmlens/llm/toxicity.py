"""Toxic texts by compression distance.

Two zstandard dictionaries are made from labelled texts. Both hold the commonest words of
ordinary text; each also has the strings that set its own class apart. A text is cut into
windows of a few words, and each window is compressed with both. The bytes that the toxic
dictionary saves are the window's distance, which has log odds of its class. A text is
scored by their sum, by the stretch of windows that has most of them, and by its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.quality import one_of_key
from firmlens.llm.storage import stored

#: Labelled documents that a detector is fitted to, at most.
FIT_DOCUMENTS = 8_000
#: Common words in both dictionaries, and distinct strings in each, at most.
COMMON, DISTINCT = 1_000, 1_000
#: A string sets a class apart if so many of its documents have it, if its share there is so
#: many times that in the other class, and if the difference is so many deviations.
LEAST, TIMES, DEVIATIONS = 5, 4.0, 5.0
#: Letters of the shortest and the longest beginning of a word that is looked at.
SHORTEST, LONGEST = 4, 24
#: A window goes on to the first white character behind so many bytes, if that is near.
WINDOW = 32
WINDOWS = re.compile(rb"[\s\S]{%d}[^\x09-\x0D\x20]{0,%d}|[\s\S]+" % (WINDOW, WINDOW))
WORD = re.compile(r"[^\W\d_]+")
LEVEL = 9
#: Distances of windows outside of these count as the nearest of them.
NEAREST, FARTHEST = -2, 8
#: The most that windows count for or against a text, and a stretch of them for it.
TOTAL, STRETCH = 10.0, 15.0
#: Scores from here on mean toxic. The fit puts its best cut here.
CUT = 0.7
WORTH = 0.5


class Detector(NamedTuple):
    toxic: bytes
    ordinary: bytes
    #: Log odds of distances from ``NEAREST`` to ``FARTHEST``; weights of the three features and a constant.
    odds: tuple[float, ...]
    weights: tuple[float, ...]

    def score(self, value: np.ndarray) -> float:
        """From 0 to 1, of a text with these distances."""
        z = float(np.append(features(value, np.array(self.odds)), 1.0) @ np.array(self.weights))
        return float(1 / (1 + np.exp(-z)))


def strings(text: str) -> set[str]:
    """Words of a lower-cased text between blanks, and their beginnings."""
    found = set()
    for word in set(WORD.findall(text.lower())):
        if len(word) <= LONGEST:
            found.add(f" {word} ")
        for size in range(SHORTEST, min(len(word), LONGEST) + 1):
            found.add(f" {word[:size]}")
    return found


@lru_cache(maxsize=4)
def _compressors(toxic: bytes, ordinary: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    known = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in (toxic, ordinary)]
    return zstandard.ZstdCompressor(dict_data=known[0], **plain), zstandard.ZstdCompressor(dict_data=known[1], **plain)


def distances(text: str, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """For each window of a text the bytes that the toxic dictionary saves.

    A window stands twice in what is compressed. Otherwise short windows are stored as they
    are by either dictionary, and the difference is lost.
    """
    if not text:
        return np.zeros(0, np.int64)
    one, other = (c.compress for c in _compressors(toxic, ordinary))
    doubled = [w + w for w in WINDOWS.findall(b" " + text.lower().encode())]
    return np.array([len(other(w)) - len(one(w)) for w in doubled], np.int64)


def _place(value: np.ndarray) -> np.ndarray:
    return np.clip(value, NEAREST, FARTHEST) - NEAREST


def features(value: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Sum of the windows' log odds, the most that a stretch of windows has, and the
    logarithm of the number of windows."""
    so_far = np.concatenate([[0.0], np.cumsum(odds[_place(value)])])
    stretch = (so_far - np.minimum.accumulate(so_far)).max()
    return np.array([np.clip(so_far[-1], -TOTAL, TOTAL), min(stretch, STRETCH), np.log1p(len(value))])


def _distinct(rows: list, own: str, other: str, sizes: dict[str, int]) -> list[str]:
    """Strings that set the class ``own`` apart, the most frequent first. Of strings that
    begin alike, one stays."""
    kept: list[str] = []
    for r in sorted(rows, key=lambda r: (-r[own], -len(r.string), r.string)):
        p, q = r[own] / sizes[own], r[other] / sizes[other]
        pool = (r[own] + r[other]) / (sizes[own] + sizes[other])
        spread = np.sqrt(pool * (1 - pool) * (1 / sizes[own] + 1 / sizes[other]))
        if r[own] < LEAST or p < TIMES * (r[other] + 0.5) / sizes[other] or p - q < DEVIATIONS * spread:
            continue
        if not any(r.string.startswith(k) or k.startswith(r.string) for k in kept):
            kept.append(r.string)
        if len(kept) == DISTINCT:
            break
    return kept


def _content(distinct: list[str], common: list[str]) -> bytes:
    """Common words stand last, so that both dictionaries have them at the same distance."""
    own = "".join(reversed(distinct)).replace("  ", " ")
    return f"{own} {' '.join(reversed(common))} ".encode()


def _frequencies(texts: DataFrame) -> DataFrame:
    """``(string, toxic, ordinary)``: in how many texts of each class a string is."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update(strings(text))
        found = list(counts[0].keys() | counts[1].keys())
        for begin in range(0, len(found), 50_000):
            part = found[begin : begin + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *[pa.array([counts[c][s] for s in part], pa.int64()) for c in (1, 0)]],
                ["string", "toxic", "ordinary"],
            )

    counted = texts.mapInArrow(work, "string string, toxic long, ordinary long")
    return counted.groupBy("string").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of standardised columns and a constant by Newton's method, for plain columns."""
    middle, spread = x.mean(0), x.std(0) + 1e-9
    scaled = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    w = np.zeros(scaled.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(scaled @ w, -30, 30)))
        step = scaled.T @ (p - y) + ridge * w
        w -= np.linalg.solve(scaled.T @ (scaled * (p * (1 - p))[:, None]) + ridge * np.eye(len(w)), step)
    return np.append(w[:-1] / spread, w[-1] - (w[:-1] / spread) @ middle)


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The value from which on most is gained: where precision and recall have the largest
    harmonic mean, halfway to the next lower value. Above all values if that mean stays
    under ``WORTH``: too few labels were seen to tell the classes apart."""
    order = np.argsort(-z, kind="stable")
    z, y = z[order], y[order]
    gain = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + y.sum())
    gain[:-1][z[:-1] == z[1:]] = -1  # equal values can't be told apart
    best = int(gain.argmax())
    if gain[best] < WORTH:
        return float(z[0]) + 1
    return float((z[best] + z[best + 1]) / 2 if best + 1 < len(z) else z[best] - 1)


def fit_to_labels(
    docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Detector | None:
    """A detector fitted to at most ``most`` labelled documents, those with the smallest
    hashes of their keys; None if they aren't of both classes.

    Only this fitting reads a sample. Rows with a null key, label or text take no part, nor do
    keys that have both labels. Of the texts of a repeated key the one with the smallest hash
    is taken. Texts are looked at in tasks; what reaches the driver are at most 2 x
    ``DISTINCT`` x 10 strings, ``COMMON`` words, and three numbers for each document.
    """
    own = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("toxic")).filter("k is not null and toxic in (0, 1)")
    own = own.groupBy("k").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("high")).filter("toxic = high").drop("high")
    sample = F.broadcast(own.orderBy(F.xxhash64(F.lit("toxic"), "k"), "k").limit(most))  # at most this many rows
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null")
    texts = stored(one_of_key(known, sample, ["toxic"]).select("text", "toxic"), "labelled")
    total = [F.count_if(F.col("toxic") == kind).alias(name) for kind, name in ((1, "toxic"), (0, "ordinary"))]
    sizes = texts.agg(*total).first().asDict()
    if not all(sizes.values()):
        return None
    counts = stored(_frequencies(texts), "strings")

    def candidates(one: str, other: str) -> list[str]:
        there = counts.filter((F.col(one) >= LEAST) & (F.col(one) / sizes[one] >= TIMES * (F.col(other) + 0.5) / sizes[other]))
        return _distinct(there.orderBy(F.desc(one), F.desc(F.length("string")), "string").limit(10 * DISTINCT).collect(), one, other, sizes)

    words = counts.filter(F.col("string").endswith(" ")).orderBy(F.desc("ordinary"), "string").limit(COMMON)
    common = [r.string.strip() for r in words.collect() if r.ordinary]
    toxic, ordinary = (_content(candidates(*sides), common) for sides in (("toxic", "ordinary"), ("ordinary", "toxic")))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_place(distances(t, toxic, ordinary)).astype(np.uint8).tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["toxic", "found"])

    measured = stored(texts.mapInArrow(measure, "toxic int, found binary"), "distances")
    width = FARTHEST - NEAREST + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width), np.int64)
        for batch in batches:
            for kind, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[kind] += np.bincount(np.frombuffer(found, np.uint8), minlength=width)
        yield pa.RecordBatch.from_arrays([pa.array(total[1]), pa.array(total[0])], ["one", "other"]).append_column(
            "place", pa.array(np.arange(width))
        )

    seen = measured.mapInArrow(count, "one long, other long, place long").groupBy("place").agg(F.sum("one"), F.sum("other")).collect()
    windows = np.array([r[1:] for r in sorted(seen)], float) + 1
    odds = np.log(windows / windows.sum(0)) @ np.array([1.0, -1.0])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(np.frombuffer(f, np.uint8).astype(np.int64) + NEAREST, odds) for f in batch.column(1).to_pylist()]
            columns = np.array(found).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["toxic", "total", "stretch", "length"])

    rows = sorted(map(tuple, measured.mapInArrow(describe, "toxic int, total double, stretch double, length double").collect()))
    x, y = np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], float)
    w = _logistic(x, y)
    w[-1] += np.log(CUT / (1 - CUT)) - best_cut(np.column_stack([x, np.ones(len(x))]) @ w, y)
    return Detector(toxic, ordinary, tuple(odds.tolist()), tuple(w.tolist()))


def scored(docs: DataFrame, detector: Detector | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, n_windows, n_marked)``: one row for each row of ``docs``.

    ``score`` goes from 0 to 1; from ``CUT`` on the text is held toxic. ``n_marked`` counts the
    windows that speak for it. A null or empty text has no window and the score of the
    constant alone. Without a detector every score is 0. Null and repeated keys stay; other
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if detector is None:
        return own.select(F.col("k").alias(key), F.lit(0.0).alias("score"), *[F.lit(0).cast("long").alias(n) for n in ("n_windows", "n_marked")])
    odds = np.array(detector.odds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, size, marked = [], [], []
            for value in batch.column(1):
                found = distances(value.as_py(), detector.toxic, detector.ordinary)
                score.append(detector.score(found))
                size.append(len(found))
                marked.append(int((odds[_place(found)] > 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array(size, pa.int64()), pa.array(marked, pa.int64())],
                [key, "score", "n_windows", "n_marked"],
            )

    return own.mapInArrow(work, f"`{key}` {kind}, score double, n_windows long, n_marked long")
