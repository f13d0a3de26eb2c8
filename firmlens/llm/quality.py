"""Quality of documents from their lines.

Counts of words, symbols and repeats come first; documents that fail them are out. For
the others a linear-chain conditional random field reads the lines in order and labels
each as content or boilerplate; Viterbi decoding gives the best sequence of labels. A
document is kept if enough of its characters are in content lines.

The field is fitted to labelled documents: lines carry the label of their document, which
is noisy, but boilerplate lines are common only in bad documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a word is, and what counts as a symbol.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Least share of characters in content lines.
CONTENT_SHARE = 0.5
#: Labelled documents of each class that the field is fitted to, and lines of a sequence in
#: the fit: a longer document is several sequences.
FIT_DOCUMENTS = 200
FIT_LINES = 100
FIT_STEPS = 100

BOILERPLATE, CONTENT = 0, 1
FEATURES = ["bias", "symbols", "capitals", "exclamations", "digits", "repeats", "earlier", "short", "long"]


@dataclass(frozen=True)
class LineField:
    """Weights of a chain: by label and feature, and by label and next label."""

    emit: np.ndarray
    move: np.ndarray

    def labels(self, features: np.ndarray) -> np.ndarray:
        """The best label sequence (Viterbi); ties go to content."""
        score = features @ self.emit.T
        (ab, aa), (ba, bb) = (self.move[0, 0], self.move[0, 1]), (self.move[1, 0], self.move[1, 1])
        rows = score.tolist()
        low, high = rows[0]
        back = []
        for s0, s1 in rows[1:]:
            from_low, from_high = (low + ab, high + ba), (low + aa, high + bb)
            back.append((from_low[1] >= from_low[0], from_high[1] >= from_high[0]))
            low, high = max(from_low) + s0, max(from_high) + s1
        label = high >= low
        out = [label]
        for to_low, to_high in reversed(back):
            label = to_high if label else to_low
            out.append(label)
        return np.array(out[::-1], bool)


#: For corpora without labelled documents of both classes.
DEFAULT_FIELD = LineField(
    np.array([[-2.0, 12.0, 5.0, 8.0, 4.0, 4.0, 2.0, 0.5, 0.0], [0.0] * 9]), np.array([[1.0, 0.0], [0.0, 1.0]])
)


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line with a word, and the characters in its words."""
    rows, size = [], []
    seen: set[str] = set()
    for line in text.split("\n"):
        words = WORD.findall(line)
        if not words:
            continue
        n, chars = len(words), sum(map(len, words))
        letters = sum(map(str.isupper, words)) / n
        rows.append(
            (
                1.0,
                min(1.0, sum(map(line.count, SYMBOLS)) / n),
                letters,
                min(1.0, line.count("!") / n),
                sum(map(str.isdigit, words)) / n,
                1.0 - len(set(words)) / n,
                float(line in seen),
                float(n < 4),
                float(n > 20),
            )
        )
        size.append(chars)
        seen.add(line)
    return np.array(rows, float).reshape(-1, len(FEATURES)), np.array(size, np.int64)


def repeated_words(words: list[str], window: int = 3) -> int:
    """Words in windows that are found twice or more."""
    if len(words) < window:
        return 0
    ids: dict[str, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    key = code[: len(code) - window + 1]
    for i in range(1, window):
        # Renumbered, so that the numbers of pairs stay small in any text.
        key = np.unique(key * len(ids) + code[i : len(code) - window + 1 + i], return_inverse=True)[1]
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : len(code) - window + 1 + i] |= again
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORD.findall(text)
    seen: set[str] = set()
    dup = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(BLANKS):
                dup += line in seen
                seen.add(line)
    return len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words)


def fit(documents: list[tuple[np.ndarray, int]], steps: int = FIT_STEPS, rate: float = 0.1, decay: float = 1e-3) -> LineField:
    """Weights that make the labels of the documents' lines likely, by gradient ascent with
    sums over all label sequences (forward and backward)."""
    if len({y for f, y in documents if len(f)}) < 2:
        return DEFAULT_FIELD
    share = [1 / len(f) for f, _ in documents for _ in range(0, len(f), FIT_LINES)]
    documents = [(f[i : i + FIT_LINES], y) for f, y in documents for i in range(0, len(f), FIT_LINES)]
    most = max(len(f) for f, _ in documents)
    x = np.zeros((len(documents), most, len(FEATURES)))
    there = np.zeros((len(documents), most), bool)
    for i, (f, _) in enumerate(documents):
        x[i, : len(f)], there[i, : len(f)] = f, True
    label = np.array([y for _, y in documents])
    weight = np.array(share)  # every document counts alike, all its lines too
    emit, move = np.zeros((2, len(FEATURES))), np.zeros((2, 2))
    own = (label[:, None] == np.arange(2)).astype(float)
    seen_emit = np.einsum("d,dk,dtf->kf", weight, own, x)
    seen_move = np.diag((weight * (there.sum(1) - 1)) @ own)
    moments = [np.zeros_like(emit), np.zeros_like(move), np.zeros_like(emit), np.zeros_like(move)]

    def logsum(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis))

    for step in range(1, steps + 1):
        score = x @ emit.T
        ahead, behind = np.zeros((*there.shape, 2)), np.zeros((*there.shape, 2))
        ahead[:, 0] = score[:, 0]
        for t in range(1, most):
            moved = logsum(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None], moved, ahead[:, t - 1])
        total = logsum(ahead[:, -1], 1)
        for t in range(most - 2, -1, -1):
            moved = logsum(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(there[:, t + 1, None], moved, 0)
        odds = np.exp(ahead + behind - total[:, None, None]) * there[..., None]
        pair = ahead[:, :-1, :, None] + move + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        pair = np.where(there[:, 1:, None, None], np.exp(np.minimum(pair, 0)), 0)
        n = len(documents)
        slopes = [
            (seen_emit - np.einsum("d,dtk,dtf->kf", weight, odds, x)) / n - decay * emit,
            (seen_move - np.einsum("d,dtkl->kl", weight, pair)) / n - decay * move,
        ]
        for i, (w, g) in enumerate(zip((emit, move), slopes, strict=True)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[2 + i] = 0.999 * moments[2 + i] + 0.001 * g * g
            w += rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[2 + i] / (1 - 0.999**step)) + 1e-8)
    return LineField(emit, move)


def one_of_key(docs: DataFrame, sample: DataFrame, names: list[str]) -> DataFrame:
    """``(text, *names)`` of ``docs(k, text)`` joined to ``sample(k, *names)``: of each of its
    rows one text, the one with the smallest hash, found before the shuffle."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return docs.join(sample, "k").groupBy("k", *names).agg(least).select("least.text", *names)


def fit_to_labels(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCUMENTS, key: str = "doc_id", text: str = "text") -> LineField:
    """The field fitted to at most ``most`` labelled documents of each class (``quality`` 0
    or 1; those with the smallest hashes of their keys), all lines of each.

    Only this fitting reads a sample. Rows with a null key, label or text take no part. Of the
    texts of a repeated key the one with the smallest hash is taken.
    """
    hashed = labels.select(F.col(key).alias("k"), "quality").filter("k is not null").distinct()
    chosen = [
        hashed.filter(F.col("quality") == q).orderBy(F.xxhash64("k"), "k").limit(most) for q in (BOILERPLATE, CONTENT)
    ]
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 x most rows
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            values = [line_features(t)[0].ravel().tolist() for t in texts]
            digest = [" ".join(f"{v:.9g}" for v in own) for own in values]
            yield pa.RecordBatch.from_arrays([pa.array(digest), batch.column(1)], ["features", "quality"])

    rows = one_of_key(own, sample, ["quality"]).select("text", F.col("quality").cast("int").alias("quality")).mapInArrow(
        work, "features string, quality int"
    )
    found = sorted((r.quality, r.features) for r in rows.collect())
    return fit([(np.array(f.split(), float).reshape(-1, len(FEATURES)), q) for q, f in found])


def quality_rules(
    docs: DataFrame, field: LineField, key: str = "doc_id", text: str = "text", content_share: float = CONTENT_SHARE
) -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_boilerplate_lines, content_share, kept)``: one row for each row of ``docs``.

    A null or empty text has no words, fails the base rules and is not kept. Null and
    repeated keys stay; other columns are not read.
    """
    schema = (
        f"`{key}` {docs.schema[key].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, n_lines long, n_boilerplate_lines long, content_share double, kept boolean"
    )
    types = [*[pa.int64()] * 5, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
    names = [part.split()[0] for part in schema.split(", ")[1:]]

    def judge(value: str) -> tuple:
        counts = base_counts(value)
        failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
        features, size = line_features(value)
        content = field.labels(features) if len(size) else np.zeros(0, bool)
        share = float(size[content].sum() / size.sum()) if len(size) else 0.0
        return *counts, failed, len(size), int((~content).sum()), share, not failed and share >= content_share

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(t) for t in batch.column(1).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key, *names])

    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(work, schema)


def kept_documents(
    docs: DataFrame, field: LineField, key: str = "doc_id", text: str = "text", content_share: float = CONTENT_SHARE
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose texts :func:`quality_rules` keeps."""
    at = docs.columns.index(text)

    def keep(value: str | None) -> bool:
        counts = base_counts(value or "")
        if counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]:
            return False
        features, size = line_features(value)
        return size[field.labels(features)].sum() / size.sum() >= content_share

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([keep(t) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
