"""Importance resampling: documents whose word runs are as frequent in a target corpus.

Texts are read by Arrow kernels. Words come from splitting lower-cased texts at a pattern,
and are dictionary-encoded; runs of words are pairs of shifted dictionary indices, encoded
again, so that a CRC is worked out once for each different run of a batch. A run's bucket
has a gain, the logarithm of its share in the target over its share in the corpus. Gains
are taken by bucket and reduced over each document.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.positions import positioned
from firmlens.llm.storage import stored

#: What stands between words once A-Z are lower-cased: ASCII but for digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of the longest run, and buckets of runs.
RUN_WORDS, BUCKETS = 2, 10_000
#: Documents of fewer words are never drawn; the share that is drawn, in percent.
LEAST_WORDS, PERCENT = 20, 25
SEED = 7
#: Bytes of text that are looked at together; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of an array of strings with about ``SLICE_BYTES`` each."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + SLICE_BYTES, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def runs(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2 ... ``longest`` words: the text and the bucket of each run, in order."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    words = pc.list_flatten(parts)
    there = pc.not_equal(words, "")
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    row = row[there.to_numpy(zero_copy_only=False)]
    coded = words.filter(there).dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    vocabulary = coded.dictionary.cast(pa.binary()).to_pylist()
    followed = [b" " + w for w in vocabulary]
    checks = list(map(crc32, vocabulary))
    place, run = np.arange(len(word)), word
    for size in range(1, longest + 1):
        if size > 1:
            # A run and the word behind it, in the same text, are a run of the next size.
            on = place + size - 1
            inside = on < len(word)
            inside[inside] = row[on[inside]] == row[place[inside]]
            place = place[inside]
            pairs = pa.array(run[inside] * max(1, len(vocabulary)) + word[place + size - 1]).dictionary_encode()
            before, last = np.divmod(pairs.dictionary.to_numpy(), max(1, len(vocabulary)))
            checks = list(map(crc32, map(followed.__getitem__, last.tolist()), map(checks.__getitem__, before.tolist())))
            run = pairs.indices.to_numpy().astype(np.int64)
        yield row[place], (np.array(checks, np.int64) % buckets)[run]


def _texts(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).alias("text")


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = RUN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)``: runs of all texts by bucket. A task sends at most a row for each bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch.column(0).cast(pa.string())):
                for _, bucket in runs(part, longest, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return docs.select(_texts(docs, text)).mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def _collected(counts: DataFrame, buckets: int) -> np.ndarray:
    """At most ``buckets`` rows."""
    total = np.zeros(buckets)
    for r in counts.collect():
        total[r.bucket] = r.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of a bucket's smoothed share in the target over that in
    the corpus, rounded down; zero for every bucket if both are empty."""
    n = len(corpus)
    ratio = (target + 1) * (corpus.sum() + n) / ((corpus + 1) * (target.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(
    docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = RUN_WORDS
) -> DataFrame:
    """``(k, tie, n_words, n_features, weight)``: a row for each row of ``docs`` with its key, a
    hash of its text, and the rounded-down mean of its runs' gains (0 without runs)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((3, 0), np.int64)]
            for part in slices(batch.column(2).cast(pa.string())):
                own = np.zeros((3, len(part)), np.int64)
                for size, (row, bucket) in enumerate(runs(part, longest, len(gain)), 1):
                    own[1] += np.bincount(row, minlength=len(part))
                    if size == 1:
                        own[0] = own[1]
                    # Runs stand in the order of their texts: gains are summed over segments.
                    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
                    if len(row):
                        own[2][row[begin]] += np.add.reduceat(gain.take(bucket), begin)
                found.append(own)
            words, features, total = np.concatenate(found, 1)
            mean = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(words), pa.array(features), pa.array(mean)],
                ["k", "tie", "n_words", "n_features", "weight"],
            )

    kind = docs.schema[key].dataType.simpleString()
    own = docs.select(F.col(key).alias("k"), F.xxhash64(_texts(docs, text)).alias("tie"), _texts(docs, text))
    return own.mapInArrow(work, f"k {kind}, tie long, n_words long, n_features long, weight long")


def score(seed: int) -> Column:
    """A row's weight and a Gumbel variate drawn from its key, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("k").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.col("weight") + F.floor(F.lit(-1000.0) * F.ln(-F.ln(share))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
    longest: int = RUN_WORDS, seed: int = SEED, key: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """``(key, n_features, weight, score, rank)``: one row for each row of ``docs``.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred (rounded down) are
    drawn: those with the highest scores, of equal scores the smaller key. ``rank`` counts
    them from 1 and is null for all others. The scores' random parts make the draw one
    without replacement, in proportion to the exponentials of the weights.

    A null text is an empty one: no runs, weight 0, not drawn (if ``least_words`` is above
    0). A null key stands before all others and takes part with an empty name. Rows that
    are equal in key and score stand in the order of a hash of their texts; rows with the
    same text too are drawn in any order, as they can't be told apart. Empty tables give no
    rows, an empty target gives gains by the corpus alone. Other columns are not read.

    Counts cover all texts. Only the counts by bucket (``buckets`` rows) pass the driver;
    ranks come from sorted ranges, so that equal keys or scores in any number are dealt to
    several tasks.
    """
    corpus = _collected(bucket_counts(docs, text, longest, buckets), buckets)
    wanted = _collected(bucket_counts(target, target_text, longest, buckets), buckets)
    rows = weights(docs, gains(corpus, wanted), key, text, longest)
    rows = stored(rows.select("k", "tie", "n_words", "n_features", "weight", score(seed).alias("score")), "weights")
    ready = F.col("n_words") >= least_words
    able = positioned(rows.filter(ready), F.desc("score"), F.asc_nulls_first("k"), "tie")
    drawn = rows.filter(ready).count() * percent // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    names = [F.col("k").alias(key), "n_features", "weight", "score"]
    return able.select(*names, rank.alias("rank")).unionByName(
        rows.filter(~ready).select(*names, F.lit(None).cast("long").alias("rank"))
    )


def drawn_documents(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **how: object) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose keys :func:`resample` draws. All
    rows of a drawn key stay; a drawn null key keeps the rows with null keys."""
    drawn = stored(resample(docs, target, key=key, text=text, **how).filter("rank is not null").select(F.col(key).alias("k")).distinct(), "drawn")
    return docs.join(drawn, docs[key].eqNullSafe(drawn["k"]), "left_semi")
