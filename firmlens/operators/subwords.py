"""Subword ids of texts from the vocabulary file of a public tokenizer.

A text's pieces (words, numbers, runs of signs) are encoded on their own by such a
tokenizer. So the different pieces of a corpus are found first, each is encoded once on
the cluster, and the ids are put back into the texts. How often a piece occurs costs a
lookup only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmlens.functions.joins import broadcast_if_small
from firmlens.operators.text import BROADCAST_WORDS, fixed_windows, ids_of_words
from firmlens.sources.files import stored

# Fixed value: the pieces of tokenizers that drop white space and lower-case their input.
PIECE = r"(?i)<\|startoftext\|>|<\|endoftext\|>|'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Pieces that a task gives to the tokenizer together.
TOGETHER = 4_096


def pieces(text: str | Column) -> Column:
    """The pieces of a text in order; none of a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({PIECE})"), F.lit(0))


def different_pieces(pages: DataFrame, text: str = "text") -> DataFrame:
    """``(piece)``: each once. Repeats in a text go before the shuffle."""
    return pages.select(F.explode(F.array_distinct(pieces(text))).alias("piece")).distinct()


def counted_pieces(pages: DataFrame, text: str = "text") -> DataFrame:
    """``(piece, n)``: each once, with the number of texts that have it."""
    return pages.select(F.explode(F.array_distinct(pieces(text))).alias("piece")).groupBy("piece").agg(F.count("*").alias("n"))


def piece_ids(found: DataFrame, tokenizer: str) -> DataFrame:
    """``(piece, ids)`` for a table of pieces, with its other columns behind. ``tokenizer`` is the
    path of a vocabulary file, read by Spark and sent to the tasks; special strings count as
    ordinary text."""
    found = found.select("piece", *[c for c in found.columns if c != "piece"])
    others = found.columns[1:]
    spec = found.sparkSession.read.text(tokenizer, wholetext=True).first()[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tokenizer.from_str(spec)
        own.encode_special_tokens = True
        for batch in batches:
            for begin in range(0, batch.num_rows, TOGETHER):
                part, *more = batch.slice(begin, TOGETHER).columns
                ids = [e.ids for e in own.encode_batch(part.to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([part, pa.array(ids, pa.list_(pa.int32())), *more], ["piece", "ids", *others])

    kinds = "".join(f", `{c}` {found.schema[c].dataType.simpleString()}" for c in others)
    return found.mapInArrow(work, "piece string, ids array<int>" + kinds)


def _lookup(table: DataFrame) -> Callable[[Column], Column]:
    """A function of arrays of pieces that gives all their ids, for a table of few enough rows."""
    rows = sorted(map(tuple, table.collect()))
    listed = pa.array([r[0] for r in rows], pa.string())
    ids = pa.array([r[1] for r in rows], pa.list_(pa.int32()))

    @F.arrow_udf("array<int>")
    def found(batch: pa.Array) -> pa.Array:
        own = ids.take(pc.index_in(batch.flatten(), value_set=listed))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(own).to_numpy(zero_copy_only=False))])
        texts = np.concatenate([[0], np.cumsum(pc.list_value_length(batch).to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(ends[texts], pa.int32()), own.flatten())

    # Declared non-deterministic so that its several uses do not compute it again.
    return found.asNondeterministic()


def _frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows of ``table`` with the highest ``n``, at most ``most``; of equal ones all or none."""
    # A row for each different number: as many as the root of all occurrences, at most.
    sizes = table.groupBy("n").agg(F.count("*").alias("rows"))
    total = sizes.select("n", F.sum("rows").over(W.orderBy(F.desc("n"))).alias("total"))
    least = total.filter(F.col("total") <= most).agg(F.min("n")).first()[0]
    return table.filter(F.col("n") >= least if least is not None else F.lit(False))


def subword_ids(
    pages: DataFrame, tokenizer: str, key: str = "url", text: str = "text", broadcast_pieces: int = BROADCAST_WORDS
) -> DataFrame:
    """``(key, __ids)``: the ids of each text, a row for each row of ``pages``.

    They are those of the tokenizer for the whole text if that is in Unicode's composed form.
    A null or empty text has none. Different pieces are written with their ids; up to
    ``broadcast_pieces`` of them go to the tasks, and no text is shuffled. Of more pieces the
    most frequent go there, and the others are joined; both give the same rows.
    """
    table = stored(piece_ids(counted_pieces(pages, text), tokenizer), "pieces")
    known, small = broadcast_if_small(table.select("piece", "ids"), broadcast_pieces)
    if small:
        return pages.select(key, _lookup(known)(pieces(text)).alias("__ids"))
    named = table.withColumnRenamed("piece", "word")
    frequent = _frequent(named, broadcast_pieces).select("word", "ids")
    return ids_of_words(pages.select(key, pieces(text).alias("__words")), named.select("word", "ids"), frequent, key, [])


def subword_encode(
    pages: DataFrame, tokenizer: str, length: int, key: str = "url", text: str = "text", before: int | None = None,
    after: int | None = None, pad: int = 0, broadcast_pieces: int = BROADCAST_WORDS,
) -> DataFrame:
    """``(key, window, input_ids, attention_mask)``: all subword ids of a text in windows of exactly
    ``length`` entries, each with the ids ``before`` and ``after`` it that a model wants, the
    last one padded. A text without pieces has one window of padding."""
    ids = subword_ids(pages, tokenizer, key, text, broadcast_pieces)
    return fixed_windows(ids, key, length, before, after, pad)
