"""Page texts: cleaning, texts of firms in parts, word ids in windows of fixed length."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from firmlens.functions.joins import broadcast_if_small
from firmlens.functions.text import words
from firmlens.sources.files import stored

# Texts of pages that failed to load.
JUNK_PREFIX = "Powered by Imunify360"
JUNK_PARTS = [
    "Loader Please wait while your request is being verified...",
    "You need to enable JavaScript to run this app",
    "flex-basis: ",
    "document.getElementById",
]

PAD_ID, UNKNOWN_ID, FIRST_ID = 0, 1, 2
#: Words of the largest vocabulary that goes to every task.
BROADCAST_WORDS = 500_000


def clean_text(pages: DataFrame, key: str = "url", text: str = "text") -> DataFrame:
    """Non-empty pages without junk, one per different text: the one with the smallest key.
    Texts are compared by a digest of 256 bits of their whole length."""
    content = F.col(text)
    pages = pages.filter((content != "") & ~content.startswith(JUNK_PREFIX))
    for part in JUNK_PARTS:
        pages = pages.filter(~content.contains(part))
    pages = pages.withColumn("__digest", F.unhex(F.sha2(content, 256)))
    return _first_per_digest(pages, key).drop("__digest")


def _first_per_digest(pages: DataFrame, key: str) -> DataFrame:
    """The row with the smallest key of each ``__digest``, found by digests and keys alone.

    What is written is one row for each digest of several rows; its size decides whether
    it is broadcast to the rows, which otherwise meet it by a shuffle.
    """
    counts = pages.select("__digest", F.col(key).alias("__key")).groupBy("__digest", "__key").agg(F.count("*").alias("n"))
    least = F.min(F.struct("__key", "n")).alias("least")
    several = counts.groupBy("__digest").agg(F.sum("n").alias("rows"), least).filter("rows > 1")
    several = stored(several.select(F.col("__digest").alias("__several"), "least.*"), "several")
    joined = pages.join(several, F.col("__digest") == F.col("__several"), "left")
    first = joined.filter(F.col("__several").isNull() | F.col(key).eqNullSafe(F.col("__key")))
    if several.filter("n > 1").isEmpty():
        return first.drop("__several", "__key", "n")
    # Rows that share key and text: any one of them.
    tied = F.coalesce(F.col("n") > 1, F.lit(False))
    position = F.row_number().over(W.partitionBy("__digest").orderBy(key))
    one = first.filter(tied).withColumn("__n", position).filter("__n = 1").drop("__n")
    return first.filter(~tied).unionByName(one).drop("__several", "__key", "n")


def group_text(
    pages: DataFrame,
    key: str = "id",
    order: str = "url",
    text: str = "text",
    separator: str = "\n",
    part_chars: int = 1_000_000,
    keep_empty: bool = True,
) -> DataFrame:
    """``(key, part, text)``: the pages of a firm joined in ``order``, in as many parts as
    ``part_chars`` goes into their length.

    A firm of up to ``part_chars`` has the one part 0. The pages of a larger one are dealt
    to parts by a digest of ``order``, so that no task holds more than a part, and every
    page is whole in one of them. A firm without any text has an empty one, or with
    ``keep_empty`` off no row, which saves a look at all firms.
    """
    width = F.char_length(text).cast("long") + len(separator)
    rows = pages.filter(F.col(text).isNotNull()).select(key, order, F.col(text).alias("__text"), width.alias("__width"))
    if not separator:
        rows = rows.filter("__text <> ''")
    sizes = rows.groupBy(key).agg(F.sum("__width").alias("__total")).filter(F.col("__total") > part_chars)
    large = sizes.select(F.col(key).alias("__key"), F.ceil(F.col("__total") / part_chars).alias("__parts"))
    digest = F.conv(F.substring(F.md5(F.col(order).cast("string")), 1, 8), 16, 10).cast("long")
    part = F.when(F.col("__parts").isNotNull(), F.pmod(digest, F.col("__parts"))).otherwise(0).cast("long")
    dealt = rows.join(large, rows[key].eqNullSafe(large["__key"]), "left").withColumn("part", F.coalesce(part, F.lit(0)))
    parts = dealt.groupBy(key, "part").agg(F.sort_array(F.collect_list(F.struct(order, "__text"))).alias("__pages"))
    texts = parts.select(key, "part", F.array_join(F.col("__pages").getField("__text"), separator).alias(text))
    if not keep_empty:
        return texts.filter(F.col(text) != "")
    firms = pages.select(F.col(key).alias("__key")).distinct()
    return firms.join(texts, firms["__key"].eqNullSafe(texts[key]), "left").select(
        F.col("__key").alias(key), F.coalesce("part", F.lit(0)).alias("part"), F.coalesce(text, F.lit("")).alias(text)
    )


def vocabulary(pages: DataFrame, size: int | None = None, text: str = "text") -> DataFrame:
    """All words, or the ``size`` most frequent ones if a model has no more, with ids from 2
    on, most frequent first.

    The words are sorted in ranges; ids add the sizes of the ranges before to the place in
    the range. Written once, because the places depend on the sort.
    """
    every = pages.select(F.explode_outer(words(F.col(text))).alias("word")).filter("word is not null")
    counts = every.groupBy("word").agg(F.count("*").alias("n"))
    ordered = counts.orderBy(F.desc("n"), "word")
    if size is not None:
        ordered = ordered.limit(size)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(ordered.select("word", F.spark_partition_id().alias("range"), place.alias("place")), "vocabulary")
    ranges = placed.groupBy("range").agg(F.count("*").alias("n"))  # one row for each sorted range
    before = F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = ranges.select("range", before.alias("before"))
    return placed.join(offsets, "range").select("word", (F.col("before") + F.col("place") + FIRST_ID).cast("int").alias("token"))


def token_encode(
    pages: DataFrame, vocab: DataFrame, length: int, key: str = "url", text: str = "text", broadcast_words: int = BROADCAST_WORDS
) -> DataFrame:
    """``(key, window, input_ids, attention_mask)``: the word ids of a page in windows of
    exactly ``length`` entries, the last one padded.

    Words outside the vocabulary share one id; a page without words has one window of
    padding. A vocabulary of up to ``broadcast_words`` words goes to the tasks, and no text
    is shuffled. Of a larger one those with the smallest ids do, and the other words of the
    texts are joined to it.
    """
    known, small = broadcast_if_small(vocab.select("word", "token"), broadcast_words)
    own = words(F.coalesce(F.col(text), F.lit("")))
    if small:
        return fixed_windows(pages.select(key, _token_ids(known)(own).alias("__ids")), key, length)
    table = known.select("word", F.array("token").alias("ids"))
    frequent = table.filter(known["token"] < FIRST_ID + broadcast_words).limit(broadcast_words)
    return fixed_windows(ids_of_words(pages.select(key, own.alias("__words")), table, frequent, key, [UNKNOWN_ID]), key, length)


def fixed_windows(
    ids: DataFrame, key: str, length: int, before: int | None = None, after: int | None = None, pad: int = PAD_ID
) -> DataFrame:
    """``(key, window, input_ids, attention_mask)`` of ``ids(key, __ids)``: windows of ``length``
    entries, the last one padded. Every window can have an id ``before`` and ``after`` its own."""
    ends = [F.array(F.lit(v)) if v is not None else F.array().cast("array<int>") for v in (before, after)]
    length -= sum(v is not None for v in (before, after))
    count = F.greatest(F.ceil(F.size("__ids") / length), F.lit(1)).cast("int")
    windows = ids.select(key, "__ids", F.explode(F.sequence(F.lit(0), count - 1)).alias("window"))
    windows = windows.select(key, "window", F.slice("__ids", F.col("window") * length + 1, F.lit(length)).alias("t"))
    missing, own = F.lit(length) - F.size("t"), sum(v is not None for v in (before, after))
    return windows.select(
        key,
        "window",
        F.concat(ends[0], "t", ends[1], F.array_repeat(F.lit(pad), missing)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("t") + own), F.array_repeat(F.lit(0), missing)).alias("attention_mask"),
    )


def _token_ids(vocab: DataFrame) -> Callable[[Column], Column]:
    """A function of arrays of words for a vocabulary of few enough rows."""
    known = sorted(map(tuple, vocab.collect()))
    listed = pa.array([w for w, _ in known], pa.string())
    tokens = np.append(np.array([t for _, t in known], np.int32), np.int32(UNKNOWN_ID))

    @F.arrow_udf("array<int>")
    def ids(batch: pa.Array) -> pa.Array:
        place = pc.fill_null(pc.index_in(batch.flatten(), value_set=listed), len(listed)).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(batch).to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens[place], pa.int32()))

    # Declared non-deterministic so that its several uses do not compute it again.
    return ids.asNondeterministic()


def ids_of_words(texts: DataFrame, table: DataFrame, frequent: DataFrame, key: str, unknown: list[int]) -> DataFrame:
    """``(key, __ids)`` of ``texts(key, __words)`` by a table ``(word, ids)`` of any size, a row for
    each text; a word outside the table has the ids ``unknown``.

    ``frequent`` are rows of the table that go to the tasks; which ones they are has no
    influence on the result. What the tasks don't find is joined, each different word of a
    text once, and put in the place kept for it: a negative number among the text's ids.
    """
    rows = sorted(map(tuple, frequent.collect()))
    listed, lists = pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.int32()))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = batch.column(1).flatten(), _ends(batch.column(1))
            place = pc.index_in(flat, value_set=listed)
            missing = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
            coded = flat.take(pa.array(missing)).dictionary_encode()
            row, many = np.searchsorted(ends, missing, "right") - 1, max(1, len(coded.dictionary))
            pairs, at = np.unique(row * many + coded.indices.to_numpy(), return_inverse=True)
            first = np.searchsorted(pairs, np.arange(len(ends)) * many)
            index = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            index[missing] = len(lists) + np.arange(len(missing))
            known = _taken([lists, _singles(first[row] - at - 1)], index, ends)
            rare = pa.ListArray.from_arrays(pa.array(first, pa.int32()), coded.dictionary.take(pa.array(pairs % many)))
            yield pa.RecordBatch.from_arrays([batch.column(0), known, rare], [key, "known", "rare"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, ends = batch.column(1).flatten().to_numpy(zero_copy_only=False), _ends(batch.column(1))
            missing = np.flatnonzero(value < 0)
            found, limits = batch.column(2).flatten(), _ends(batch.column(2))
            span = 1 + int(max(found.field("place").to_numpy().max(initial=0), -value.min(initial=0)))
            have = np.repeat(np.arange(batch.num_rows), np.diff(limits)) * span + found.field("place").to_numpy()
            wanted = (np.searchsorted(ends, missing, "right") - 1) * span - value[missing] - 1
            at = np.searchsorted(have, wanted)
            there = np.append(have, -1)[at] == wanted
            index = np.arange(len(value))
            index[missing] = len(value) + np.where(there, at, len(have))
            parts = [_singles(value), found.field("ids"), pa.array([unknown], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), _taken(parts, index, ends)], [key, "__ids"])

    kind = texts.schema[key].dataType.simpleString()
    looked = texts.select(key, "__words").mapInArrow(look, f"`{key}` {kind}, known array<int>, rare array<string>")
    # Written once, because the numbers of the rows depend on the partitions.
    rows = stored(looked.withColumn("__row", F.monotonically_increasing_id()), "rare-words")
    wanted = rows.select("__row", F.posexplode("rare").alias("place", "word"))
    met = wanted.join(table, "word").groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("found"))
    none = F.array().cast("array<struct<place:int,ids:array<int>>>")
    some = rows.filter(F.size("rare") > 0).join(met, "__row", "left").select(key, "known", F.coalesce("found", none).alias("found"))
    filled = some.mapInArrow(fill, f"`{key}` {kind}, __ids array<int>")
    return rows.filter(F.size("rare") == 0).select(key, F.col("known").alias("__ids")).unionByName(filled)


def _ends(lists: pa.Array) -> np.ndarray:
    """Where each list begins among all entries, and where the last one ends."""
    return np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))


def _singles(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1), pa.int32()), pa.array(values, pa.int32()))


def _taken(parts: list[pa.Array], index: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The lists at ``index`` in the parts behind each other, one list for each range of ``ends``."""
    own = pa.concat_arrays([part.cast(pa.list_(pa.int32())) for part in parts]).take(pa.array(index))
    return pa.ListArray.from_arrays(pa.array(_ends(own)[ends], pa.int32()), own.flatten())
