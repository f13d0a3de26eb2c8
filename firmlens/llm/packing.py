"""Packing of tokenised documents into sequences of a fixed length.

Partitions pack their own pieces by best fit, the longest first. Full and nearly full
sequences are done. The others go on as items of their own into fewer partitions, where
best fit joins them again, until one partition holds them or joining no longer helps.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from firmlens.llm.pretokens import Remembered, classes_without, grouped, looked_up_bytes, looked_up_parts
from firmlens.llm.token_counts import unknown_to
from firmlens.llm.storage import stored

#: Sequences with at most this much room left are not packed again.
NEARLY_FULL = 8
#: Items that a task packs at once; a round has as many partitions as this asks for.
TASK_ITEMS = 100_000
#: Partitions of one round whose open sequences meet in one partition of the next.
FAN_IN = 8
#: Words that the library encodes in one call.
TOGETHER = 16_384
#: A round that leaves more than this share of the items open is the last.
STALLED = 0.9


class WordIds:
    """Ids of single pre-tokens by the tokenizers library, many in one call.

    Words are put after each other, those without a leading blank on lines of their own;
    neither changes how the library splits them. Ids have known lengths in bytes, which
    tells where a word's ids end.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.length = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        for i, content in special.items():
            self.length[i] = len(content.encode())
        self.special = next(iter(special.values()), None)
        self.special_id = next(iter(special), None)

    def encode(self, text: str) -> np.ndarray:
        # The fast call leaves out the places in the text, which nobody asks for.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def __call__(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        blank = [i for i, w in enumerate(words) if w[0] == " " and not w.isspace()]
        plain = [i for i, w in enumerate(words) if not w[0].isspace()]
        for chosen, mark in ((blank, ""), (plain, "\n")):
            for first in range(0, len(chosen), TOGETHER):
                self._together(words, chosen[first : first + TOGETHER], mark, out)
        for i in set(range(len(words))).difference(blank, plain):
            out[i] = self.encode(words[i]).tobytes()
        return out

    def _together(self, words: list[str], chosen: list[int], mark: str, out: list[bytes]) -> None:
        ids = self.encode(mark.join(words[i] for i in chosen))
        ends = np.cumsum(self.length[ids])
        size = np.array([len(words[i].encode()) for i in chosen], np.int64)
        end = np.cumsum(size + len(mark)) - len(mark)
        last = np.searchsorted(ends, end)
        if len(last) and not np.array_equal(ends[last], end):
            raise ValueError("an id reaches over the end of a word")
        first = np.append(0, last[:-1] + 1 + len(mark))
        for i, a, b in zip(chosen, first.tolist(), (last + 1).tolist(), strict=True):
            out[i] = ids[a:b].tobytes()


@cache
def encoder(path: str, unknown: bytes) -> tuple[Remembered, WordIds]:
    ids = WordIds(path)
    return Remembered(ids, classes=classes_without(unknown)), ids


def document_ids(texts: list[str], path: str, unknown: bytes) -> Iterator[bytes]:
    """The ids of each text, as little-endian unsigned 32-bit integers."""
    remembered, ids = encoder(path, unknown)
    between = np.array([ids.special_id or 0], "<u4").tobytes()
    for group in grouped(texts):
        for parts in looked_up_parts(group, remembered, ids.special, looked_up_bytes):
            yield between.join(parts)


PIECE = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(
    docs: DataFrame, tokenizer: str, length: int, end_id: int, key: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32)``: the documents' ids, each document's with
    ``end_id`` behind. Only those of more than ``length`` ids are cut, so that every piece
    but the first is full. ``keep_ids`` adds the ids themselves as an array.

    A null text is an empty one, of which ``end_id`` alone is left; null and repeated keys
    stay; other columns are not read.
    """
    end = np.array([end_id], "<u4").tobytes()
    unknown = unknown_to(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            made: list[tuple[int, int, int, int]] = []
            own: list[np.ndarray] = []
            for row, ids in enumerate(document_ids(batch.column(1).to_pylist(), tokenizer, unknown)):
                ids += end
                total = len(ids) // 4
                count = -(-total // length)
                at = [0, *range(total - length * (count - 1), total + 1, length)]
                for piece, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                    rows.append(row)
                    made.append((piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
                    if keep_ids:
                        own.append(np.frombuffer(ids, "<u4")[a:b])
            columns = [pa.array(c, t) for c, t in zip(zip(*made, strict=True), PIECE.types, strict=True)] if made else [pa.array([], t) for t in PIECE.types]
            names = [key, *PIECE.names]
            if keep_ids:
                columns.append(pa.array([x.astype("int32") for x in own], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), *columns], names)

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        cut, schema + (", ids array<int>" if keep_ids else "")
    )


def best_fit(sizes: np.ndarray, room: int) -> np.ndarray:
    """The bin of each item: the one whose remaining room it fits best, a new one if none
    has enough. The longest items come first, ties in the order given."""
    bins = np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    rooms = 0  # a bit for each room that some bin has left
    made = 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = rooms >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            place = by_room[left].pop()
            if not by_room[left]:
                rooms &= ~(1 << left)
        else:
            left, place = room, made
            made += 1
        bins[item] = place
        left -= size
        if left:
            by_room[left].append(place)
            rooms |= 1 << left
    return bins


def _packed(table: pa.Table, length: int) -> pa.RecordBatch:
    """Bins of the items of a table ``(fill, members)``."""
    fill = table["fill"].to_numpy().astype(np.int64)
    lists = table["members"].combine_chunks()
    members = lists.flatten()
    count = np.diff(lists.offsets.to_numpy())
    begin = np.concatenate([[0], np.cumsum(count)])
    bins = best_fit(fill, length)
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(fill[order]) - fill[order]
    first = np.flatnonzero(np.append(True, np.diff(bins[order]) > 0)) if len(order) else order
    sizes = np.diff(np.append(first, len(order)))
    base = before - np.repeat(before[first], sizes)
    counts = count[order]
    take = np.repeat(begin[order] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    moved = members.take(pa.array(take))
    names = [f.name for f in moved.type]
    columns = [moved.field(n) for n in names]
    at = names.index("offset")
    columns[at] = pa.array(columns[at].to_numpy() + np.repeat(base, counts))
    per_bin = np.add.reduceat(counts, first) if len(first) else counts
    offsets = np.concatenate([[0], np.cumsum(per_bin)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.add.reduceat(fill[order], first) if len(first) else fill, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, fields=list(moved.type))),
        ],
        ["fill", "members"],
    )


def _pack_partitions(items: DataFrame, length: int) -> DataFrame:
    """Best fit of each partition's own items, at most ``TASK_ITEMS`` at a time.

    Rows come sorted by what they hold, so a task that runs again packs the same bins.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= TASK_ITEMS:
                yield _packed(pa.Table.from_batches(held), length)
                held, rows = [], 0
        if rows:
            yield _packed(pa.Table.from_batches(held), length)

    return items.mapInArrow(pack, items.schema)


def pack_items(items: DataFrame, length: int) -> DataFrame:
    """``items`` with a ``length`` each (1 to the sequence length), and with
    ``sequence_id`` and the ``offset`` of their place in it.

    Sequences are filled gaplessly from 0. Items of the full length are sequences as they
    are. Nothing is dropped: sequences still open after the last round are returned as
    they are. An empty table gives an empty one.
    """
    names = [c for c in items.columns if c not in ("offset", "sequence_id")]
    member = F.struct(*names, F.lit(0).cast("long").alias("offset"))
    bins = stored(items.select(F.col("length").cast("long").alias("fill"), F.array(member).alias("members")), "pieces")
    done = [bins.filter(F.col("fill") >= length)]
    open_bins = bins.filter(F.col("fill") < length)
    left = open_bins.count()
    partitions = max(1, -(-left // TASK_ITEMS), open_bins.sparkSession.sparkContext.defaultParallelism if left > 1000 else 1)
    while left:
        own = open_bins.repartition(partitions, F.xxhash64("members")).sortWithinPartitions("fill", "members")
        packed = stored(_pack_partitions(own, length), "bins")
        closed = F.col("fill") >= length - NEARLY_FULL
        open_bins = packed.filter(~closed)
        now = open_bins.count()
        if partitions == 1 or now > STALLED * left:
            done.append(packed)
            break
        done.append(packed.filter(closed))
        left, partitions = now, max(1, -(-now // TASK_ITEMS), -(-partitions // FAN_IN) if now > TASK_ITEMS else 1)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return (
        whole.withColumn("sequence_id", F.monotonically_increasing_id())
        .select("sequence_id", F.explode("members").alias("m"))
        .select(*[F.col("m").getField(c).alias(c) for c in names], "sequence_id", F.col("m.offset").alias("offset"))
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of the documents with their places in sequences of ``length`` ids:
    ``(key, piece, start, length, ids_crc32[, ids], sequence_id, offset)``."""
    return pack_items(pieces(docs, tokenizer, length, end_id, key, text, keep_ids), length)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` of a result with ids: each sequence as one array."""
    own = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("m"))
    return own.select("sequence_id", F.flatten(F.col("m.ids")).alias("ids"))
