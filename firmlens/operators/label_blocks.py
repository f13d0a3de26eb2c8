"""Cosine similarity of rows with a label table of any size, block by block.

Labels are grouped around pivots and packed in blocks, one row each: names, unit vectors, the
block's centre and the cosine of its widest label with it. Rows are packed in blocks too.
A block of rows meets a block of labels in one matrix product, but only with the rows that
can reach the wanted similarity: the angle to the centre less the block's width bounds it.
For pairs, blocks of labels travel in bundles and rows in larger blocks, so that little is moved
for each product. Rounded pairs leave by the million in order of their cosine: equal ones side by
side take little room in columnar files. What passes is small and is put together by an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.operators.vectors import UNKNOWN, unit_rows
from firmlens.sources.files import spread, stored

#: Labels in a block, rows in a block, and pivots that labels are grouped around, at most.
BLOCK_LABELS, BLOCK_ROWS, PIVOTS = 1_024, 1_024, 256
#: Rows in a block and labels in a bundle of blocks where pairs are made, and pairs in one product, at most.
PAIR_ROWS, BUNDLE_LABELS, PRODUCT_PAIRS = 4_096, 4_096, 1 << 20
#: Found pairs from which on they are put in order and leave, and pairs that leave at once, at most.
ORDERED_PAIRS, LEAVING_PAIRS = 1 << 21, 1 << 16
#: Blocks of labels that each task goes through for whole lists, and rows whose lists leave it at once, at most.
TASK_BLOCKS, LIST_ROWS = 1_024, 128
#: Room for the last bits of a bound.
SLACK = 1e-9


def _unit_arrays(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a matrix of unit rows."""
    if not len(column):
        return np.zeros((0, 0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if len(values) % max(1, len(column)):
        raise ValueError("vectors must be of one length")
    return unit_rows(values.reshape(len(column), -1))


def _pivots(labels: DataFrame, most: int) -> np.ndarray:
    """Unit vectors of at most ``most`` labels, those with the smallest digests of their names."""
    rows = labels.orderBy(F.md5("name"), "name").limit(most).collect()
    if not rows:
        return np.zeros((0, 0))
    matrix = np.array([r.vector for r in rows], dtype="float64").reshape(len(rows), -1)
    return unit_rows(matrix)


def label_blocks(labels: DataFrame, name: str = "label", vector: str = "embedding", block: int = BLOCK_LABELS) -> DataFrame:
    """``(names, vectors, centre, width)``: labels in blocks of at most ``block``, near ones together.

    A label goes to its nearest pivot; the labels of a pivot are dealt to blocks by their
    place in a sorted range, so that no task gathers more than a block. Labels without a
    vector drop out.
    """
    rows = labels.select(F.col(name).cast("string").alias("name"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter("vector is not null")
    pivots = _pivots(rows, PIVOTS)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = _unit_arrays(batch.column(1)) @ pivots.T
            columns = [*batch.columns, pa.array(cosine.argmax(1) if len(pivots) else np.zeros(0), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["name", "vector", "pivot"])

    placed = stored(rows.mapInArrow(nearest, "name string, vector array<double>, pivot int"), "labels")
    sizes = placed.groupBy("pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))  # a row for each pivot
    part = F.pmod(F.xxhash64("name", "vector"), F.col("parts")).cast("int").alias("part")
    dealt = placed.join(F.broadcast(sizes), "pivot").select("pivot", part, "name", "vector")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for own in batch.column(0):
                names = [v["name"].as_py() for v in own]
                for begin in range(0, len(names), block):  # a digest deals a few more to some
                    vectors = _unit_arrays(own.values.slice(begin, block).field("vector"))
                    centre = unit_rows(vectors.sum(0)[None])[0]
                    found[0].append(names[begin : begin + block])
                    found[1].append(vectors.tobytes())
                    found[2].append(centre.tobytes())
                    found[3].append(float((vectors @ centre).min()))
            types = [pa.list_(pa.string()), pa.binary(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(found, types, strict=True)], ["names", "vectors", "centre", "width"])

    gathered = dealt.groupBy("pivot", "part").agg(F.sort_array(F.collect_list(F.struct("name", "vector"))).alias("rows"))
    return gathered.select("rows").mapInArrow(pack, "names array<string>, vectors binary, centre binary, width double")


def _row_blocks(rows: DataFrame, key: str, vector: str, kind: str, block: int) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, block):
                part = batch.slice(begin, block)
                keys = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([keys, pa.array([_unit_arrays(part.column(1)).tobytes()], pa.binary())], ["keys", "rows"])

    known = rows.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).filter("v is not null")
    return known.mapInArrow(pack, f"keys array<{kind}>, rows binary")


def _bundles(blocks: DataFrame) -> DataFrame:
    """``(names, vectors, sizes, centres, widths)``: blocks put together up to ``BUNDLE_LABELS`` labels,
    or a single larger block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, begin = pc.list_value_length(batch.column(0)).to_numpy(), 0
            while begin < len(sizes):
                fit = int(np.searchsorted(np.cumsum(sizes[begin:]), BUNDLE_LABELS, "right"))
                of = batch.slice(begin, max(1, fit))
                names = of.column(0).flatten()
                joined = [pa.array([b"".join(of.column(k).to_pylist())], pa.binary()) for k in (1, 2)]
                lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in (names, pa.array(sizes[begin : begin + of.num_rows], pa.int32()), of.column(3))]
                yield pa.RecordBatch.from_arrays([lists[0], joined[0], lists[1], joined[1], lists[2]], ["names", "vectors", "sizes", "centres", "widths"])
                begin += of.num_rows

    return blocks.mapInArrow(pack, "names array<string>, vectors binary, sizes array<int>, centres binary, widths array<double>")


def _matrix(cell: pa.Scalar, rows: int) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), "f8").reshape(rows, -1)


def _reached(own: np.ndarray, labels: np.ndarray, centre: np.ndarray, width: float, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By rows the places of the pairs of a block of rows and a block of labels at or above the
    threshold, with their cosines."""
    if own.shape[1] != labels.shape[1]:
        raise ValueError(f"vectors must have {labels.shape[1]} entries")
    angle = np.arccos(np.clip(own @ centre, -1, 1)) - np.arccos(np.clip(width, -1, 1))
    near = np.flatnonzero(np.cos(np.maximum(angle, 0)) >= threshold - SLACK)
    if threshold > 0:  # a zero vector is at a right angle to all
        near = near[own[near].any(1)]
    else:
        near = np.union1d(near, np.flatnonzero(~own.any(1)))
    cosine = (own if len(near) == len(own) else own[near]) @ labels.T
    place = np.flatnonzero(cosine >= threshold)
    row, label = np.divmod(place, max(1, len(labels)))
    return near[row], label, cosine.ravel()[place]


def _half_up(values: np.ndarray, digits: int) -> np.ndarray:
    """Cosines as Spark's ``round`` gives them: half up, by the digits that a double is written with."""
    scale = 10.0**digits
    scaled = np.abs(values) * scale
    whole, part = np.floor(scaled + 0.5), scaled - np.floor(scaled)
    for i in np.flatnonzero(np.abs(part - 0.5) <= 1e-9 + 1e-15 * scale):  # near a half digits decide
        whole[i] = int(Decimal(repr(abs(float(values[i])))).scaleb(digits).to_integral_value(ROUND_HALF_UP))
    return np.copysign(whole / scale, values) + 0.0


def similar_labels(
    rows: DataFrame, blocks: DataFrame, threshold: float, key: str, vector: str = "embedding", block: int = PAIR_ROWS,
    digits: int | None = None,
) -> DataFrame:
    """``(key, category, similarity)``: the labels with a cosine of ``threshold`` or more.

    ``blocks`` comes from :func:`label_blocks`. Every block of rows meets every block of
    labels, as each row needs each label looked at; rows beyond a block's bound are left out
    of the product. Rows without a vector give nothing; a zero vector has the cosine 0.
    With ``digits``, what is returned is rounded, in whole batches, as ``round`` would.
    """
    kind = rows.schema[key].dataType.simpleString()
    # Both are written, as each part of one side meets all parts of the other.
    own = stored(_row_blocks(spread(rows.select(key, vector)), key, vector, kind, block), "row-blocks")
    return _pairs(own, stored(_bundles(blocks), "label-bundles"), threshold, key, kind, digits)


def _products(batch: pa.RecordBatch, threshold: float, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The pairs at or above the threshold of bundles and blocks of rows that meet, found in products
    of ``most`` pairs: their places among all keys and all names of the batch, and their cosines."""
    n_keys, n_names = (pc.list_value_length(batch.column(k)).to_pylist() for k in (0, 2))
    first_key = first_name = 0
    for i in range(batch.num_rows):
        sizes, widths = batch.column(4)[i].values, batch.column(6)[i].values
        own, labels, centres = _matrix(batch.column(1)[i], n_keys[i]), _matrix(batch.column(3)[i], n_names[i]), _matrix(batch.column(5)[i], len(sizes))
        start = 0
        for size, centre, width in zip(sizes.to_pylist(), centres, widths.to_pylist(), strict=True):
            step = max(1, most // max(1, size))
            for begin in range(0, n_keys[i], step):
                row, label, cosine = _reached(own[begin : begin + step], labels[start : start + size], centre, width, threshold)
                if len(row):
                    yield (row + (first_key + begin)).astype("i4"), (label + (first_name + start)).astype("i4"), cosine
            start += size
        first_key, first_name = first_key + n_keys[i], first_name + n_names[i]


def _in_order(found: list[tuple], keys: pa.Array, names: pa.Array, columns: list[str], digits: int | None, most: int) -> Iterator[pa.RecordBatch]:
    """Pairs as they leave: with ``digits`` rounded, in order of their cosine, ``most`` at once."""
    lot: Iterable[tuple] = found
    if digits is not None:
        row, label, cosine = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        cosine = _half_up(cosine, digits)
        # One number of the cosine and the place is sorted several times faster than places by cosine.
        place = np.rint(cosine * 10.0 ** min(digits, 9)).astype("i8") << 32 | np.arange(len(cosine))
        place.sort()
        place &= (1 << 32) - 1
        lot = ((row[of], label[of], cosine[of]) for of in np.split(place, range(most, len(place), most)))
    for rows, labels, values in lot:
        yield pa.RecordBatch.from_arrays([keys.take(pa.array(rows)), names.take(pa.array(labels)), pa.array(values)], columns)


def _pairs(own_blocks: DataFrame, bundles: DataFrame, threshold: float, key: str, kind: str, digits: int | None = None) -> DataFrame:
    """:func:`similar_labels` of blocks of rows and bundles of labels.

    A bundle meets one block of rows after the other, so that a task writes few different names
    in a row. The pairs of one lot leave while those of the next are found.
    """
    met = bundles.crossJoin(own_blocks)
    columns = [key, "category", "similarity"]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaving: Iterator[pa.RecordBatch] = iter(())
        for batch in batches:
            # Copied, as a view would hold the whole batch until its last pairs have left.
            keys, names = (v.take(pa.array(np.arange(len(v)))) for v in (batch.column(0).flatten(), batch.column(2).flatten()))
            found, waiting, sent = [], 0, 0
            for pairs in _products(batch, threshold, PRODUCT_PAIRS):
                found.append(pairs)
                waiting += len(pairs[0])
                yield from islice(leaving, waiting // LEAVING_PAIRS - sent)
                sent = waiting // LEAVING_PAIRS
                if waiting >= ORDERED_PAIRS:
                    yield from leaving
                    leaving, found, waiting, sent = _in_order(found, keys, names, columns, digits, LEAVING_PAIRS), [], 0, 0
            if found:
                yield from leaving
                leaving = _in_order(found, keys, names, columns, digits, LEAVING_PAIRS)
        yield from leaving

    return met.select("keys", "rows", "names", "vectors", "sizes", "centres", "widths").mapInArrow(
        multiply, f"`{key}` {kind}, category string, similarity double"
    )


def _whole_lists(rows: DataFrame, blocks: DataFrame, n_blocks: int, threshold: float, key: str, vector: str) -> DataFrame:
    """``(key, predicted)`` for each row with a vector: all its labels, sorted and without repeats.

    All labels are one side of the product in every task, block after block, so a row's list is
    made where its block is and nothing is shuffled. A task holds the label blocks, and the
    places of one block of rows; lists leave it in slices.
    """
    kind = rows.schema[key].dataType.simpleString()
    own = _row_blocks(rows, key, vector, kind, BLOCK_ROWS).withColumn("own", F.monotonically_increasing_id())
    labels = blocks.coalesce(1).withColumn("part", F.monotonically_increasing_id())
    met = own.crossJoin(labels.hint("shuffle_replicate_nl"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Keys and names are copied, as a view would hold the whole batch that it came in.
        waiting: dict[int, tuple[pa.Array, list]] = {}
        names_of: dict[int, pa.Array] = {}
        order, place, different = None, np.zeros(0, "i8"), pa.array([], pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                keys, names = batch.column(0)[i].values, batch.column(2)[i].values
                own, labels, centre = _matrix(batch.column(1)[i], len(keys)), _matrix(batch.column(3)[i], len(names)), _matrix(batch.column(4)[i], 1)[0]
                row, label, _ = _reached(own, labels, centre, batch.column(5)[i].as_py(), threshold)
                block, part = batch.column(6)[i].as_py(), batch.column(7)[i].as_py()
                if part not in names_of:
                    names_of[part] = names.take(pa.array(np.arange(len(names))))
                if block not in waiting:
                    waiting[block] = keys.take(pa.array(np.arange(len(keys)))), []
                found = waiting[block][1]
                found.append((part, row.astype("i4"), label.astype("i4")))
                if len(found) < n_blocks:
                    continue
                keys, found = waiting.pop(block)
                if order != (seen := [f[0] for f in found]):  # labels come in the same order for all blocks of rows
                    order, coded = seen, pa.concat_arrays([names_of[part] for part in seen]).dictionary_encode()
                    by_name = pc.sort_indices(coded.dictionary).to_numpy()
                    different, rank = coded.dictionary.take(pa.array(by_name)), np.empty(len(by_name) + 1, "i8")
                    rank[by_name], rank[-1] = np.arange(len(by_name)), -1
                    place = rank[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
                starts = np.cumsum([0] + [len(names_of[part]) for part in seen])
                for begin in range(0, len(keys), LIST_ROWS):
                    end, pairs = min(begin + LIST_ROWS, len(keys)), []
                    for start, (_, row, label) in zip(starts, found, strict=False):
                        of = slice(*np.searchsorted(row, [begin, end]))
                        named = place[start + label[of]]
                        pairs.append((row[of].astype("i8") * len(different) + named)[named >= 0])
                    pairs = np.unique(np.concatenate(pairs))
                    offsets = np.searchsorted(pairs, np.arange(begin, end + 1) * len(different))
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), different.take(pa.array(pairs % max(1, len(different)))))
                    yield pa.RecordBatch.from_arrays([keys.slice(begin, end - begin), lists], [key, "predicted"])
        if waiting:
            raise RuntimeError("a block of rows has not met all labels")

    columns = ["keys", "rows", "names", "vectors", "centre", "width", "own", "part"]
    return met.select(*columns).mapInArrow(gather, f"`{key}` {kind}, predicted array<string>")


def _gathered_lists(rows: DataFrame, bundles: DataFrame, threshold: float, key: str, vector: str) -> DataFrame:
    """``(key, predicted)`` for each different key, its labels brought together by a shuffle."""
    kind = rows.schema[key].dataType.simpleString()
    found = _pairs(_row_blocks(rows, key, vector, kind, BLOCK_ROWS), bundles, threshold, key, kind).select(key, "category")
    both = found.unionByName(rows.select(key, F.lit(None).cast("string").alias("category")))
    return both.groupBy(key).agg(F.sort_array(F.collect_set("category")).alias("predicted"))


def predicted_labels(
    rows: DataFrame, blocks: DataFrame, key: str, vector: str = "embedding", threshold: float = 0.3
) -> DataFrame:
    """``(key, predicted)``: the sorted labels at or above the threshold for each different key,
    ``["unknown"]`` for keys that have none.

    The lists of keys with one row are made without a shuffle, for up to ``TASK_BLOCKS`` blocks of
    labels; keys with several rows, and all keys if there are more blocks, are gathered by one.
    """
    blocks = stored(blocks, "label-blocks")
    n_blocks = blocks.count()
    if 0 < n_blocks <= TASK_BLOCKS:
        rows = spread(rows.select(key, vector))
        several = stored(rows.groupBy(key).count().filter("count > 1").select(F.col(key).alias("__several")), "several")
        again = F.col(key).eqNullSafe(F.col("__several"))
        once = rows.join(several, again, "left_anti")
        bare = once.filter(F.col(vector).isNull()).select(key, F.array().cast("array<string>").alias("predicted"))
        repeated = _gathered_lists(rows.join(several, again, "left_semi"), _bundles(blocks), threshold, key, vector)
        labels = _whole_lists(once, blocks, n_blocks, threshold, key, vector).unionByName(bare).unionByName(repeated)
    else:
        labels = _gathered_lists(rows, stored(_bundles(blocks), "label-bundles"), threshold, key, vector)
    return labels.select(key, F.when(F.size("predicted") > 0, F.col("predicted")).otherwise(F.array(F.lit(UNKNOWN))).alias("predicted"))


def best_labels(rows: DataFrame, blocks: DataFrame, key: str, vector: str = "embedding", threshold: float = 0.5) -> DataFrame:
    """``(key, category, similarity)``: the label with the highest similarity above the
    threshold for each key, on ties the first by name."""
    found = similar_labels(rows, blocks, threshold, key, vector).filter(F.col("similarity") > threshold)
    # The least of (-similarity, name): one aggregate, partial before the shuffle.
    best = found.groupBy(key).agg(F.min(F.struct((-F.col("similarity")).alias("down"), "category")).alias("best"))
    return best.select(key, "best.category", (-F.col("best.down")).alias("similarity"))
