"""Removal of long strings that repeat anywhere in a corpus.

Every window of ``window`` bytes has a mark: among its shorter strings of a fixed length
the one with the least hash. Equal windows have equal marks, so only marks that occur again are looked
at. A mark's windows follow each other; their bytes are its context. Equal contexts are
counted, and one of each goes on. Different contexts of one mark meet in a task, which
makes the suffix array of their windows with the longest common prefixes of neighbours. In
suffix order the previous and the next smaller place of a window give the longest factor
that stands earlier; the window is a copy if that factor is as long as itself. A mark with
too many different contexts is split before: into blocks of windows with a common core, and
these into single windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.storage import Stored, stored

#: Bytes of the shortest window, and bits of a mark's hash that make room for its place.
SHORTEST = 48
PLACE_BITS = 24
#: Windows of a text that are looked at together.
CHUNK = 1 << 20
#: Different contexts of one mark that a task compares, bytes of contexts sorted at once,
#: and windows in a block of those that are too many.
GROUP = 2048
SORT_BYTES = 1 << 20
#: Texts whose marks are looked for together, and bytes of contexts that leave a task together.
SLICE, OUT_BYTES = 500, 4 << 20
BLOCK = 32
# Multipliers of the hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every string of ``size`` bytes (a power of two)."""
    value = (data.astype(np.uint64) + np.uint64(1)) * MIX
    value ^= value >> np.uint64(32)
    power, width = BASE, 1
    while width < size:
        value = value[:-width] * power + value[width:]
        with np.errstate(over="ignore"):
            power = power * power
        width *= 2
    value ^= value >> np.uint64(32)
    value *= MIX
    value ^= value >> np.uint64(29)
    return value


def sliding_min(value: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        value = np.minimum(value[:-done], value[done:])
        done *= 2
    return np.minimum(value[: len(value) - (width - done)], value[width - done :]) if width > done else value


def mark_size(window: int) -> int:
    """Bytes of a mark: a power of two, at most a third of the window."""
    return 1 << ((window // 3).bit_length() - 1)


def marks(data: bytes, window: int) -> np.ndarray:
    """Rows of hash, place, first and last: each mark, and the first and last window that has it.

    Of equal marks in a window the first counts. The windows of a long text are looked at
    in chunks, which may cut a mark's windows in two.
    """
    array, size = np.frombuffer(data, np.uint8), mark_size(window)
    found = [np.zeros((4, 0), np.int64)]
    for begin in range(0, len(data) - window + 1, CHUNK):
        hashes = string_hashes(array[begin : begin + CHUNK + window - 1], size)
        keyed = hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_min(keyed, window - size + 1)
        first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        last = np.append(first[1:], len(least)) - 1
        place = (least[first] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        found.append(np.stack([hashes[place].view(np.int64), place + begin, first + begin, last + begin]))
    return np.concatenate(found, 1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


#: Two hashes of 64 bits tell the texts of one key apart.
DIGEST = "digest struct<one: long, two: long>"


def digest(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("one"), F.xxhash64(F.lit("text"), text).alias("two"))


ROW = f"{DIGEST}, mark long, context long, place int, first int, last int"


def _contexts(docs: DataFrame, window: int, kind: str) -> DataFrame:
    """A row for each mark of ``docs(k, digest, text)`` with a hash of its context."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh3_64_intdigest
        for batch in _slices(batches):
            sizes, found, context = [], [np.zeros((4, 0), np.int64)], []
            for value in batch.column(2).cast(pa.binary()):
                data = value.as_py()
                own = marks(data, window)
                sizes.append(own.shape[1])
                found.append(own)
                spans = zip(*own[1:].tolist(), strict=True)
                context += [hashed(data[first : last + window], place - first) for place, first, last in spans]
            mark, place, first, last = np.concatenate(found, 1)
            at = pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), batch.column(1).take(at), pa.array(mark), pa.array(np.array(context, np.uint64).view(np.int64)),
                    *[pa.array(v.astype(np.int32)) for v in (place, first, last)],
                ],
                ["k", "digest", "mark", "context", "place", "first", "last"],
            )

    return docs.mapInArrow(work, f"k {kind}, {ROW}")


def _with_text(rows: DataFrame, docs: DataFrame, window: int, kind: str) -> DataFrame:
    """``rows`` with the ``bytes`` of their contexts."""
    fields = ["mark", "place", "first", "last", "copies"]
    own = rows.groupBy("k", "digest").agg(F.collect_set(F.struct(*fields)).alias("m"))
    one = docs.join(own, docs["k"].eqNullSafe(own["k"]) & (docs["digest"] == own["digest"])).select(docs["k"], docs["digest"], "text", "m")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(batch: pa.RecordBatch, rows: list[int], at: list[int], parts: list[bytes]) -> pa.RecordBatch:
            own = batch.column(3).flatten().take(pa.array(at, pa.int64()))
            keys = pa.array(rows, pa.int32())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(keys), batch.column(1).take(keys), *[own.field(f) for f in fields], pa.array(parts, pa.binary())],
                ["k", "digest", *fields, "bytes"],
            )

        for batch in batches:
            own = batch.column(3).flatten()
            first, last = own.field("first").to_numpy(), own.field("last").to_numpy()
            rows, at, parts, size, n = [], [], [], 0, 0
            for row, count in enumerate(pc.list_value_length(batch.column(3)).to_pylist()):
                data = batch.column(2)[row].as_py().encode()
                for i in range(n, n + count):
                    rows.append(row)
                    at.append(i)
                    parts.append(data[first[i] : last[i] + window])
                    size += len(parts[-1])
                    if size >= OUT_BYTES:
                        yield part(batch, rows, at, parts)
                        rows, at, parts, size = [], [], [], 0
                n += count
            yield part(batch, rows, at, parts)

    # Repeated rows of one key and text have the same contexts: one of them is enough.
    return one.mapInArrow(
        cut, f"k {kind}, {DIGEST}, mark long, place int, first int, last int, copies long, bytes binary"
    ).dropDuplicates(["k", "digest", "mark", "first"])


class Suffixes(NamedTuple):
    """Suffixes at some places, by their first ``window`` bytes: indices into the places in
    suffix order (equal ones by place), and the longest common prefix of each with the one
    before it, ``window`` at most."""

    order: np.ndarray
    common: np.ndarray


def _ranks(value: np.ndarray) -> np.ndarray:
    return np.unique(value, return_inverse=True)[1].astype(np.int32)


def suffix_array(data: np.ndarray, places: np.ndarray, window: int) -> Suffixes:
    """The suffix array of ``data`` at ``places``, each with ``window`` bytes behind it.

    Ranks of strings of 8, 16, 32 ... bytes come from those of half the length. The common
    prefix of two suffixes is read off the same ranks, the longest first, and at last off
    single bytes.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.zeros(len(data), np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | padded[i : i + len(data)]
    levels, width = [(8, _ranks(word))], 8
    del word
    while 2 * width <= window:
        rank = levels[-1][1]
        pair = rank.astype(np.int64) * (len(data) + 1)
        pair[: len(data) - width] += rank[width:]
        width *= 2
        levels.append((width, _ranks(pair)))
    top = levels[-1][1]
    order = np.argsort(top[places].astype(np.int64) * (len(data) + 1) + top[places + window - width], kind="stable")
    here, before = places[order[1:]].astype(np.int64), places[order[:-1]].astype(np.int64)
    common = np.zeros(len(here), np.int64)
    for width, rank in reversed(levels):
        room = common + width <= window
        common[room] += width * (rank[here[room] + common[room]] == rank[before[room] + common[room]])
    for _ in range(8 + window % 8):
        room = common < window
        more = room.copy()
        more[room] = data[here[room] + common[room]] == data[before[room] + common[room]]
        if not more.any():
            break
        common += more
    return Suffixes(order, np.append(0, common)[: len(order)])


def smaller_places(order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a suffix order the previous one that is smaller (-1: none), as an index
    into the order, and the longest common prefix with it.

    All look at once: whoever meets a larger place goes on to where that one looks.
    """
    n = len(order)
    at = np.arange(-1, n - 1)
    shared = common.copy()
    going = np.flatnonzero(at >= 0)
    going = going[order[at[going]] > order[going]]
    while len(going):
        met = at[going]
        # Read before written: all take the step from what was known before it.
        step, least = at[met], np.minimum(shared[going], shared[met])
        at[going], shared[going] = step, least
        going = going[step >= 0]
        going = going[order[at[going]] > order[going]]
    shared[at < 0] = 0
    return at, shared


def longest_previous(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """For each place, in the order of places: the longest factor there that also stands at
    a smaller place (up to the window), and the index of such a place (-1: none)."""
    order, common = suffixes
    n = len(order)
    before, left = smaller_places(order, common)
    # The next smaller place is the previous one in the order read backward.
    after, right = smaller_places(order[::-1], np.append(0, common[:0:-1])[:n])
    after, right = np.where(after >= 0, n - 1 - after, -1)[::-1], right[::-1]
    nearer = left >= right
    source = np.where(nearer, before, after)
    factor, earlier = np.zeros(n, np.int64), np.full(n, -1)
    factor[order] = np.maximum(left, right)
    earlier[order] = np.where(source >= 0, order[source], -1)
    return factor, earlier


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of consecutive numbers."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.append(True, np.diff(starts) != 1))
    return list(zip(starts[new].tolist(), starts[np.append(new[1:], len(starts)) - 1].tolist(), strict=True))


SPAN = f"{DIGEST}, begin int, end int"


def _factors(contexts: DataFrame, window: int, keep_first: bool, kind: str) -> DataFrame:
    """Spans ``(k, digest, begin, end)`` of copies among the contexts of each mark."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        parts = table["bytes"].to_pylist()
        first, last = table["first"].to_numpy(), table["last"].to_numpy()
        copies = table["copies"].to_numpy()
        size = np.array([len(p) for p in parts], np.int64)
        at = np.cumsum(size) - size
        count = last - first + 1
        row = np.repeat(np.arange(len(parts)), count)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        data = np.frombuffer(b"".join(parts), np.uint8)
        factor, earlier = longest_previous(suffix_array(data, at[row] + offset, window))
        copy = factor >= window
        out = copy.copy()
        if not keep_first:
            # What a copy is found at has a copy itself.
            out[earlier[copy]] = True
            out |= copies[row] > 1
        rows, spans = [], []
        bounds = np.append(np.searchsorted(row, np.arange(len(parts))), len(row))
        for i in np.unique(row[out]).tolist():
            own = slice(bounds[i], bounds[i + 1])
            for a, b in _runs(offset[own][out[own]] + first[i]):
                rows.append(i)
                spans.append((a, b + window))
        taken = table.select(["k", "digest"]).combine_chunks().take(pa.array(rows, pa.int64()))
        begin, end = zip(*spans, strict=True) if spans else ([], [])
        return pa.RecordBatch.from_arrays(
            [*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in taken.columns], pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
            ["k", "digest", "begin", "end"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(2).to_numpy()
            ends = np.flatnonzero(np.append(key[1:] != key[:-1], True)) + 1
            if held and held[-1].column(2)[-1].as_py() != key[0] and size >= SORT_BYTES:
                yield solve(held)
                held, size = [], 0
            begin = 0
            total = np.cumsum(pc.binary_length(batch.column(7)).to_numpy(), dtype=np.int64)
            for i, end in enumerate(ends.tolist()):
                own = total[end - 1] - (total[begin - 1] if begin else 0)
                if size + own >= SORT_BYTES and i < len(ends) - 1:
                    held.append(batch.slice(begin, end - begin))
                    yield solve(held)
                    held, size, begin = [], 0, end
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
                size += total[-1] - (total[begin - 1] if begin else 0)
        if held:
            yield solve(held)

    # Within a mark the contexts stand as in the corpus: by key, digest and place.
    dealt = contexts.repartition(F.col("mark")).sortWithinPartitions("mark", "k", "digest", "first")
    return dealt.select("k", "digest", "mark", "place", "first", "last", "copies", "bytes").mapInArrow(work, f"k {kind}, {SPAN}")


def _blocks(contexts: DataFrame, window: int, kind: str) -> DataFrame:
    """Blocks of windows at fixed distances from the mark, by the core that all their windows hold."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, found = [], []
            for row, (place, first, last, data) in enumerate(zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 7)), strict=True)):
                for block in range((first - place) // BLOCK, (last - place) // BLOCK + 1):
                    base = place + block * BLOCK
                    a, b = max(first, base), min(last, base + BLOCK - 1)
                    core = xxhash.xxh3_128_intdigest(data[base + BLOCK - 1 - first : base + window - first], block & 0xFFFF)
                    own = data[a - first : b + window - first]
                    rows.append(row)
                    found.append((_signed(core >> 64), _signed(core & (1 << 64) - 1), _signed(xxhash.xxh3_64_intdigest(own, a - base)), a, b, own))
            at = pa.array(rows, pa.int32())
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = zip(*found, strict=True) if found else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(at) for i in (0, 1, 6)], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["k", "digest", "copies", "core1", "core2", "whole", "first", "last", "bytes"],
            )

    return contexts.select("k", "digest", "mark", "place", "first", "last", "copies", "bytes").mapInArrow(
        work, f"k {kind}, {DIGEST}, copies long, core1 long, core2 long, whole long, first int, last int, bytes binary"
    )


def _windows(blocks: DataFrame, window: int, kind: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = 1 << (window.bit_length() - 1)
        for batch in _slices(batches):
            rows, one, two, starts = [], [], [], []
            for row, (first, last, data) in enumerate(zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), strict=True)):
                value = string_hashes(np.frombuffer(data, np.uint8), half)
                count = last - first + 1
                rows.append(np.full(count, row))
                one.append(value[:count])
                two.append(value[window - half : window - half + count])
                starts.append(np.arange(first, last + 1))
            at = pa.array(np.concatenate(rows) if rows else [], pa.int64())
            values = [np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (one, two, starts)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(at) for i in range(3)], *[pa.array(v) for v in values]],
                ["k", "digest", "copies", "hash1", "hash2", "start"],
            )

    return blocks.select("k", "digest", "copies", "first", "last", "bytes").mapInArrow(
        work, f"k {kind}, {DIGEST}, copies long, hash1 long, hash2 long, start long"
    )


def _split(contexts: DataFrame, window: int, keep_first: bool, kind: str) -> DataFrame:
    """Spans of copies among contexts of marks that have too many for one task."""
    place = F.struct("k", "digest", "first")
    blocks = _blocks(contexts, window, kind)
    core = ["core1", "core2"]
    again = stored(
        blocks.groupBy(*core).agg(
            F.sum("copies").alias("total"), F.min("whole").alias("low"), F.max("whole").alias("high"), F.min(place).alias("least")
        ).filter("total > 1"),
        "cores",
    )
    known = Stored(blocks.join(again, core), "blocks")
    alike = F.col("low") == F.col("high")
    whole = known.table.filter(alike)
    if keep_first:
        whole = whole.filter(place != F.col("least"))
    single = Stored(_windows(known.table.filter(~alike), window, kind), "windows")
    own = F.struct("k", "digest", "start")
    # Written, so that the join deals both sides anew and a frequent window is split.
    repeated = stored(
        single.table.groupBy("hash1", "hash2").agg(F.sum("copies").alias("total"), F.min(own).alias("least")).filter("total > 1"), "windows-again"
    )
    found = single.table.join(repeated, ["hash1", "hash2"])
    if keep_first:
        found = found.filter(own != F.col("least"))
    return whole.select("k", "digest", F.col("first").alias("begin"), (F.col("last") + window).alias("end")).unionByName(
        found.select("k", "digest", F.col("start").cast("int").alias("begin"), (F.col("start") + window).cast("int").alias("end"))
    )


def repeated_spans(docs: DataFrame, window: int, keep_first: bool, kind: str) -> DataFrame:
    """``(k, digest, spans)`` of ``docs(k, digest, text)``: byte ranges that copies cover."""
    if window < SHORTEST:
        raise ValueError(f"a window has {SHORTEST} bytes at least")
    contexts = _contexts(docs, window, kind)
    place = F.struct("k", "digest", "first")
    rows = Stored(contexts.distinct() if keep_first else contexts, "contexts")
    again = rows.table.groupBy("mark").agg(
        F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high"), F.min(place).alias("least")
    ).filter("n > 1")
    # Written, so that the join deals both sides anew and a frequent mark is split.
    again = Stored(again.drop("n"), "again")
    known = Stored(rows.table.join(again.table, "mark"), "repeated")
    rows.drop()
    again.drop()
    alike = F.col("low") == F.col("high")

    def span(table: DataFrame) -> DataFrame:
        return table.select("k", "digest", F.col("first").alias("begin"), (F.col("last") + window).alias("end"))

    whole = known.table.filter(alike)
    if keep_first:
        whole = whole.filter(place != F.col("least"))
    # One of each different context goes on; the others are copies of it.
    mixed = known.table.filter(~alike)
    different = Stored(
        mixed.groupBy("mark", "context").agg(F.count("*").alias("copies"), F.min(F.struct("k", "digest", "first", "last", "place")).alias("r"))
        .select("mark", "context", "copies", "r.*"),
        "different",
    )
    copied = different.table.filter("copies > 1").select("mark", "context", F.struct("k", "digest", "first").alias("kept"))
    copies = mixed.join(copied, ["mark", "context"]).filter(place != F.col("kept"))
    many = stored(different.table.groupBy("mark").count().filter(F.col("count") > GROUP).select("mark"), "many")
    texts = Stored(_with_text(different.table, docs, window, kind), "texts")
    found = _factors(texts.table.join(many, "mark", "left_anti"), window, keep_first, kind)
    if not many.isEmpty():
        found = found.unionByName(_split(texts.table.join(many, "mark", "left_semi"), window, keep_first, kind))
    spans = span(whole).unionByName(span(copies)).unionByName(found)
    # Rows equal in key and text have the same spans: a set has at most those of one text.
    return spans.groupBy("k", "digest").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Ranges in order, joined where they overlap or touch."""
    if not len(begin):
        return []
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
    return list(zip(begin[new].tolist(), end[np.append(new[1:], len(begin)) - 1].tolist(), strict=True))


def _ranges(spans: pa.Array) -> Iterator[list[tuple[int, int]]]:
    """For each row of a list column its ranges, none for a null."""
    flat = spans.flatten()
    begin, end = (flat.field(name).to_numpy().astype(np.int64) for name in ("begin", "end"))
    at = 0
    for size in pc.fill_null(pc.list_value_length(spans), 0).to_pylist():
        yield merged(begin[at : at + size], end[at : at + size])
        at += size


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE):
            yield batch.slice(begin, SLICE)


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("k"), digest(whole).alias("digest"), whole.alias("text"))


def remove_repeats(
    docs: DataFrame, window: int = 400, keep_first: bool = True, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept)``: one row for each row of ``docs``.

    Texts are taken as UTF-8 bytes. A byte goes if it lies in a string of ``window`` bytes
    that occurs elsewhere: with ``keep_first`` earlier (in the order of key, a digest of
    the text, and place), else anywhere. Strings are judged on the input; matches do not
    cross texts. ``n_spans`` counts maximal removed ranges, and ``kept`` is what is left.

    A null text is an empty one and loses nothing. Rows that are equal in key and text are
    one text to ``keep_first`` and lose the same; otherwise each is a copy of the other. A
    null key stands before all others. Other columns are not read. ``window`` is at least 48.
    """
    own = _numbered(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    spans = repeated_spans(own, window, keep_first, kind)
    joined = own.join(spans, own["k"].eqNullSafe(spans["k"]) & (own["digest"] == spans["digest"]), "left").select(own["k"], "text", "spans")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = []
            for data, ranges in zip(batch.column(1).cast(pa.binary()).to_pylist(), _ranges(batch.column(2)), strict=True):
                left, done = [], 0
                for a, b in ranges:
                    left.append(data[done:a])
                    done = b
                left.append(data[done:])
                found.append((len(data), sum(b - a for a, b in ranges), len(ranges), b"".join(left)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = zip(*found, strict=True) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                [key, "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(work, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def whole_characters(data: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges without the bytes of characters that they only cut."""

    def forward(at: int) -> int:
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        return at

    def back(at: int) -> int:
        while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return at

    cut = [(forward(a), back(b)) for a, b in ranges]
    return [(a, b) for a, b in cut if a < b]


def without_repeats(docs: DataFrame, window: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later copies of strings of ``window`` bytes taken out of its texts, as
    :func:`remove_repeats` finds them. Characters that a range cuts stay whole. All rows and
    columns stay; a null text stays null."""
    own = _numbered(docs, key, text)
    spans = repeated_spans(own, window, True, docs.schema[key].dataType.simpleString())
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).alias("own"), digest(whole).alias("own_digest"))
    joined = rows.join(spans, rows["own"].eqNullSafe(spans["k"]) & (rows["own_digest"] == spans["digest"]), "left")
    joined = joined.select("row", "spans")
    at, docs_names = docs.columns.index(text), docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = []
            columns = batch.column(0).flatten()
            for value, found in zip(columns[at].to_pylist(), _ranges(batch.column(1)), strict=True):
                if found and value:
                    data, left, done = value.encode(), [], 0
                    for a, b in whole_characters(data, found):
                        left.append(data[done:a])
                        done = b
                    value = b"".join([*left, data[done:]]).decode()
                texts.append(value)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, docs_names)

    return joined.mapInArrow(work, docs.schema)
