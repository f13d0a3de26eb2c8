"""Near-duplicate texts by SimHash and fuzzy keys from the Golay code.

A fingerprint has 64 bits, of which up to two may differ. It is cut into segments of 23,
23 and 18 bits. The words of the binary Golay code lie so that any 23 bits have either
one or six of them within four errors, and two segments that differ in at most two bits
always share one; the numbers of those words are a segment's fuzzy keys. Two errors in
three segments leave at least one segment whole: the first (then the second's fuzzy keys
match), or the second (then the first's), or the third with one error in each of the
others. Each case is a table of keys that join a whole segment with fuzzy keys. What
shares a key is compared bit by bit.

Two bits reach texts that differ in a word or two. For a lower similarity of shingle sets
a text gets several fingerprints, each of a few shingles that are the least under a hash
of its own; texts of similarity s agree in all of one fingerprint's shingles with the
probability s to the power of their number. There a fingerprint's first segment and the
nearest code word of its second are the key, and what shares a key is compared by its
whole shingle sets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.components import components
from firmlens.llm.storage import stored

# The words, the hash's seed, and the generator polynomial of the Golay code
# (x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1).
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SEED = 42
GENERATOR = 0b110001110101
LENGTH, DIMENSION = 23, 12
MAX_ERRORS = 2

#: Fingerprints with one key that a task compares with each other; a larger group is
#: linked through the values one bit away from each instead.
GROUP = 2048
#: Fingerprints of a text for a lower similarity, shingles in each, and least hashes that a
#: row carries for a first comparison.
SAMPLES, SAMPLED = 14, 4
SKETCH = 48
#: Texts with one key that are compared at once, and the share of equal least hashes that
#: makes two of them candidates.
BLOCK = 512
LIKELY = 0.55
#: Texts with one key, and bytes of their shingle sets, in a part that is compared in full
#: with each other part of the key.
MEMBERS, SET_BYTES = 1024, 16 << 20
#: Shingles whose bits are summed at once.
PART = 1 << 16


def shingles(text: str, words: int) -> list[bytes]:
    """The lower-cased runs of ``words`` words, repeats included; a shorter text's whole sequence."""
    found = WORD.findall(text.translate(CAPITALS))
    if len(found) <= words:
        return [" ".join(found).encode()] if found else []
    joined = " ".join(found).encode()
    ends = np.cumsum([len(w.encode()) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [joined[a:b] for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def hashes(text: str, words: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles(text, words)], np.uint64)


def simhash(values: np.ndarray) -> int:
    """A bit is set if it is set in over half of the values; zero without values."""
    count = np.zeros(64, np.int64)
    for first in range(0, len(values), PART):
        part = values[first : first + PART].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(values), bitorder="little").view("<u8")[0]) if len(values) else 0


def fingerprints(docs: DataFrame, words: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)`` with the 64 bits as a signed integer, for each row of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(hashes(t, words)) for t in batch.column(1).to_pylist()]
            bits = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], [key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(work, f"`{key}` {kind}, fingerprint long")


@cache
def near_codewords() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every remainder by the generator: how many code words are within four errors, where
    they begin in the list, and the list of those errors."""
    place = np.arange(LENGTH)
    unit = 1 << place
    pairs = (unit[:, None] | unit[None, :])[np.triu_indices(LENGTH, 1)]
    patterns = [np.zeros(1, np.int64), unit, pairs]
    for _ in range(2):  # three and four errors: one more above the highest
        last = patterns[-1]
        top = np.floor(np.log2(last)).astype(int)
        patterns.append(np.concatenate([last[top < p] | (1 << p) for p in range(LENGTH)]))
    errors = np.concatenate(patterns)
    rest = remainder(errors)
    order = np.argsort(rest, kind="stable")
    count = np.bincount(rest, minlength=1 << (LENGTH - DIMENSION))
    return count, np.cumsum(count) - count, errors[order]


def remainder(values: np.ndarray) -> np.ndarray:
    out = values.astype(np.int64)
    for p in range(LENGTH - 1, LENGTH - DIMENSION - 1, -1):
        out = np.where(out >> p & 1, out ^ (GENERATOR << (p - (LENGTH - DIMENSION))), out)
    return out


def fuzzy(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fuzzy key of the 23-bit ``segments``: which segment has it, and the key, the
    number (of 12 bits) of a code word within four errors."""
    count, first, errors = near_codewords()
    rest = remainder(segments)
    own = count[rest]
    row = np.repeat(np.arange(len(segments)), own)
    at = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(first[rest], own)
    return row, (segments[row] ^ errors[at]) >> (LENGTH - DIMENSION)


def key_rows(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the fingerprints and the keys they have in the three tables."""
    low = (bits & np.uint64((1 << 23) - 1)).astype(np.int64)
    middle = (bits >> np.uint64(23) & np.uint64((1 << 23) - 1)).astype(np.int64)
    high = (bits >> np.uint64(46)).astype(np.int64)
    low_row, low_key = fuzzy(low)
    middle_row, middle_key = fuzzy(middle)
    rows = [middle_row, low_row, low_row]
    keys = [low[middle_row] << 12 | middle_key, middle[low_row] << 12 | low_key, high[low_row] << 12 | low_key]
    return np.concatenate(rows), np.concatenate([k << 2 | i for i, k in enumerate(keys)])


def _linked(bits: np.ndarray) -> np.ndarray:
    """The least index of each one's component among ``bits``, links being close ones."""
    close = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= MAX_ERRORS
    label = np.arange(len(bits))
    while True:
        lower = np.where(close, label[None, :], len(bits)).min(1)
        if np.array_equal(lower, label):
            return label
        label = lower


def _links_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the groups of a key from rows sorted by key and fingerprint. Of a group
    too large, ``b`` is null in the rows that are to be linked in another way."""
    held_key, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    spilled: int | None = None  # the key of a group too large

    def links(key: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(new, len(key)))
        two = new[size == 2]
        near = two[np.bitwise_count(bits[two] ^ bits[two + 1]) <= MAX_ERRORS]
        a, b = [bits[near + 1]], [bits[near]]
        for at, n in zip(new[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own = bits[at : at + n]
            label = _linked(own)
            moved = label != np.arange(n)
            a.append(own[moved])
            b.append(own[label[moved]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    def large(bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(bits.view(np.int64)), pa.nulls(len(bits), pa.int64())], ["a", "b"])

    for batch in batches:
        key = np.concatenate([held_key, batch.column(0).to_numpy()])
        bits = np.concatenate([held, batch.column(1).to_numpy().view(np.uint64)])
        if not len(key):
            continue
        if spilled is not None:
            own = key == spilled
            yield large(bits[own])
            key, bits = key[~own], bits[~own]
            if not len(key):
                held_key, held = key, bits
                continue
            spilled = None
        last = int(np.searchsorted(key, key[-1]))
        # Groups too large that lie whole in this batch.
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(new, len(key)))
        over = np.repeat(size > GROUP, size)
        if over.any():
            yield large(bits[over])
            if size[-1] > GROUP:
                spilled = int(key[-1])
        whole = np.arange(len(key)) < last
        if (whole & ~over).any():
            yield links(key[whole & ~over], bits[whole & ~over])
        rest = ~whole & ~over
        held_key, held = key[rest], bits[rest]
    if len(held_key):
        yield links(held_key, held)


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect exactly what chains of close ``fingerprint`` s connect.

    ``distinct`` has every fingerprint once. Within a key a component is returned as links
    to its least member, not as pairs.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            row, key = key_rows(bits)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(bits[row].view(np.int64))], ["key", "fingerprint"])

    keys = distinct.select("fingerprint").mapInArrow(keyed, "key long, fingerprint long")
    grouped = keys.repartition(F.col("key")).sortWithinPartitions("key", "fingerprint")
    found = stored(grouped.mapInArrow(_links_of_groups, "a long, b long"), "close")
    # Fingerprints are within two bits of each other if and only if a value exists that is
    # within one bit of both.
    one_bit = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    near = (
        found.filter("b is null").select("a").distinct()
        .select("a", F.explode(F.transform(one_bit, lambda m: F.col("a").bitwiseXOR(m))).alias("between"))
    )
    hubs = near.groupBy("between").agg(F.min("a").alias("b"), F.max("a").alias("most")).filter("b != most")
    return found.filter("b is not null").unionByName(near.join(hubs.drop("most"), "between").filter("a != b").select("a", "b"))


def _named_fingerprints(own: DataFrame, key: str) -> DataFrame:
    """``(fingerprint, first, component)`` of ``own(key, fingerprint)``: the smallest key of each
    different fingerprint and the fingerprint that names its component."""
    firsts = stored(own.groupBy("fingerprint").agg(F.min(key).alias("first")), "distinct")
    named = components(fingerprint_links(firsts)).withColumnRenamed("node", "fingerprint")
    return stored(firsts.join(named, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint")), "named")


def without_simhash_copies(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component of :func:`simhash_components`: the one with the
    smallest key (null before all), of rows with one key that with the smaller hash of its
    text. Rows equal in key and text count as one; all columns stay."""
    whole = F.coalesce(F.col(text), F.lit(""))
    one, two = F.xxhash64(F.col(key), whole), F.xxhash64(F.lit("row"), F.col(key), whole)
    rows = docs.select(F.struct(F.col(key).alias("k"), one.alias("one"), two.alias("two")).alias("id"), whole.alias("text"))
    own = stored(fingerprints(rows, words, "id", "text"), "fingerprints")
    kept = stored(_named_fingerprints(own, "id").groupBy("component").agg(F.min("first").alias("id")).select("id.one", "id.two"), "kept")
    numbered = docs.select(F.struct("*").alias("document"), one.alias("one"), two.alias("two"))
    return numbered.join(kept, ["one", "two"]).dropDuplicates(["one", "two"]).select("document.*")


def simhash_components(docs: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint, component_id)``: one row for each row of ``docs``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest key that
    links of at most two differing bits reach. A null or empty text has fingerprint zero
    and is linked like any other. A row with a null key is linked too, but its key names no
    component; repeated rows are in one component. Other columns are not read.
    """
    own = stored(fingerprints(docs, words, key, text), "fingerprints")
    joined = _named_fingerprints(own, key)
    least = stored(joined.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    ids = joined.join(least, "component").select("fingerprint", "component_id")
    return own.join(ids, "fingerprint").select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _multipliers(count: int) -> np.ndarray:
    """Odd numbers, one for each way to order hashes."""
    return np.array([xxhash.xxh64_intdigest(b"order %d" % i, SEED) | 1 for i in range(count)], np.uint64)


def nearest_codeword(segments: np.ndarray) -> np.ndarray:
    """The number of the code word within three errors of each segment, of which there is one."""
    count, first, errors = near_codewords()
    rest = remainder(segments)
    near = errors[first[rest]]
    for i in range(1, 6):  # of six code words the nearest one has three errors
        other = errors[np.minimum(first[rest] + i, len(errors) - 1)]
        better = (count[rest] > i) & (np.bitwise_count(other) < np.bitwise_count(near))
        near = np.where(better, other, near)
    return (segments ^ near) >> (LENGTH - DIMENSION)


def sample_keys(values: np.ndarray) -> np.ndarray:
    """A key for each sample of the (different) shingle hashes of a text."""
    fingerprint = np.zeros(SAMPLES, np.uint64)
    for i, odd in enumerate(_multipliers(SAMPLES)):
        order = values * odd
        order ^= order >> np.uint64(31)
        least = values[np.argpartition(order, SAMPLED - 1)[:SAMPLED]] if len(values) > SAMPLED else values
        fingerprint[i] = simhash(least)
    low = (fingerprint & np.uint64((1 << 23) - 1)).astype(np.int64)
    middle = (fingerprint >> np.uint64(23) & np.uint64((1 << 23) - 1)).astype(np.int64)
    return ((low << 12 | nearest_codeword(middle)) << 5) | np.arange(SAMPLES)


def sketch(values: np.ndarray) -> np.ndarray:
    """16 bits of the least hash in each of several orders."""
    if not len(values):
        return np.zeros(SKETCH, np.uint16)
    orders = _multipliers(SAMPLES + SKETCH)[SAMPLES:]
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(values), PART):
        mixed = values[first : first + PART, None] * orders[None, :]
        mixed ^= mixed >> np.uint64(29)
        least = np.minimum(least, mixed.min(0))
    return (least * orders >> np.uint64(48)).astype(np.uint16)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs to compare, from rows ``(key, node, sketch)`` sorted by key and node: each text
    with the most similar one before it among its key's texts, by their sketches. A key's texts
    are taken in blocks, into each of which the first and the best linked text go along. What
    these pairs leave apart is compared in full by :func:`_rest`."""

    def pairs(node: np.ndarray, sketches: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a, b = [], []
        kept = np.zeros(0, np.int64)
        for first in range(0, len(node), BLOCK):
            at = np.concatenate([kept, np.arange(first, min(first + BLOCK, len(node)))])
            own = sketches[at]
            alike = np.zeros((len(at), len(at)), np.int16)
            for i in range(SKETCH):
                alike += own[:, i, None] == own[None, :, i]
            earlier = np.tril(alike, -1)
            best = earlier.argmax(1)
            near = np.flatnonzero(earlier[np.arange(len(at)), best] >= LIKELY * SKETCH)
            near = near[near >= len(kept)]
            a.append(node[at[near]])
            b.append(node[at[best[near]]])
            kept = np.unique([at[0], at[(alike >= LIKELY * SKETCH).sum(1).argmax()]])
        return a, b

    def solve(key: np.ndarray, node: np.ndarray, sketches: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(new, len(key)))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        two = new[size == 2]
        two = two[(sketches[two] == sketches[two + 1]).sum(1) >= LIKELY * SKETCH]
        a.append(node[two + 1])
        b.append(node[two])
        for at, n in zip(new[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            more = pairs(node[at : at + n], sketches[at : at + n])
            a += more[0]
            b += more[1]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

    held: tuple[np.ndarray, ...] = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, SKETCH), np.uint16))
    for batch in batches:
        own = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, SKETCH)
        key, node, sketches = (
            np.concatenate(x) for x in zip(held, (batch.column(0).to_numpy(), batch.column(1).to_numpy(), own), strict=True)
        )
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield solve(key[:last], node[:last], sketches[:last])
        elif len(key) > 64 * BLOCK:  # one key fills the batches: its next block begins with the last rows
            yield solve(key, node, sketches)
            last = len(key) - BLOCK
        held = (key[last:], node[last:], sketches[last:])
    if len(held[0]):
        yield solve(*held)


def _untested(table: pa.Table) -> np.ndarray:
    """Which texts of two parts of a key are to be compared: their sketches are alike, no link
    connects them yet, and no earlier sample has them under one key."""
    sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, SKETCH)
    keys = np.array([k[:SAMPLES] for k in table["keys"].to_pylist()], np.int64)
    label, part = table["label"].to_numpy(), table["part"].to_numpy()
    alike = np.zeros((len(label), len(label)), np.int16)
    for i in range(SKETCH):
        alike += sketches[:, i, None] == sketches[None, :, i]
    out = (alike >= LIKELY * SKETCH) & (label[:, None] != label[None, :])
    if table["i"][0] != table["j"][0]:
        out &= part[:, None] != part[None, :]
    for i in range(min(table["key"][0].as_py() & 31, SAMPLES)):
        out &= keys[:, i, None] != keys[None, :, i]
    return out


def _compare(similarity: float):  # noqa: ANN202
    """A function of the texts of two parts of a key: links that connect all that are similar
    enough. The text with the most candidates is compared first, so that the others that it
    links need no comparison."""

    def work(table: pa.Table) -> pa.Table:
        wanted = _untested(table)
        sets = [np.frombuffer(v, np.uint64) for v in table["shingles"].to_pylist()]
        size = np.array([len(v) for v in sets])
        number = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(size)[:-1])
        there = np.zeros(size.sum() + 1, bool)
        node, label = table["node"].to_numpy(), table["label"].to_numpy().copy()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.argsort(-wanted.sum(1), kind="stable"):
            others = np.flatnonzero(wanted[i] & (label != label[i]))
            if not len(others):
                continue
            there[number[i]] = True
            shared = np.array([np.count_nonzero(there[number[o]]) for o in others])
            there[number[i]] = False
            good = others[shared >= similarity * (size[i] + size[others] - shared)]
            a.append(node[good])
            b.append(np.full(len(good), node[i]))
            label[np.isin(label, label[good])] = label[i]
        return pa.table([np.concatenate(x) for x in (a, b)], names=["a", "b"])

    return work


def _rest(texts: DataFrame, named: DataFrame) -> DataFrame:
    """``(key, i, j, part, node, label, sketch, keys)``: the texts still to be compared within
    parts ``i`` and ``j`` of a key. ``named`` tells what links connect so far.

    A key whose texts are all connected needs no more; nor does one of two texts, which were
    compared. The texts of the others are dealt to parts of bounded size, each of which meets
    each, and those go on that have a likely copy that nothing connects to them.
    """
    asked = texts.join(named, "node", "left").select(
        "node", F.coalesce("component", "node").alias("label"), "sketch", "keys", "size", F.explode("keys").alias("key")
    )
    parts = F.greatest(F.ceil(F.col("n") / MEMBERS), F.ceil(F.col("total") * 8 / SET_BYTES)).cast("int")
    mixed = stored(
        asked.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("n > 2 and low != high").select("key", parts.alias("parts")),
        "mixed",
    )
    dealt = asked.join(mixed, "key").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    met = dealt.withColumn("other", other).select(
        "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "label", "sketch", "keys"
    )
    return met.groupBy("key", "i", "j").applyInArrow(lambda t: t.filter(pa.array(_untested(t).any(1))), met.schema)


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(k, digest, node, keeper)`` for each row of ``docs``: texts that chains of ``similarity``
    or more connect have one ``node``; ``keeper`` says whether the row is the first of them by
    key and digest, ``(xxhash64(key, text), hash(text))``, of which repeated rows share one.

    Texts of the same lower-cased words are equal. Others are linked if the Jaccard
    similarity of their shingle sets, worked out in full for every candidate pair that other
    links do not connect, is high enough. Candidates come from sampled fingerprints, so that
    a pair may be missed: with the defaults in 1 of 1,500 cases at 0.8 and less often above.
    Texts of few shingles are missed more often: those of 4 and 5 shingles (similarity 4/5)
    agree in a sample with the probability 1/5, and are missed in 0.8^14 = 4.4 % of cases.
    Null and empty texts are equal to each other.
    """
    digest = xxhash.xxh64_intdigest
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.xxhash64(F.col(key), whole).alias("k"), F.hash(whole).alias("digest"), F.col(key).alias("id"), whole.alias("text"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, keys, sketches, sizes = [], [], [], []
            for t in batch.column(3).to_pylist():
                joined = " ".join(WORD.findall(t.translate(CAPITALS))).encode()
                nodes.append(digest(joined, SEED))
                values = np.unique(hashes(t, words))
                keys.append(sample_keys(values).tolist())
                sketches.append(sketch(values).tobytes())
                sizes.append(len(values))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(3)], pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(sizes, pa.int64()),
                ],
                ["k", "digest", "id", "node", "keys", "sketch", "size"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = stored(own.mapInArrow(keyed, f"k long, digest int, id {kind}, node long, keys array<long>, sketch binary, size long"), "copies")
    # Of equal texts the first row stands for all.
    texts = stored(
        rows.groupBy("node").agg(
            F.min(F.struct("id", "digest", "k")).alias("first"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"),
            F.first("size").alias("size"),
        ),
        "texts",
    )
    asked = texts.select(F.explode("keys").alias("key"), "node", "sketch").repartition(F.col("key")).sortWithinPartitions("key", "node")
    pairs = stored(asked.mapInArrow(_candidates, "a long, b long").filter("a != b").distinct(), "pairs")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(hashes(t, words)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "shingles"])

    def with_sets(nodes: DataFrame) -> DataFrame:
        chosen = texts.join(nodes.select("node").distinct(), "node").select("node", "first.k", "first.digest")
        texts_of = own.select("k", "digest", "text").join(chosen, ["k", "digest"]).select("node", "text")
        return stored(texts_of.mapInArrow(sets, "node long, shingles binary").dropDuplicates(["node"]), "shingles")

    found = with_sets(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))))
    both = (
        pairs.join(found.select(F.col("node").alias("a"), F.col("shingles").alias("one")), "a")
        .join(found.select(F.col("node").alias("b"), F.col("shingles").alias("other")), "b")
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(one, other, assume_unique=True))
                good.append(shared >= similarity * (len(one) + len(other) - shared))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    links = both.select("a", "b", "one", "other").mapInArrow(compared, "a long, b long")
    named = components(links)
    rest = stored(_rest(texts, named), "rest")
    if not rest.isEmpty():
        groups = rest.join(with_sets(rest), "node").groupBy("key", "i", "j")
        more = groups.applyInArrow(_compare(similarity), "a long, b long")
        named = components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    joined = stored(
        texts.select("node", "first").join(named, "node", "left").withColumn("component", F.coalesce("component", "node")), "named"
    )
    least = stored(joined.groupBy("component").agg(F.min("first").alias("least")), "least")
    ids = joined.join(least, "component").select("node", F.col("component"), "least")
    mine = F.struct("id", "digest", "k")
    return rows.select("k", "digest", "id", "node").join(ids, "node").select(
        "k", "digest", F.col("component").alias("node"), (mine == F.col("least")).alias("keeper")
    )


def without_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of :func:`near_copies`: the one with the smallest
    key (null before all). Rows equal in key and text count as one; all columns stay."""
    kept = near_copies(docs, words, similarity, key, text).filter("keeper").select("k", "digest").distinct()
    whole = F.coalesce(F.col(text), F.lit(""))
    numbered = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(key), whole).alias("k"), F.hash(whole).alias("digest"))
    return numbered.join(stored(kept, "kept"), ["k", "digest"]).dropDuplicates(["k", "digest"]).select("row.*")
