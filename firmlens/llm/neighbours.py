"""Nearest neighbours by a permutation index.

A vector is represented by the order of the pivots by their nearness to it. It is posted
in the inverted files of its nearest pivots. A query reads the files of its own nearest
pivots, ranks what they hold by the footrule distance of the two orders, first of places
rounded to fifths and then of the places, and compares the first of that ranking by the
original vectors. The index is dealt by vectors: a part holds all files of some thousand
vectors, so that a ranking goes over all files that a query reads, and no file is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmlens.llm.storage import stored

#: Pivots, a sample of the vectors (at most 256: an order is one byte for each).
PIVOTS = 256
#: Files that a vector is posted in, and files that a query reads.
POSTED, READ = 8, 48
#: Vectors compared for a query: this many times the root of all vectors, and at least.
COMPARED_ROOT, COMPARED_LEAST = 10, 256
#: Vectors ranked by their places, for each that is compared.
RANKED = 2
#: Vectors of a part of the index, and queries that meet a part at once.
PART, QUERIES_AT_ONCE = 8192, 2048
#: Bits of a rounded place.
STEPS = 4


def valid(vector: Column) -> Column:
    """Not null, not zero, without null or non-finite components."""
    number = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(number, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(number, lambda v: v != 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _places(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The place of each pivot in the order of the pivots from the nearest on."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    place = np.empty(order.shape, np.uint8)
    np.put_along_axis(place, order, np.arange(len(pivots), dtype=np.uint8)[None, :].repeat(len(vectors), 0), 1)
    return place


def _indexed(distinct: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = _places(_matrix(batch.column(1), pivots.shape[1]), pivots)
                places = pa.array([row.tobytes() for row in place], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, places], ["node", "vector", "ids", "place"])

    return distinct.mapInArrow(work, f"node long, vector {kind}, ids array<long>, place binary")


def _rounded(place: np.ndarray) -> np.ndarray:
    """Places rounded to steps, one bit for each step reached: differing bits of two rows
    add up to the footrule distance of the rounded places, in steps."""
    pivots = place.shape[1]
    bits = np.concatenate([place >= pivots * k / (STEPS + 1) for k in range(1, STEPS + 1)], axis=1)
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def _estimate(distance: np.ndarray, unrelated: float, norm: np.ndarray) -> np.ndarray:
    """What an inner product is about by a footrule distance: the norm for 0, 0 for that of
    unrelated orders. For equal norms this is the ranking by distance."""
    return norm * (1 - distance / unrelated)


def _first(value: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` largest values."""
    return np.arange(len(value)) if count >= len(value) else np.argpartition(-value, count - 1)[:count]


def _search(size: int, most: int, compared: int):  # noqa: ANN202
    """A function of a part of the index and queries: the best of each query in that part.

    Vectors with no key but the query's own are out before anything is cut. Ties go to the
    smallest other key."""
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def work(indexed: pa.Table, asked: pa.Table) -> pa.Table:
        if not indexed.num_rows or not asked.num_rows:
            return schema.empty_table()
        vectors, queries = (_matrix(t["v"].combine_chunks(), size) for t in (indexed, asked))
        node, query = indexed["node"].to_numpy(), asked["query"].to_numpy()
        least, second, asks = indexed["least"].to_numpy(), indexed["second"].to_numpy(), asked["query_id"].to_numpy()
        place, own = (np.frombuffer(b"".join(t["p"].to_pylist()), np.uint8).reshape(t.num_rows, -1) for t in (indexed, asked))
        rounded, own_rounded = _rounded(place), _rounded(own)
        largest = np.abs(vectors).max(1)
        norm = largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(1))
        pivots = place.shape[1]
        share = np.arange(1, STEPS + 1) / (STEPS + 1)
        unrelated, unrelated_bits = max(1.0, (pivots**2 - 1) / 3), pivots * 2 * (share * (1 - share)).sum()
        # The inverted files of this part, one after the other.
        file, row = np.nonzero((place < POSTED).T)
        begin = np.searchsorted(file, np.arange(pivots + 1))
        out = []
        for i in range(len(query)):
            held = np.zeros(len(node), bool)
            for pivot in np.flatnonzero(own[i] < READ).tolist():
                held[row[begin[pivot] : begin[pivot + 1]]] = True
            others = (least != asks[i]) | (second != asks[i])
            near = np.flatnonzero(held & others)
            if len(near) < most:  # the files hold too few: all of the part
                near = np.flatnonzero(others)
            if compared < len(near):
                steps = np.bitwise_count(rounded[near] ^ own_rounded[i]).sum(1, dtype=np.int64)
                near = near[_first(_estimate(steps, unrelated_bits, norm[near]), RANKED * compared)]
                there = place[near]
                footrule = (np.maximum(there, own[i]) - np.minimum(there, own[i])).sum(1, dtype=np.int64)
                near = near[_first(_estimate(footrule, unrelated, norm[near]), compared)]
            score = vectors[near] @ queries[i]
            other = np.where(least[near] == asks[i], second[near], least[near])
            best = near[np.lexsort((other, -score))[:most]]
            out.append((np.full(len(best), query[i]), node[best], vectors[best] @ queries[i]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], schema=schema)

    return work


def nearest(
    table: DataFrame, is_query: Column, count: int = 20, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each row with ``is_query`` the ``count`` rows
    with the largest inner products that the index finds, in double precision, ties to the
    smaller key; rows with the query's own key are not among them.

    Null and zero vectors, those with null or non-finite components, and rows without a key
    take no part. Vectors of one length are compared with each other only. Rows equal in key
    and vector are one row. Equal vectors are indexed once and all found; a key with several
    vectors of one length asks with each of them and ranks what each finds. All vectors are
    indexed; only the pivots are a sample, the ``pivots`` different vectors with the smallest
    hashes. Other columns are not read. An empty table gives an empty result.
    """
    rows = table.select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    ).filter(F.col("id").isNotNull() & valid(F.col(vector)))
    kind = table.schema[vector].dataType.simpleString()
    found = None
    for own in rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").collect():
        of_size = _nearest_of_size(rows.filter(F.size("vector") == own["size"]), own["size"], kind, count, min(pivots, 256))
        found = of_size if found is None else found.unionByName(of_size)
    return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double") if found is None else found


def _nearest_of_size(rows: DataFrame, size: int, kind: str, count: int, pivots: int) -> DataFrame:
    """The result for ``rows(id, vector, asks)``, all of whose vectors have ``size`` numbers."""
    # Of equal vectors the smallest keys are enough: one more than are asked for.
    by_vector = Window.partitionBy("vector").orderBy("id")
    firsts = rows.select("vector", "id").distinct().withColumn("n", F.row_number().over(by_vector)).filter(F.col("n") <= count + 1)
    distinct = firsts.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    numbered = distinct.select(F.col("ids")[0].alias("node"), "vector", "ids")
    # Vectors that share their smallest key (a repeated key) are told apart by a hash.
    numbered = stored(
        numbered.withColumn("node", F.xxhash64("node", "vector")), "vectors"
    )
    sample = numbered.orderBy(F.xxhash64("vector"), "vector").limit(pivots).select("vector").collect()
    index = stored(_indexed(numbered, np.array([r.vector for r in sample], np.float64), kind), "index")

    asking = rows.filter("asks").select(F.col("id").alias("query_id"), "vector").distinct()
    # Each key of a vector asks by itself, since the rows that are its own differ.
    asking = stored(
        asking.join(index, "vector").select("query_id", "vector", "place", "node", F.xxhash64("query_id", "node").alias("query")), "queries"
    )
    vectors = index.count()
    parts, groups = max(1, -(-vectors // PART)), max(1, -(-asking.count() // QUERIES_AT_ONCE))
    # Parts are dealt by a hash: each holds about its share of the vectors to be compared.
    share = max(COMPARED_LEAST, COMPARED_ROOT * math.sqrt(vectors)) / parts
    compared = max(count, math.ceil(share + 3 * math.sqrt(share)))

    def dealt(table: DataFrame, own: str, keys: list, names: tuple[str, str], numbers: tuple[int, int]) -> DataFrame:
        """Each row in its own part or group, once for each of the other side."""
        return table.select(
            own, *keys, F.col("vector").alias("v"), F.col("place").alias("p"),
            F.pmod(F.xxhash64(own), F.lit(numbers[0])).cast("int").alias(names[0]),
            F.explode(F.sequence(F.lit(0), F.lit(numbers[1] - 1))).alias(names[1]),
        )

    two = [F.col("ids")[0].alias("least"), F.coalesce(F.get("ids", F.lit(1)), F.col("ids")[0]).alias("second")]
    indexed = dealt(index, "node", two, ("part", "group"), (parts, groups))
    queries = dealt(asking, "query", ["query_id"], ("group", "part"), (groups, parts))
    found = indexed.groupBy("part", "group").cogroup(queries.groupBy("part", "group")).applyInArrow(
        _search(size, count, compared), "query long, node long, score double"
    )
    # A query's finds of all parts, none twice and none only its own: the best different
    # vectors, then the best rows of these.
    with_ids = found.join(index.select("node", "ids"), "node").join(asking.select("query", "query_id"), "query")
    others = with_ids.withColumn("ids", F.array_remove("ids", F.col("query_id")))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    nodes = others.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= count)
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        nodes.select("query", "query_id", "score", F.explode("ids").alias("vec_id"))
        .withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= count)
        .select("query_id", "rank", "vec_id", "score")
    )
