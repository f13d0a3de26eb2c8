"""Blocked label similarity against plain matrix products."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.operators import label_blocks as bl

SCHEMA = "label string, embedding array<double>"


def unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def tables(spark, labels: np.ndarray, rows: np.ndarray):
    names = [f"l{i:05d}" for i in range(len(labels))]
    table = spark.createDataFrame([(n, v.tolist()) for n, v in zip(names, labels, strict=True)], SCHEMA)
    return names, table, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize(("threshold", "block"), [(0.9, 1024), (0.3, 7), (0.0, 50), (-0.5, 1024)])
def test_pairs(spark, threshold, block):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 6))
    labels = np.repeat(centres, 25, 0) + 0.1 * rng.normal(size=(300, 6))
    labels[5] = 0
    rows = np.concatenate([centres + 0.1 * rng.normal(size=(12, 6)), rng.normal(size=(40, 6)), np.zeros((1, 6)), labels[:3]])
    names, table, pages = tables(spark, labels, rows)
    found = bl.similar_labels(pages, bl.label_blocks(table, block=block), threshold, "id", block=16).collect()
    cosine = unit(rows) @ unit(labels).T
    expected = {(i, names[j]): cosine[i, j] for i, j in zip(*np.nonzero(cosine >= threshold), strict=True)}
    got = {(r.id, r.category): r.similarity for r in found}
    near = {k for k, v in ((k, v) for k, v in {**expected, **got}.items()) if abs(v - threshold) < 1e-12}
    assert len(found) == len(got) and got.keys() - near == expected.keys() - near
    assert all(abs(got[k] - expected[k]) < 1e-12 for k in got.keys() & expected.keys())


def test_more_labels_than_a_matrix_holds(spark):
    rng = np.random.default_rng(2)
    labels, rows = rng.normal(size=(25_000, 16)), rng.normal(size=(30, 16))
    names, table, pages = tables(spark, labels, rows)
    cosine = unit(rows) @ unit(labels).T
    blocks = bl.label_blocks(table)
    got = {(r.id, r.category) for r in bl.similar_labels(pages, blocks, 0.7, "id").collect()}
    assert got == {(i, names[j]) for i, j in zip(*np.nonzero(cosine >= 0.7), strict=True)}
    best = {r.id: (r.category, round(r.similarity, 9)) for r in bl.best_labels(pages, blocks, "id", threshold=0.5).collect()}
    assert best == {i: (names[c.argmax()], round(c.max(), 9)) for i, c in enumerate(cosine) if c.max() > 0.5}


def test_far_blocks_are_left_out(spark):
    rng = np.random.default_rng(3)
    centres = unit(rng.normal(size=(40, 32)))
    labels = np.repeat(centres, 50, 0) + 0.02 * rng.normal(size=(2_000, 32))
    _, table, _ = tables(spark, labels, centres)
    blocks = bl.label_blocks(table).collect()
    assert sum(len(b.names) for b in blocks) == 2_000 and len(blocks) <= 256
    met = 0
    for b in blocks:
        centre = np.frombuffer(b.centre)
        angle = np.arccos(np.clip(centres @ centre, -1, 1)) - np.arccos(min(1.0, b.width))
        met += (np.cos(np.maximum(angle, 0)) >= 0.9).sum()
    assert met < 0.2 * 40 * len(blocks)


def test_blocks_travel_in_bundles(spark):
    rng = np.random.default_rng(6)
    _, table, _ = tables(spark, rng.normal(size=(3_000, 8)), np.zeros((0, 8)))
    blocks = bl.label_blocks(table, block=40).coalesce(1)
    bundles = bl._bundles(blocks).collect()
    assert len(blocks.collect()) > 100 and len(bundles) == 1
    assert sum(bundles[0].sizes) == len(bundles[0].names) == 3_000 and len(bundles[0].widths) == len(bundles[0].sizes)
    largest = bl._bundles(bl.label_blocks(table, block=3_000).coalesce(1))
    assert sum(len(b.names) for b in largest.collect()) == 3_000


def test_small_bundles_and_products(spark, monkeypatch):
    monkeypatch.setattr(bl, "BUNDLE_LABELS", 25)
    monkeypatch.setattr(bl, "PRODUCT_PAIRS", 60)
    rng = np.random.default_rng(7)
    labels, rows = rng.normal(size=(130, 4)), rng.normal(size=(45, 4))
    names, table, pages = tables(spark, labels, rows)
    cosine = unit(rows) @ unit(labels).T
    found = bl.similar_labels(pages, bl.label_blocks(table, block=9), 0.4, "id", block=20).collect()
    assert len(found) == (cosine >= 0.4).sum()
    assert {(r.id, r.category) for r in found} == {(i, names[j]) for i, j in zip(*np.nonzero(cosine >= 0.4), strict=True)}


def test_digits_round_as_spark_does(spark):
    rng = np.random.default_rng(8)
    halves = (rng.integers(-(10**6), 10**6, 3_000) + 0.5) / 10**6  # six digits and a half
    values = np.concatenate([halves, np.nextafter(halves, 1), np.nextafter(halves, -1), rng.uniform(-1, 1, 3_000), [0.0, -0.0, -4e-7, 5e-7, -5e-7, 1.0, -1.0, 1e-300]])
    table = spark.createDataFrame([(float(v),) for v in values], "v double")
    for digits in (0, 3, 6):
        expected = np.array([r.v for r in table.selectExpr(f"round(v, {digits}) AS v").collect()])
        got = bl._half_up(values, digits)
        assert (got == expected).all() and not np.signbit(got[got == 0]).any()
    pages = spark.createDataFrame([(1, [1.0, 0.0])], "id long, embedding array<double>")
    blocks = bl.label_blocks(spark.createDataFrame([("a", [1.0, 1.0])], SCHEMA))
    assert bl.similar_labels(pages, blocks, 0.5, "id", digits=6).collect()[0].similarity == 0.707107


def test_equal_cosines_leave_side_by_side(spark):
    rng = np.random.default_rng(9)
    labels, rows = rng.normal(size=(900, 4)), rng.normal(size=(700, 4))
    names, table, pages = tables(spark, labels, rows)
    blocks = bl.label_blocks(table, block=50).coalesce(1)
    made = bl.similar_labels(pages.coalesce(1), blocks, 0.2, "id", block=60, digits=2)
    by_part: dict[int, list] = {}
    for r in made.select("*", F.spark_partition_id().alias("part")).collect():
        by_part.setdefault(r.part, []).append(r)
    for found in by_part.values():  # fewer pairs than a lot: one run for each value
        values = [r.similarity for r in found]
        assert sum(a != b for a, b in zip(values, values[1:], strict=False)) == len(set(values)) - 1 < 81
    cosine = unit(rows) @ unit(labels).T
    expected = {(i, names[j]): cosine[i, j] for i, j in zip(*np.nonzero(cosine >= 0.2), strict=True)}
    got = {(r.id, r.category): r.similarity for found in by_part.values() for r in found}
    assert sum(map(len, by_part.values())) == len(got) and got.keys() == expected.keys()
    assert all(abs(got[k] - v) <= 0.005 + 1e-12 for k, v in expected.items())


@pytest.mark.parametrize("digits", [None, 3, 12])
def test_lots_leave_whole(spark, monkeypatch, digits):
    for name, value in (("ORDERED_PAIRS", 70), ("LEAVING_PAIRS", 9), ("PRODUCT_PAIRS", 200), ("BUNDLE_LABELS", 25)):
        monkeypatch.setattr(bl, name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)  # lots end with their batches, and leave while the next are found
    try:
        rng = np.random.default_rng(10)
        labels, rows = rng.normal(size=(130, 4)), np.concatenate([rng.normal(size=(60, 4)), np.zeros((1, 4))])
        names = [None if i == 3 else f"l{i % 100}" for i in range(130)]  # repeated names, and none
        table = spark.createDataFrame([(n, v.tolist()) for n, v in zip(names, labels, strict=True)], SCHEMA)
        keys = [None if i in (5, 6) else f"k{i // 2}" for i in range(61)]
        pages = spark.createDataFrame([(k, v.tolist()) for k, v in zip(keys, rows, strict=True)], "id string, embedding array<double>")
        found = bl.similar_labels(pages, bl.label_blocks(table, block=9), -0.1, "id", block=20, digits=digits).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    cosine = unit(rows) @ unit(labels).T
    expected = sorted((keys[i] or "", names[j] or "", cosine[i, j]) for i, j in zip(*np.nonzero(cosine >= -0.1), strict=True))
    got = sorted((r.id or "", r.category or "", r.similarity) for r in found)
    assert Counter(x[:2] for x in got) == Counter(x[:2] for x in expected)
    room = 1e-12 if digits is None else 0.5001 * 10.0**-digits
    assert all(abs(a[2] - b[2]) <= room for a, b in zip(got, expected, strict=True))


def test_ties_nulls_and_empty_tables(spark):
    table = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", None), ("z", [0.0, 1.0])], SCHEMA)
    pages = spark.createDataFrame([(1, [3.0, 0.0]), (2, None), (None, [0.0, 2.0]), (1, [3.0, 0.0])], "id long, embedding array<double>")
    blocks = bl.label_blocks(table)
    assert sorted(map(tuple, bl.best_labels(pages, blocks, "id").collect()), key=repr) == [(1, "a", 1.0), (None, "z", 1.0)]
    assert sorted(map(tuple, bl.predicted_labels(pages, blocks, "id").collect()), key=repr) == [(1, ["a", "b"]), (2, ["unknown"]), (None, ["z"])]
    assert bl.similar_labels(pages.limit(0), blocks, 0.5, "id").count() == 0
    assert bl.similar_labels(pages, bl.label_blocks(table.limit(0)), 0.5, "id").count() == 0
    with pytest.raises(Exception, match="must have 2 entries"):
        bl.similar_labels(spark.createDataFrame([(1, [1.0])], pages.schema), blocks, 0.5, "id").collect()


@pytest.mark.parametrize("most", [1024, 0])
def test_lists_of_single_and_repeated_keys(spark, monkeypatch, most):
    monkeypatch.setattr(bl, "TASK_BLOCKS", most)
    monkeypatch.setattr(bl, "LIST_ROWS", 7)
    rng = np.random.default_rng(4)
    labels, rows = rng.normal(size=(400, 5)), np.concatenate([rng.normal(size=(90, 5)), np.zeros((1, 5))])
    names = [None if i == 3 else f"l{i % 300}" for i in range(400)]  # repeated names, and none
    table = spark.createDataFrame([(n, v.tolist()) for n, v in zip(names, labels, strict=True)], SCHEMA)
    keys = [None if i in (5, 6) else i // 2 if i < 20 else i for i in range(91)]
    given = [(k, v.tolist()) for k, v in zip(keys, rows, strict=True)] + [(900, None), (20, None)]
    pages = spark.createDataFrame(given, "id long, embedding array<double>")
    expected = {k: set() for k, _ in given}
    for k, c in zip(keys, unit(rows) @ unit(labels).T, strict=True):
        expected[k] |= {names[j] for j in np.flatnonzero(c >= 0.6)} - {None}
    got = bl.predicted_labels(pages, bl.label_blocks(table, block=30), "id", threshold=0.6).collect()
    assert len(got) == len(expected)
    assert {r.id: r.predicted for r in got} == {k: sorted(v) or ["unknown"] for k, v in expected.items()}


def test_lists_of_single_keys_are_not_shuffled(spark):
    rng = np.random.default_rng(5)
    _, table, pages = tables(spark, rng.normal(size=(200, 4)), rng.normal(size=(40, 4)))
    plan = bl.predicted_labels(pages, bl.label_blocks(table, block=30), "id", threshold=0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Union") < plan.index("LeftAnti") < plan.index("collect_set")  # only keys with several rows are gathered
