"""Preference rows and nearest neighbours, the registered queries, and the pipeline."""

from __future__ import annotations

import math

import __spark_entry__ as entry
import corpus_pipeline
import numpy as np
import oracle
import pytest
from llm_tables import ordered, texts_of
from pyspark.sql import functions as F

from firmlens.llm import chat, neighbours, queries, repeats

SF = "/root/testdata/sf0.001"
TALK = "conv_id long, turn int, role string, text string, turns int, chosen int, prompt string"


def odd_talks(spark):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "hello"), (0, 2, "user", "bye"), (1, 0, "user", "hi"), (1, 1, "assistant", "hello"),
        (2, 0, "user", ""), (2, 1, None, None), (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"),
        (3, None, "assistant", "straße 漢字 \U0001f600"), (3, 5, "user", None), (4, 0, "system", "only"), (6, 0, "assistant", "x" * 50_000),
        (7, 0, "assistant", "y"), (None, 0, "user", "nobody"), (None, None, None, None),
    ]
    return spark.createDataFrame([(*r, 1, 2, "p") for r in rows], TALK)


def test_preference_rows_of_odd_talks(spark):
    talks = odd_talks(spark)
    con = oracle.duckdb.connect()
    rows = [tuple(r)[:4] for r in talks.collect()]
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn INT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = chat.preference_rows(chat.answer_pairs(chat.conversations(talks), F.col("conv_id").bitwiseXOR(F.lit(1))))
    assert oracle.difference(oracle.spark_rows(found), oracle.duck_rows(con, queries.CHAT_SQL)) == ""
    by = {r.conv_id: r for r in found.collect()}
    assert by[0].chosen == by[0].rejected == "" and by[0].n_prompt_turns == 2
    for row in by.values():
        for text, learned in ((row.chosen, row.chosen_learned), (row.rejected, row.rejected_learned)):
            parts = [text[int(a) : int(b)] for a, b in (s.split(":") for s in learned.split(",") if s)]
            assert all(p.endswith(chat.CLOSE) for p in parts)


def test_preference_rows_keep_other_columns(spark):
    turn = {"role": "assistant", "text": "a"}
    pairs = spark.createDataFrame(
        [(1, [turn], None, "x", 5), (2, None, None, None, None)], f"pair long, good {chat.TURNS}, bad {chat.TURNS}, prompt string, extra int"
    )
    rows = {r.pair: r for r in chat.preference_rows(pairs, "good", "bad").collect()}
    assert rows[1].extra == 5 and rows[1].prompt == "" and rows[1].chosen == "<|im_start|>assistant\na<|im_end|>\n"
    assert rows[1].chosen[22:33] == "a<|im_end|>"[:11] and rows[1].chosen_learned == "22:33" and rows[2].chosen == rows[2].rejected == ""
    nothing = chat.conversations(spark.createDataFrame([], TALK))
    assert chat.preference_rows(chat.answer_pairs(nothing, F.col("conv_id"))).count() == 0


def test_preference_rows_run_without_python(spark):
    plan = queries.QUERIES["op1_preference_rows"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def best(rows: list[tuple], count: int) -> dict:
    """Brute force: (id, vector) rows; queries are ids divisible by 20."""
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            found = sorted((-float(np.dot(np.array(x, float), np.array(y, float))), v) for v, y in rows if v != q)
            out[q] = [(v, -s) for s, v in found[:count]]
    return out


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(v)) for v in rng.normal(size=8)]) for i in range(100, 160)]
    same = [float(np.float32(v)) for v in rng.normal(size=8)]
    good += [(i, same) for i in range(160, 260)]
    bad = [(300, None), (320, [0.0] * 8), (340, [1.0] * 7 + [None]), (360, [1.0] * 7 + [math.nan]), (380, [math.inf] * 8), (400, [1.0, 2.0]), (None, same), (420, [])]
    table = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>")
    table = table.select("*", *[F.lit(0).alias(c) for c in ("node", "query", "query_id", "rank", "score", "vector", "ids", "near", "place")]).repartition(4)
    rows = neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect()
    expected = best(good, 20)
    found: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == expected.keys()
    for q in expected:
        assert [v for v, _ in found[q]] == [v for v, _ in expected[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in expected[q]], atol=1e-12)


def test_neighbours_of_few_and_no_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])], "vec_id long, embedding array<float>")
    rows = neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in rows) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert neighbours.nearest(table.filter("vec_id < 0"), F.lit(True)).count() == 0


def test_neighbours_of_repeated_rows(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(np.float32(v)) for v in rng.normal(size=8)]) for i in range(100, 160)]
    strong = [float(v) for v in 9 * np.ones(8)]
    good += [(200, strong), (220, strong)]
    table = spark.createDataFrame(good + [good[0]] + 29 * [good[20]] + 29 * [(200, strong)] + [good[5]], "vec_id long, embedding array<float>")
    found: dict = {}
    for r in sorted(neighbours.nearest(table.repartition(4), F.col("vec_id") % 20 == 0, 20).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {q: [v for v, _ in own] for q, own in best(good, 20).items()}


def test_neighbours_of_a_key_with_many_vectors(spark):
    rng = np.random.default_rng(5)
    one = rng.normal(size=8)
    many = [[float(v) for v in 9 * one + 0.01 * rng.normal(size=8)] for _ in range(400)]
    others = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(101, 160) if i % 20]
    table = spark.createDataFrame([(0, v) for v in many] + others, "vec_id long, embedding array<double>")
    rows = neighbours.nearest(table, F.col("vec_id") == 0, 20, pivots=8).collect()  # every query reads every file
    assert len(rows) == 400 * 20 and sorted({r["rank"] for r in rows}) == list(range(1, 21))
    expected = sorted((tuple(sorted(others, key=lambda r: -float(np.dot(r[1], q)))[k][0] for k in range(20))) for q in many)
    by_score: dict = {}
    for r in rows:
        by_score.setdefault(r["rank"], []).append(r.vec_id)
    assert all(sorted(by_score[k + 1]) == sorted(e[k] for e in expected) for k in range(20))


@pytest.mark.parametrize("part", [8192, 150])
def test_recall(spark, part, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", part)
    monkeypatch.setattr(neighbours, "QUERIES_AT_ONCE", 64 if part < 8192 else 4096)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect()
    expected = best([(r.vec_id, r.embedding) for r in table.collect()], 20)
    found = {(r.query_id, r.vec_id) for r in rows}
    assert len(found) == len(rows) == 20 * len(expected)
    assert sum((q, v) in found for q, own in expected.items() for v, _ in own) >= 0.95 * len(rows)


def test_recall_of_unequal_norms(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 500)
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(3000, 32))
    unit *= (rng.uniform(0.4, 1.6, 3000) / np.linalg.norm(unit, axis=1))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(unit)]
    found = {(r.query_id, r.vec_id) for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()}
    expected = best(rows, 20)
    assert len(found) == 20 * len(expected)
    assert sum((q, v) in found for q, own in expected.items() for v, _ in own) >= 0.95 * len(found)


def test_neighbours_of_two_lengths(spark):
    rng = np.random.default_rng(7)
    long, short = ([(i, rng.normal(size=size).tolist()) for i in range(first, first + 90)] for first, size in ((0, 6), (1000, 3)))
    found: dict = {}
    table = spark.createDataFrame(long + short, "vec_id long, embedding array<double>")
    for r in sorted(neighbours.nearest(table, F.col("vec_id") % 20 == 0, 5).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {q: [v for v, _ in own] for rows in (long, short) for q, own in best(rows, 5).items()}


def test_rounded_places_give_the_footrule_of_steps():
    rng = np.random.default_rng(8)
    for pivots in (3, 17, 256):
        place = np.stack([rng.permutation(pivots) for _ in range(20)]).astype(np.uint8)
        steps = sum((place >= pivots * k / (neighbours.STEPS + 1)).astype(int) for k in range(1, neighbours.STEPS + 1))
        rounded = neighbours._rounded(place)
        assert np.array_equal(np.bitwise_count(rounded ^ rounded[0]).sum(1), np.abs(steps - steps[0]).sum(1))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    if name in queries.ORACLES:
        assert oracle.difference(oracle.spark_rows(frame), oracle.duck_rows(oracle.connect(SF), queries.ORACLES[name])) == ""
    else:
        assert frame.count() > 0


def test_entry_has_all_queries():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and names.keys() >= entry.oracle_sql().keys()


def test_pipeline_stages(spark, documents):
    docs, columns = documents, documents.columns
    found = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        found.append(docs)
        if name != "best-fit packing":
            assert docs.columns == columns
    judged, different, shorter, blanked, packed = found
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in found]
    assert ids[0] >= ids[1] == ids[2] == ids[3] == ids[4] and ids[0] < {r.doc_id for r in documents.collect()}
    before, after = dict(texts_of(different)), dict(texts_of(shorter))
    expected = repeats.remove_repeats(different, corpus_pipeline.REPEATED_BYTES).collect()
    assert all(abs(len(after[r.doc_id].encode()) - len(r.kept)) <= 6 * r.n_spans for r in expected)
    assert any(before[k] != after[k] for k in before)
    assert all(r.n_chars == len(r.text) for r in blanked.collect())
    run = corpus_pipeline.run(spark, SF)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert ordered(map(tuple, run.select(*names).collect())) == ordered(map(tuple, packed.select(*names).collect()))


def test_pipeline_stages_of_odd_rows(spark, odd, nothing):
    """With the labels of the small tables; nothing breaks on nulls, ties or empty tables."""
    for table in (odd, nothing):
        docs = table
        for name, stage in corpus_pipeline.STAGES:
            own = stage(spark, table if name != "best-fit packing" else docs, SF)
            assert own.count() <= max(table.count(), 1) or name == "best-fit packing"
            if name != "best-fit packing":
                assert own.columns == table.columns
                docs = own
