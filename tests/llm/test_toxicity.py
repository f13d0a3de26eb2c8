"""Toxicity by compression: held-out rows, odd tables, and the parts of the fit."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from llm_tables import ordered, texts_of
from pyspark.sql import functions as F

from firmlens.llm import queries, toxicity

SF = "/root/testdata/sf0.1"
DETECTOR = toxicity.Detector(b" vile  the of and ", b" the of and ", tuple(0.5 * i - 1.0 for i in range(11)), (1.0, 0.5, -0.1, -2.0))


@pytest.fixture(scope="module")
def judged(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    found = queries.QUERIES["op12_compression_toxicity"](spark, SF)
    return docs.count(), found.join(labels, "doc_id", "left").select("doc_id", "held_out", "score", "predicted", "toxic").collect()


def test_held_out_documents(judged):
    n, rows = judged
    assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    toxic, clean = ([r.predicted for r in rows if r.held_out and r.toxic == kind] for kind in (1, 0))
    assert len(toxic) > 100 and np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.015
    score = {kind: np.array([r.score for r in rows if r.held_out and r.toxic == kind]) for kind in (0, 1)}
    assert np.mean(score[1][:, None] > score[0]) >= 0.95  # area under the curve


@pytest.mark.parametrize("name", ["odd", "documents", "nothing"])
@pytest.mark.parametrize("detector", [DETECTOR, None])
def test_scores(request, name, detector):
    table = request.getfixturevalue(name)
    rows = toxicity.scored(table, detector).collect()
    found = [(r.doc_id, r.score, r.n_windows, r.n_marked) for r in rows]
    expected = []
    for key, text in texts_of(table):
        own = toxicity.distances(text or "", DETECTOR.toxic, DETECTOR.ordinary)
        marked = int(sum(DETECTOR.odds[min(max(d, -2), 8) + 2] > 0 for d in own.tolist()))
        expected.append((key, DETECTOR.score(own), len(own), marked) if detector else (key, 0.0, 0, 0))
    assert ordered(found) == ordered(expected)


def test_windows_hold_the_whole_text():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["word", "é", " ", "\n", "x" * 40, "\t", "漢字"]) for _ in range(rng.randint(0, 60))).encode()
        parts = toxicity.WINDOWS.findall(text)
        assert b"".join(parts) == text and all(len(p) <= 2 * toxicity.WINDOW for p in parts)
        assert all(len(p) >= toxicity.WINDOW for p in parts[:-1])


def test_features_against_plain_sums():
    rng = np.random.default_rng(5)
    odds = rng.normal(size=11)
    for n in (0, 1, 2, 9, 40):
        value = rng.integers(-5, 12, n)
        own = [odds[min(max(v, -2), 8) + 2] for v in value]
        stretch = max([0.0] + [sum(own[i:j]) for i in range(n) for j in range(i + 1, n + 1)])
        expected = [min(max(sum(own), -10), 10), min(stretch, 15), math.log(n + 1)]
        assert np.allclose(toxicity.features(value, odds), expected)


def test_best_cut():
    assert toxicity.best_cut(np.array([3.0, 2.0, 1.0, 0.0]), np.array([1.0, 1.0, 0.0, 0.0])) == 1.5
    assert toxicity.best_cut(np.array([1.0, 1.0, 1.0, 1.0, 1.0]), np.array([1.0, 0.0, 0.0, 0.0, 0.0])) == 2.0
    assert toxicity.best_cut(np.array([2.0, 2.0]), np.array([1.0, 1.0])) == 1.0


def test_fit_without_both_classes(spark, odd, nothing):
    labels = "doc_id long, quality int, toxic int"
    for rows in ([], [(5, 1, 1), (6, 1, 1)], [(5, 1, 0), (5, 1, 1), (6, 1, 0), (None, 1, 1), (7, 1, None), (8, 1, 2)]):
        table = spark.createDataFrame(rows, labels)
        assert toxicity.fit_to_labels(odd, table) is None and toxicity.fit_to_labels(nothing, table) is None


def test_fit_with_few_and_repeated_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1, 1), (6, 1, 0), (11, 1, 0), (4, 1, 1)] * 3, "doc_id long, quality int, toxic int")
    detector = toxicity.fit_to_labels(odd, labels)
    rows = toxicity.scored(odd, detector).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)


def test_fit_takes_the_strings_that_set_a_class_apart(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]

    def text(i: int, extra: list[str]) -> tuple:
        own = [rng.choice(words) for _ in range(40)]
        for w in extra:
            own.insert(rng.randrange(len(own)), w)
        return i, " ".join(own)

    docs = [text(i, ["Vilified", "grotty"] if i % 4 == 0 else []) for i in range(200)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(200)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    detector = toxicity.fit_to_labels(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert b"vilified" in detector.toxic and b"grotty" in detector.toxic and b"grotty" not in detector.ordinary
    rows = toxicity.scored(table, detector).withColumn("toxic", F.col("doc_id") % 4 == 0).collect()
    assert all((r.score >= toxicity.CUT) == r.toxic for r in rows)
