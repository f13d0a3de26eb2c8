"""Importance resampling against brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

import oracle
import pytest
from llm_tables import texts_of

from firmlens.llm import queries, resampling

SF = "/root/testdata/sf0.001"


def features(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bucket(feature: str) -> int:
    return crc32(feature.encode()) % 10_000


def brute(docs: list[tuple], target: list[str]) -> list[tuple]:
    """(key, n_features, weight, score) of each document."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)))
    for text in target:
        t.update(map(bucket, features(text)))
    S, T = sum(s.values()), sum(t.values())

    def gain(b: int) -> int:
        return math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000))))

    out = []
    for key, text in docs:
        own = features(text)
        weight = sum(gain(bucket(f)) for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


def check(rows: list, docs: list[tuple], target: list[str], percent: int = 25) -> None:
    expected = brute(docs, target)
    assert sorted(map(repr, ((r.doc_id, r.n_features, r.weight, r.score) for r in rows))) == sorted(map(repr, expected))
    able = sorted((-e[3], -1 if e[0] is None else e[0]) for e in expected if (e[1] + 1) // 2 >= 20)
    drawn = len(able) * percent // 100
    ranked = sorted((r["rank"], -r.score, -1 if r.doc_id is None else r.doc_id) for r in rows if r["rank"] is not None)
    assert ranked == [(i + 1, *able[i]) for i in range(drawn)]


@pytest.mark.parametrize("name", ["odd", "documents", "nothing"])
def test_resample(request, spark, name):
    table = request.getfixturevalue(name)
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = resampling.resample(table, target).collect()
    check(rows, texts_of(table), [r.text for r in target.collect()])


def test_small_slices_and_longer_runs(spark, odd, monkeypatch):
    rows = {}
    for size in (1, 2 << 20):
        monkeypatch.setattr(resampling, "SLICE_BYTES", size)
        rows[size] = sorted(map(repr, resampling.resample(odd, odd, percent=100, least_words=0, longest=3, buckets=97).collect()))
    assert rows[1] == rows[2 << 20] and len(rows[1]) == odd.count()
    long = resampling.runs(queries_array(["a b c d", "", "e f"]), 3, 1 << 40)
    assert [[(int(r), int(b)) for r, b in zip(*found, strict=True)] for found in long] == [
        [(0, crc32(w)) for w in (b"a", b"b", b"c", b"d")] + [(2, crc32(w)) for w in (b"e", b"f")],
        [(0, crc32(w)) for w in (b"a b", b"b c", b"c d")] + [(2, crc32(b"e f"))],
        [(0, crc32(w)) for w in (b"a b c", b"b c d")],
    ]


def queries_array(texts: list[str]):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_empty_target_and_all_equal_rows(spark, nothing):
    docs = spark.createDataFrame([(1, "word " * 30)] * 400 + [(2, None), (None, "other " * 25)], "doc_id long, text string").repartition(5)
    rows = resampling.resample(docs, nothing, percent=50).collect()
    check(rows, texts_of(docs), [], 50)
    assert sorted(r["rank"] for r in rows if r["rank"] is not None) == list(range(1, 201))
    kept = resampling.drawn_documents(docs, nothing, percent=50)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {1, None} and kept.count() in (400, 401)


def test_drawn_documents_come_nearer_to_the_target(spark):
    texts = [(i, ("alpha beta gamma " if i % 4 == 0 else "delta eps zeta ") * 10) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    target = spark.createDataFrame([("alpha beta gamma " * 5,)], "text string")
    found = resampling.drawn_documents(docs, target, percent=25).collect()
    assert len(found) == 100 and sum(r.text.startswith("alpha") for r in found) > 60


def test_query_is_as_in_sql(spark):
    got = oracle.spark_rows(queries.QUERIES["op11_target_resampling"](spark, SF))
    assert oracle.difference(got, oracle.duck_rows(oracle.connect(SF), queries.ORACLES["op11_target_resampling"])) == ""
    totals = defaultdict(int)
    for r in queries.QUERIES["op11_target_resampling"](spark, SF).collect():
        totals[r["rank"] is None] += 1
    assert totals[False] > 0
