"""Sweeps, sketches, quotas, growing counts and drifting files against plain Python."""

from __future__ import annotations

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as t

from firmlens.operators import growing, sampling, sketches
from firmlens.operators import sweeps as sw
from firmlens.operators import vocabulary as vo
from firmlens.sources import drift


def run(rows: list[tuple], threshold: int, by: bool) -> dict:
    groups = defaultdict(list)
    for source, firm, category, level, n in rows:
        if level is not None and level >= threshold:
            groups[source if by else ()].append((firm, category, n))
    out = {}
    for key, own in groups.items():
        known = [n for _, _, n in own if n is not None]
        out[key] = (len(own), len({f for f, _, _ in own if f is not None}), len({c for _, c, _ in own if c is not None}), sum(known) if known else None,
                    sum(known) / len(known) if known else None, min(known, default=None), max(known, default=None))
    return out


@pytest.mark.parametrize("by", [True, False])
def test_sweep_equals_single_runs(spark, by):
    rng = random.Random(5)
    rows = [(rng.choice(["web", "pat", None]), rng.choice([*range(20), None]), rng.choice("abcd"), rng.choice([*range(9), None]), rng.choice([1, 2, 30, None]))
            for _ in range(600)] + [("one", 1, "a", 8, None), ("low", 1, "a", 0, 4)]
    table = spark.createDataFrame(rows, "source string, firm long, category string, level int, n long").repartition(4)
    thresholds = [7, 1, 3, 12]
    found = sw.sweep(table, "level", thresholds, ["source"] if by else [], rows=sw.rows(), firms=sw.different("firm"), kinds=sw.different("category"),
                     sum=sw.total("n"), mean=sw.mean("n"), low=sw.least("n"), high=sw.greatest("n"))
    got = {(r.threshold, r.source if by else ()): (r.rows, r.firms, r.kinds, r["sum"], r["mean"], r.low, r.high) for r in found.collect()}
    assert got == {(th, key): v for th in thresholds for key, v in run(rows, th, by).items()}


def test_sweep_reads_the_table_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([(1, 2, 3)], "a long, b long, level int").write.parquet(path)
    plain = sw.sweep(spark.read.parquet(path), "level", [1, 2], n=sw.rows(), s=sw.total("a"))
    text = plain._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation") <= 2 and plain.count() == 2
    stored = sw.sweep(spark.read.parquet(path), "level", [1, 2], ["b"], n=sw.different("a"))
    assert path not in stored.inputFiles() and [tuple(r) for r in stored.orderBy("threshold").collect()] == [(1, 2, 1), (2, 2, 1)]


def test_sketches_are_unions(spark):
    rows = [("a" if i % 3 else None, i % 2, i % 5_000) for i in range(20_000)] + [("x", 1, None)]
    table = spark.createDataFrame(rows, "category string, source int, firm long").repartition(4)
    kept = sketches.distinct_sketches(table, ["category", "source"], "firm")
    for keys in (["category"], []):
        exact = defaultdict(set)
        for category, _, firm in rows:
            exact[category if keys else None] |= {firm} - {None}
        got = {(r.category if keys else None): r.n for r in sketches.estimates(sketches.union_sketches(kept, keys)).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[k] - len(v)) <= sketches.relative_error() * len(v) + 1 for k, v in exact.items())


def most_by_search(edges: list[tuple], quota: int) -> int:
    firms = sorted({f for f, _ in edges})
    best = 0
    for choice in itertools.product(*[[None, *[c for f, c in edges if f == firm]] for firm in firms]):
        if all(n <= quota for c, n in Counter(choice).items() if c is not None):
            best = max(best, sum(c is not None for c in choice))
    return best


def test_quotas_are_filled_as_far_as_can_be():
    rng = random.Random(8)
    for _ in range(150):
        edges = sorted({(rng.randint(1, 7), rng.choice("abcd")) for _ in range(rng.randint(1, 14))})
        quota = rng.randint(1, 3)
        given = sampling.fill_quotas(edges, quota)
        assert all((f, c) in edges for f, c in given.items()) and max(Counter(given.values()).values()) <= quota
        assert len(given) == most_by_search(edges, quota)


def test_review_quotas(spark):
    # Every firm has category a first; a choice by the first category alone leaves b and c empty.
    labels = [(i, c) for i in range(6) for c in "abc"] + [(10, None), (11, None), (None, "a"), (12, "z")]
    table = spark.createDataFrame(labels * 2, "id long, category string").repartition(3)
    urls = spark.createDataFrame([(i, f"u{i}") for i in range(12)] + [(3, "second")], "id long, url string")
    rows = sampling.review_quotas(table, urls, per_category=2, without=1).collect()
    assert Counter(r.category for r in rows) == {"a": 2, "b": 2, "c": 2, "None": 1}
    assert len({r.id for r in rows}) == 7 and {r.id for r in rows if r.category == "None"} == {10}
    again = sampling.review_quotas(table.repartition(5), urls, per_category=2, without=1).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert sampling.review_quotas(table.limit(0), urls).count() == 0


def test_growing_frequencies(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i % 4} both x{i} é") for i in range(30)] + [(31, None), (32, "")], "id long, text string")
    want = {r.word: r.df for r in vo.document_frequencies(docs).collect()}
    for n, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 1, 0, 2, 1)]):
        store = growing.GrowingFrequencies(spark, str(tmp_path / f"store{n}"))
        assert store.frequencies().count() == 0 and store.batches() == []
        for i, batch in enumerate(order):
            store.add(batch, docs.filter(F.col("id") % 3 == batch))
            if i in (1, 2):
                store.compact()
        store.add(2, docs.filter("id % 3 = 2"))
        assert {r.word: r.df for r in store.frequencies().collect()} == want and store.batches() == [0, 1, 2]


def test_promoted_types():
    cases = [
        (t.IntegerType(), t.LongType(), t.LongType()), (t.LongType(), t.DoubleType(), t.DoubleType()), (t.LongType(), t.FloatType(), t.DoubleType()),
        (t.ShortType(), t.FloatType(), t.FloatType()), (t.StringType(), t.ArrayType(t.StringType()), t.ArrayType(t.StringType())),
        (t.IntegerType(), t.ArrayType(t.LongType()), t.ArrayType(t.LongType())), (t.DateType(), t.TimestampType(), t.TimestampType()),
        (t.LongType(), t.StringType(), t.StringType()), (t.NullType(), t.DateType(), t.DateType()), (t.DecimalType(10, 2), t.DecimalType(12, 4), t.DecimalType(12, 4)),
        (t.DecimalType(10, 2), t.LongType(), t.DoubleType()), (t.BooleanType(), t.LongType(), t.StringType()),
    ]
    for a, b, both in cases:
        assert drift.promoted(a, b) == both and drift.promoted(b, a) == both


def test_files_that_disagree(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    tables = [
        spark.createDataFrame([(1, "x", day, (1, "p")), (None, None, None, None)], "id int, links string, at date, s struct<a: int, b: string>"),
        spark.createDataFrame([(1 << 40, ["y", None], dt.datetime(2024, 1, 3, 4), (1.5, True))], "id long, links array<string>, at timestamp, s struct<a: double, c: boolean>"),
        spark.createDataFrame([(2.5, 7, "later")], "id double, links long, `odd name.x` string"),
        spark.createDataFrame([], "id string"),
    ]
    for i, table in enumerate(tables):
        table.write.parquet(str(tmp_path / "all" / f"part={i}"))
    found = drift.read_drifting(spark, str(tmp_path / "all"))
    assert found.columns == ["id", "links", "at", "s", "odd name.x"]
    assert [d for _, d in found.dtypes][:3] == ["string", "array<string>", "timestamp"]
    rows = [(r.id, r.links, r.at, r["s"] and tuple(r["s"]), r["odd name.x"]) for r in found.collect()]
    midnight = dt.datetime(2024, 1, 2)
    assert sorted(rows, key=repr) == sorted(
        [("1", ["x"], midnight, (1.0, "p", None), None), (None, None, None, None, None),
         (str(1 << 40), ["y", None], dt.datetime(2024, 1, 3, 4), (1.5, None, True), None), ("2.5", ["7"], None, None, "later")], key=repr)
    pushed = drift.read_drifting(spark, [str(tmp_path / "all" / "part=0"), str(tmp_path / "all" / "part=1")]).filter("at is not null").select("id")
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "links" not in plan.split("ReadSchema")[1].split("\n")[0]
    with pytest.raises(ValueError, match="no Parquet files"):
        drift.read_drifting(spark, str(empty_folder(tmp_path)))


def empty_folder(path):
    (path / "empty").mkdir()
    return path / "empty"
