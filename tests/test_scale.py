"""Hot keys, other partitionings and empty inputs give the same, whole results."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens.operators import (
    agreement as ag, distribution as di, firms as fo, keywords as kw, links, regional as rg, sampling, text as to,
    vectors as ve, vocabulary as vo,
)

from firmlens.functions.positions import positioned

HITS = "id long, category string, keyword string, source string, canton string"


def hits(spark, n=3000):
    """A third of all rows belong to firm 0 and to keyword k0."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 0).otherwise(i % 97).alias("id"), F.concat(F.lit("c"), i % 7).alias("category"),
        F.when(i % 3 == 1, "k0").otherwise(F.concat(F.lit("k"), i % 31)).alias("keyword"),
        F.when(i % 2 == 0, "web").otherwise("pat").alias("source"),
        F.concat(F.lit("r"), i % 97 % 4).alias("canton"),
    )


def counts(h):
    return fo.unique_keywords(h, "source", "id", "category")


def placed(h):
    return fo.unique_keywords(h).withColumn("canton", F.concat(F.lit("r"), F.col("id") % 4))


OPERATORS = {
    "unique_keywords": fo.unique_keywords,
    "firms_with_n_unique": lambda h: fo.firms_with_n_unique(h, 2),
    "cooccurrence": lambda h: di.category_cooccurrence(h.select("id", "category")),
    "survival": lambda h: di.survival_curve(fo.unique_keywords(h)),
    "elbow": lambda h: di.elbow_curve(fo.unique_keywords(h), 9),
    "rank_keywords": di.rank_keywords,
    "thresholds": lambda h: di.threshold_counts(fo.unique_keywords(h), [1, 3]),
    "flags": ag.source_flags,
    "cond": lambda h: ag.conditional_probabilities(ag.source_flags(h)),
    "shares": lambda h: ag.source_shares(counts(h), 1),
    "rta_firms": lambda h: rg.rta_share_of_firms(placed(h), "r1", 1),
    "rta_rows": lambda h: rg.rta_share_of_rows(placed(h), "r1", 1),
    "rta_regions": lambda h: rg.rta_all_regions(placed(h), 1),
    "degrees": lambda h: links.degrees(h.select(F.col("keyword").alias("src"), F.col("category").alias("dst"))),
}


def found(frame):
    return sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in frame.collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_partitioning_does_not_matter(spark, name):
    base, op = hits(spark), OPERATORS[name]
    assert found(op(base.repartition(1))) == found(op(base.repartition(7)))


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_input(spark, name):
    op = OPERATORS[name]
    empty = op(hits(spark).limit(0))
    assert empty.schema.names == op(hits(spark)).schema.names
    if name != "elbow":
        assert empty.count() == 0


def test_survival_falls_and_starts_with_all_firms(spark):
    per_firm = fo.unique_keywords(hits(spark))
    curves = {}
    for r in di.survival_curve(per_firm).orderBy("category", "n_unique").collect():
        curves.setdefault(r.category, []).append(r.n_firms)
    sizes = {r.category: r["count"] for r in per_firm.groupBy("category").count().collect()}
    assert all(c == sorted(c, reverse=True) and c[0] == sizes[k] for k, c in curves.items())


@pytest.mark.parametrize("separator", ["\n", ""])
@pytest.mark.parametrize("part_chars", [10_000_000, 400])
def test_group_text_with_a_hot_firm(spark, separator, part_chars):
    """Every page is in one part, in order; parts are about as long as asked for."""
    pages = [(i, "hot" if i % 3 else f"f{i % 10}", None if i % 11 == 0 else "x" * (i % 7) + f"<{i}>") for i in range(900)]
    pages += [(9999, "silent", None), (10_000, None, "<10000>")]
    frame = spark.createDataFrame(pages, "url long, id string, text string").repartition(6)
    rows = to.group_text(frame, separator=separator, part_chars=part_chars).collect()
    want = {}
    for _, firm, text in sorted(pages, key=lambda p: p[0]):
        want.setdefault(firm, [])
        if text is not None:
            want[firm].append(text)
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append(r.text)
    assert got.keys() == want.keys() and got["silent"] == [""]
    for firm, own in want.items():
        if part_chars > 400:
            assert got[firm] == [separator.join(own)]
        parts = [[int(x.split(">")[0]) for x in text.split("<")[1:]] for text in got[firm]]
        assert all(p == sorted(p) for p in parts)
        assert sorted(x for p in parts for x in p) == [int(t.split("<")[1][:-1]) for t in own]
        assert all(len(t) < 3 * part_chars for t in got[firm])
    assert (len(got["hot"]) > 5) == (part_chars == 400)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 0.99, 1.0])
@pytest.mark.parametrize("accuracy", [2, 50, 10_000])
def test_top_quantile_against_sorting(spark, q, accuracy):
    rng = np.random.default_rng(3)
    wide = [float(s * 10.0**e) for s, e in zip(rng.choice([-1, 1], 400), rng.uniform(-6, 6, 400), strict=True)]
    values = {"a": list(rng.uniform(-1, 1, 301)), "b": [0.5] * 40 + [0.25] * 3, "c": [0.1], "wide": wide, None: [3.0, 2.0, 2.0],
              "ties": [7.0] * 2_000 + [1e12] * 3 + [-1e12] * 2, "near": list(1e9 + rng.uniform(0, 1e-3, 200))}
    rows = [(i, c, float(v)) for c, vs in values.items() for i, v in enumerate(vs)]
    odd = [(1, "a", None), (2, "a", float("nan")), (3, "empty", None)]
    frame = spark.createDataFrame(rows + odd, "url long, category string, similarity double").repartition(5)
    got = ve.top_quantile(frame, q, accuracy=accuracy)
    assert got.columns == frame.columns
    want = []
    for c, vs in values.items():
        limit = sorted(vs)[int(q * (len(vs) - 1) + 0.5)]
        want += [(i, c, float(v)) for i, v in enumerate(vs) if v >= limit]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize(("offset", "length"), [(0, 5), (3, 1_000), (990, 50), (1_200, 5), (10, 0), (399, 203)])
def test_slices_by_position(spark, offset, length):
    rows = [(i % 7, i) for i in range(600)] + [(3, 1)] * 400
    frame = spark.createDataFrame(rows, "a long, b long").repartition(6)
    sliced = sampling.slice_rows(frame, offset, length, "a", "b")
    assert [tuple(r) for r in sliced.collect()] == sorted(rows)[offset : offset + length]
    assert "GlobalLimit" not in sliced._jdf.queryExecution().executedPlan().toString() or not length


def test_positions(spark):
    rows = [(None, 5), (2, 1), (1, 1), (1, 1), (None, 4)] + [(9, 9)] * 300
    frame = spark.createDataFrame(rows, "a long, b long").repartition(6)
    got = sorted((r.position, r.a, r.b) for r in positioned(frame, F.asc_nulls_last("a"), "b").collect())
    assert got == [(i, *r) for i, r in enumerate([(1, 1), (1, 1), (2, 1)] + [(9, 9)] * 300 + [(None, 4), (None, 5)])]
    assert positioned(frame.limit(0), "a").count() == 0


def test_text_stays_where_it_is(spark, tmp_path):
    """Matching with a small dictionary has no shuffle of texts."""
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "laser beam")], "url long, text string").write.parquet(path)
    keywords = spark.createDataFrame([("laser",)], "keyword string")
    plan = kw.match_keywords(spark.read.parquet(path), keywords)._jdf.queryExecution().executedPlan().toString()
    probe = plan.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in probe and "Exchange hashpartitioning" not in probe


def test_texts_are_compared_by_digest(spark, tmp_path):
    """No exchange or sort of the plan holds a text."""
    path = str(tmp_path / "pages")
    rows = [(i, f"text {i % 40}") for i in range(100)] + [(None, "text 3"), (200, "text 3"), (200, "text 3"), (300, "x"), (300, "x")]
    spark.createDataFrame(rows[:101], "url long, text string").write.parquet(path)
    clean = to.clean_text(spark.read.parquet(path))
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort [" not in plan and "Exchange hashpartitioning" not in plan
    assert {r.url for r in clean.collect()} == {None, *range(40)} - {3}
    every = to.clean_text(spark.createDataFrame(rows, "url long, text string").repartition(5)).collect()
    assert sorted((r.text, r.url) for r in every if r.text == "x") == [("x", 300)]
    assert len(every) == 41 and all(set(r.asDict()) == {"url", "text"} for r in every)


def test_idf_of_a_hot_word(spark):
    docs = spark.range(200).select(F.when(F.col("id") % 3 == 0, "hot hot hot").otherwise(F.concat(F.lit("w"), F.col("id") % 5)).alias("text"))
    got = {r.word: r.df for r in vo.idf_words(docs).collect()}
    assert got["hot"] == 67 and sum(got.values()) == 200


def test_words_of_sources_are_counted_in_one_pass_over_small_parts(spark, monkeypatch):
    """Input is read once, and adaptive execution does not put its pages together to one large part."""
    read, made = spark.sparkContext.accumulator(0), []

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    n = 3000
    i = F.col("id")
    rows = spark.range(n).select(F.when(i % 3 == 0, "k0").otherwise(F.concat(F.lit("k"), i % 31)).alias("keyword"),
                                 F.when(i % 2 == 0, "web").otherwise("pat").alias("source"), (i % 500).alias("page"))
    expected = {}
    for r in rows.collect():
        expected.setdefault(r.keyword, {"web": set(), "pat": set()})[r.source].add(r.page)
    lookup = rows.select("keyword", F.lit("a").alias("category")).distinct()
    store = getattr(ag, "stored", None)
    monkeypatch.setattr(ag, "stored", lambda t, name: made.append(t._jdf.queryExecution().executedPlan().toString()) or store(t, name), raising=False)
    got = ag.word_frequencies(rows.mapInArrow(counted, rows.schema), lookup).collect()
    assert {r.keyword: (round(r.freq_web * n / 2), round(r.freq_pat * n / 2)) for r in got} == {k: (len(v["web"]), len(v["pat"])) for k, v in expected.items()}
    assert read.value == n
    assert "REPARTITION_BY_NUM" in "".join(made)
