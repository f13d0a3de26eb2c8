"""Operators on small hand-written tables: nulls, ties, empty lists, zero denominators."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmlens import sources as src
from firmlens.functions import sets
from firmlens.functions import text as tx
from firmlens.sources.files import stored
from firmlens.operators import (
    agreement as ag, crawl, distribution as di, firms as fo, labelling as lb, links, regional as rg,
    sampling, text as to, vectors as ve, vocabulary as vo,
)


def made(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


HITS = "id long, category string, keyword string, source string"


@pytest.fixture(scope="module")
def hits(spark):
    return made(
        spark, HITS,
        (1, "a", "x", "web"), (1, "a", "x", "web"), (1, "a", "y", "web"), (1, "b", "z", "web"), (1, "a", "x", "pat"),
        (2, "b", "z", "web"), (2, "b", "w", "web"), (3, "c", "v", "pat"),
    )


def test_unique_keywords(hits):
    web = fo.unique_keywords(hits.filter("source = 'web'"))
    assert found(web) == [(1, "a", 3, 2), (1, "b", 1, 1), (2, "b", 2, 2)]


def test_firms_with_n_unique(hits):
    assert found(fo.firms_with_n_unique(hits.filter("source = 'web'"), 2)) == [(1, ["a"], 1), (2, ["b"], 1)]


def test_panel_keeps_web_firms_only_and_null_rows(spark, hits):
    firms = made(spark, "id long, canton string", (1, "Z"), (2, None), (3, "Z"), (4, "L"))
    counts = fo.unique_keywords(hits, "source", "id", "category")
    panel = fo.panel_from_counts(firms, counts)
    joined = fo.firm_panel(
        firms, fo.firm_lists(counts.filter("source = 'web'"), "web"), fo.firm_lists(counts.filter("source = 'pat'"), "pat"))
    assert found(panel) == found(joined)
    assert found(fo.panel_long(panel, "pat")) == [(1, "a", 1, 1), (2, None, None, None)]
    # A null canton is neither in a region nor outside it.
    assert found(fo.panel_long(panel, "web", exclude_canton="L")) == [(1, "a", 3, 2), (1, "b", 1, 1)]
    with pytest.raises(ValueError):
        fo.panel_long(panel, "other")


def test_collect_parts_keeps_everything(spark):
    rows = made(spark, "id long, publication long", *[(k, i) for k in (1, None) for i in range(500)], (2, 7))
    parts = fo.collect_parts(rows, "id", "publication", 100).collect()
    assert sorted(v for r in parts if r.id is None for v in r.publication) == list(range(500))
    assert sum(r.id is None for r in parts) == 5
    assert sorted(v for r in parts if r.id == 1 for v in r.publication) == list(range(500))
    assert sum(r.id == 1 for r in parts) == 5
    assert [(r.part, r.publication) for r in parts if r.id == 2] == [(0, [7])]


def test_applicants(spark):
    patents = made(spark, "publication string, applicants string", ("p", "A; B"), ("q", None), ("r", "C"))
    assert found(fo.applicants(patents)) == [("p", "A"), ("p", "B"), ("q", None), ("r", "C")]


COUNTS = "id long, category string, n_kw long, n_unique long"


@pytest.fixture(scope="module")
def counts(spark):
    return made(spark, COUNTS, (1, "a", 9, 3), (2, "a", 1, 1), (3, "a", 1, 1), (1, "b", 2, 2))


def test_distribution(counts):
    assert found(di.threshold_counts(counts, [1, 3])) == [
        ("a", 1, 3), ("a", 3, 1), ("b", 1, 1), ("b", 3, 0)]
    assert found(di.survival_curve(counts)) == [("a", 1, 3), ("a", 3, 1), ("b", 2, 1)]
    assert found(di.elbow_curve(counts, 4)) == [(1, 4), (2, 2), (3, 1), (4, 0)]
    assert found(di.match_histogram(counts)) == [(1, 2), (2, 1), (9, 1)]
    assert found(di.threshold_ratio(counts, 1, 2)) == [(4, 2, 0.5)]
    assert found(di.top_categories(counts, 1)) == [("a", 3)]


def test_survival_counts_label_nulls(spark):
    panel = made(spark, COUNTS, (1, None, None, None), (2, "a", 1, 1))
    assert found(di.survival_counts(panel)) == [("No category", 0, 1), ("a", 1, 1)]


def test_cooccurrence(spark):
    pairs = made(spark, "id long, category string", (1, "a"), (1, "b"), (1, "b"), (2, "a"), (2, "b"), (3, "c"), (4, None))
    got = {(r[0], r[1]): r[2] for r in di.category_cooccurrence(pairs, zeros=True).collect()}
    assert len(got) == 9 and got[("a", "b")] == got[("b", "a")] == 2
    assert got[("a", "a")] == 0 and got[("c", "a")] == 0


def test_rank_keywords_ties(spark):
    rows = made(spark, "keyword string", ("x",), ("x",), ("y",), ("z",))
    assert found(di.rank_keywords(rows)) == [("x", 2, 1), ("y", 1, 2), ("z", 1, 2)]


@pytest.mark.parametrize("values", [[0.0, 0.1, 0.2, 0.3, 0.7, 1.0], [2.0, 2.0], [0.0, 1.0, 1.0]])
def test_bins_as_numpy(spark, values):
    frame = made(spark, "v double", *[(v,) for v in values], (None,))
    got = {r.bin: r.n for r in di.equal_width_bins(frame, "v", 10).collect()}
    want = np.histogram(values, bins=10)[0]
    assert got == {i + 1: int(n) for i, n in enumerate(want) if n}


def test_describe(spark):
    frame = made(spark, "v double", (1.0,), (2.0,), (3.0,), (4.0,), (10.0,), (20.0,), (None,))
    r = di.describe(frame, "v").first()
    assert (r["count"], r["null_count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (6, 1, 1, 2, 4, 10, 20)
    assert r["std"] == pytest.approx(np.std([1, 2, 3, 4, 10, 20], ddof=1))
    one = di.describe(made(spark, "v double", (1.0,)), "v").first()
    assert (one["std"], one["p50"]) == (None, 1.0)


REGIONAL = "id long, category string, canton string, n_unique long"


@pytest.fixture(scope="module")
def regional(spark):
    return made(
        spark, REGIONAL,
        (1, "a", "Z", 2), (1, "b", "Z", 1), (2, "a", "Z", 1), (3, "a", "L", 2), (4, "b", "L", 2), (5, "b", "L", 2),
        (6, "c", "L", 2), (7, "a", None, 9), (8, None, "Z", None),
    )


def test_regional_denominators(regional):
    by_hits = {r.category: r for r in rg.rta_share_of_hits(regional, "Z", 1).collect()}
    assert by_hits["a"].percent_region == pytest.approx(2 / 3) and by_hits["a"].percent_rest == pytest.approx(1 / 3)
    by_firms = {r.category: r for r in rg.rta_share_of_firms(regional, "Z", 1).collect()}
    # Three firms inside (one without a category), four outside; the null canton is on neither side.
    assert by_firms["a"].percent_region == pytest.approx(2 / 3) and by_firms["a"].percent_rest == pytest.approx(1 / 4)
    by_rows = {r.category: r for r in rg.rta_share_of_rows(regional, "Z", 1).collect()}
    assert by_rows["a"].percent_region == pytest.approx(2 / 4) and by_rows["a"].percent_rest == pytest.approx(1 / 4)
    assert set(by_hits) == set(by_firms) == set(by_rows) == {"a", "b"}
    assert by_rows["a"].log_rta == pytest.approx(math.log10(2))
    assert rg.rta_share_of_hits(regional, "Z", 1, min_count=1).count() == 1


def test_sides_swapped_give_the_inverse(spark):
    two = made(spark, REGIONAL, (1, "a", "Z", 2), (2, "a", "L", 1), (3, "b", "L", 1), (4, "b", "Z", 1), (5, "b", "Z", 1))
    z = {r.category: r.ratio for r in rg.rta_share_of_firms(two, "Z", 1).collect()}
    lu = {r.category: r.ratio for r in rg.rta_share_of_firms(two, "L", 1).collect()}
    assert all(z[c] * lu[c] == pytest.approx(1) for c in z)
    every = {(r.canton, r.category): r.ratio for r in rg.rta_all_regions(two, 1).collect()}
    assert all(every[("Z", c)] == pytest.approx(z[c]) for c in z)


def test_region_report_and_shares(regional):
    report = {r.category: r for r in rg.region_report(regional, "Z", 1).collect()}
    assert report["a"].n_firms == 2 and report["a"].percent == pytest.approx(0.5)
    assert report["a"].ratio == pytest.approx(0.5 / (4 / 9))
    shares = {r.category: r.percent for r in rg.category_shares(regional, 2).collect()}
    assert shares["b"] == pytest.approx(2 / 9)


def test_agreement(hits):
    flags = ag.source_flags(hits)
    assert found(flags) == [(1, "a", 1, 1), (1, "b", 1, 0), (2, "b", 1, 0), (3, "c", 0, 1)]
    pairs = ag.paired_sets(flags, "web", "pat")
    assert found(ag.with_jaccard(pairs, "web", "pat")) == [(1, ["a", "b"], ["a"], 0.5)]
    assert found(ag.overlap_shares(pairs, "web", "pat"))[0][3:] == (1.0, 0.5)
    # Only firm 1 is on both sides; b has no patent there, so its reverse probability is 0.
    assert found(ag.conditional_probabilities(flags)) == [("a", 1.0, 1.0), ("b", 0.0, 0.0)]
    assert found(ag.mean_sizes(pairs, "web", "pat")) == [(2.0, 1.0)]
    assert found(ag.source_flags(hits, 2)) == [(1, "a", 1, 0), (2, "b", 1, 0)]


def test_jaccard_properties(spark):
    frame = made(spark, "a array<string>, b array<string>", (["x", "y"], ["y", "z"]), ([], []), (["x"], ["x", "x"]))
    got = frame.select(sets.jaccard(F.col("a"), F.col("b")), sets.jaccard(F.col("b"), F.col("a"))).collect()
    assert [r[0] for r in got] == [r[1] for r in got] == [pytest.approx(1 / 3), None, 1.0]


def test_shares_and_ranks(spark):
    counts = made(
        spark, "source string, id long, category string, n_unique long",
        ("web", 1, "a", 2), ("web", 2, "a", 1), ("web", 2, "b", 3), ("pat", 1, "a", 1), ("pat", 3, "b", 1), ("pat", 3, "a", 5))
    shares = ag.source_shares(counts, 1)
    assert found(shares) == [("a", 1.0, 1.0, 0.0), ("b", 0.5, 0.5, 0.0)]
    assert found(ag.rank_shift(shares)) == [("a", 1, 1, 0), ("b", 2, 2, 0)]


def test_spearman_with_ties(spark):
    frame = made(spark, "x double, y double", (1.0, 2.0), (2.0, 2.0), (2.0, 5.0), (4.0, 7.0), (None, 1.0))
    r = ag.correlations(frame, "x", "y").first()
    assert r.pearson == pytest.approx(np.corrcoef([1, 2, 2, 4], [2, 2, 5, 7])[0, 1])
    assert r.spearman == pytest.approx(np.corrcoef([1, 2.5, 2.5, 4], [1.5, 1.5, 3, 4])[0, 1])


def test_answers_agree_in_any_order(spark):
    a = made(spark, "id long, category string", (1, "b"), (1, "a"), (2, "a"))
    k = made(spark, "id long, category string", (1, "a"), (1, "b"), (1, "b"), (2, "c"))
    assert [r.jac_sim for r in ag.answer_agreement(a, k).orderBy("id").collect()] == [1.0, 0.0]


def test_words_of_sources(spark):
    rows = made(
        spark, "keyword string, category string, source string, page long",
        ("x", "a", "web", 1), ("x", "a", "web", 1), ("x", "a", "pat", 2), ("y", "a", "pat", 2), ("z", "b", "web", 3))
    assert found(ag.word_counts(rows, "a")) == [("x", 2, 1, 1), ("y", 0, 1, 1)]
    lookup = made(spark, "keyword string, category string", ("x", "a"), ("x", "b"))
    got = found(ag.word_frequencies(rows, lookup))
    assert [r[-1] for r in got] == ["a", "b"] and got[0][1:3] == (pytest.approx(1 / 3), 0.5)


def test_set_overlap(spark):
    a, c = made(spark, "id long", (1,), (1,), (2,)), made(spark, "id long", (2,), (3,))
    assert found(ag.set_overlap(a, c)) == [(2, 2, 1, 0.5)]


def test_crawl(spark):
    run = made(
        spark, "id long, dl_rank int, error string, timestamp string",
        (1, 0, "None", "Mon Jan  1 00:00:07 2024"), (1, 1, "None", "Tue Jan 02 00:00:07 2024"), (2, 0, None, None),
        (3, 0, "404", "garbage"))
    assert [tuple(r) for r in crawl.error_percent(run).collect()] == [(None, 1, 33.33), ("404", 1, 33.33), ("None", 1, 33.33)]
    assert found(crawl.subpage_counts(run)) == [(1, 1)]
    r = crawl.run_summary(run).first()
    assert (r.n_companies, r.seconds, r.mean_subpages) == (3, 86400, 1.0)


def test_percent_rounds_half_to_even(spark):
    run = made(spark, "id long, dl_rank int, error string", *[(i, 0, "x" if i == 0 else "y") for i in range(800)])
    assert {r.error: r.percent for r in crawl.error_percent(run).collect()} == {"x": 0.12, "y": 99.88}


def test_domains(spark):
    urls = ["https://www.a.ch/x", "http://b.ch", "c.ch/y?z", "www.d.ch", "wwwx.e.ch", "", None]
    got = [r[0] for r in made(spark, "u string", *[(u,) for u in urls]).select(tx.domain(F.col("u"))).collect()]
    assert got == ["a.ch", "b.ch", "c.ch", "d.ch", "wwwx.e.ch", "", None]


def test_links(spark):
    pages = made(
        spark, "id string, name string, url string, links string",
        ("1", "A", "https://a.ch/", '["https://www.b.ch/x", "http://b.ch", "unknown.ch"]'),
        ("2", "B", "b.ch", '["a.ch/1", "b.ch"]'), ("3", "G", "google.com", '["a.ch"]'), ("4", "N", "n.ch", None))
    edges = links.link_edges(pages)
    assert found(edges) == [("A", "B"), ("B", "A"), ("B", "B")]
    assert found(links.degrees(edges)) == [("A", 2), ("B", 4)]
    assert links.degrees(edges).agg(F.sum("degree")).first()[0] == 2 * edges.distinct().count()
    assert found(links.in_degree_ranking(edges)) == [("A", 1), ("B", 2)]
    more = edges.unionByName(made(spark, "src string, dst string", ("B", "Z")))
    assert found(links.induced(more)) == found(edges)
    mapping = made(spark, "old string, new string", ("A", "AA"))
    assert found(links.relabel(edges, mapping)) == [("AA", "B"), ("B", "AA"), ("B", "B")]


def test_clean_text(spark):
    pages = made(
        spark, "url long, text string", (2, "same text"), (1, "same text"), (3, ""), (4, None),
        (5, "Powered by Imunify360 x"), (6, "a flex-basis: b"), (7, "documentXgetElementById"), (8, "same text and more"))
    assert found(to.clean_text(pages)) == [(1, "same text"), (7, "documentXgetElementById"), (8, "same text and more")]
    long = made(spark, "url long, text string", (1, "x" * 20_000 + "a"), (2, "x" * 20_000 + "b"))
    assert to.clean_text(long).count() == 2


def test_token_encode(spark):
    pages = made(spark, "url long, text string", (1, "b a b c"), (2, ""), (3, "A, z"), (4, None), (1, "b a b c"))
    vocab = to.vocabulary(pages.limit(4), 2)
    assert found(vocab) == [("a", 2), ("b", 3)]
    first = [(1, 0, [3, 2, 3], [1, 1, 1]), (1, 1, [1, 0, 0], [1, 0, 0])]
    assert found(to.token_encode(pages, vocab, 3)) == [
        first[0], first[0], first[1], first[1], (2, 0, [0, 0, 0], [0, 0, 0]), (3, 0, [2, 1, 0], [1, 1, 0]),
        (4, 0, [0, 0, 0], [0, 0, 0])]


@pytest.mark.parametrize("most", [0, 1, 3])
def test_frequent_words_are_not_joined(spark, monkeypatch, most):
    written = {}
    monkeypatch.setattr(to, "stored", lambda table, name: written.setdefault(name, stored(table, name)))
    pages = made(spark, "url long, text string", (1, "a a a b a z c a"), (2, ""), (1, "a a a b a z c a"), (None, None), (4, "e z e a b b"), (5, "a a"))
    vocab = made(spark, "word string, token int", ("a", 2), ("b", 3), ("c", 4), ("e", 5), ("f", 6))
    assert found(to.token_encode(pages, vocab, 8, broadcast_words=most)) == found(to.token_encode(pages, vocab, 8))
    assert {w for r in written["rare-words"].collect() for w in r.rare} == {*"abce"[most:], "z"}
    assert max(len(r.rare) for r in written["rare-words"].collect()) <= 4


def test_windows_hold_every_word(spark):
    words = [f"w{i * i % 37}" for i in range(500)]
    pages = made(spark, "url long, text string", (1, " ".join(words)), (2, "w1 w2"))
    vocab = to.vocabulary(pages.repartition(5))
    names = {r.token: r.word for r in vocab.collect()}
    assert sorted(names) == list(range(to.FIRST_ID, to.FIRST_ID + len({*words, "w1", "w2"})))
    rows = to.token_encode(pages, vocab, 64).filter("url = 1").orderBy("window").collect()
    ids = [i for r in rows for i, m in zip(r.input_ids, r.attention_mask, strict=True) if m]
    assert [names[i] for i in ids] == words and len(rows) == 8


def test_idf(spark):
    docs = made(spark, "text string, lang string", ("The laser beam", "en"), ("laser x1 x1", "en"), ("rayon x1", "fr"), (None, "en"))
    got = {r.word: r.idf for r in vo.idf_words(docs, stop_words=["the"]).collect()}
    assert got == {"laser": pytest.approx(math.log(4 / 3) + 1), "x1": pytest.approx(math.log(4 / 3) + 1)}
    flags = vo.word_lists(vo.document_frequencies(docs, by=["lang"]), ["en", "fr"])
    kept = vo.idf_language(vo.idf_words(docs), flags, ["en", "fr"])
    assert [(r.word, r.en, r.fr) for r in kept.collect()] == [("laser", True, False)]


def test_vectors(spark):
    labels = ve.Labels(["a", "b"], np.array([[1.0, 0.0], [0.0, 1.0]]))
    pages = made(spark, "url long, embedding array<float>", (1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [-1.0, 0.0]))
    sims = ve.similarity_arrays(pages.repartition(2), labels, "url").orderBy("url")
    assert [r.sims for r in sims.collect()] == [[pytest.approx(0.6), pytest.approx(0.8)], [0.0, 0.0], None, [-1.0, 0.0]]
    assert found(ve.predicted(sims, labels, "url", 0.3)) == [
        (1, ["a", "b"]), (2, ["unknown"]), (3, ["unknown"]), (4, ["unknown"])]
    assert found(ve.best_label(sims, labels, "url", 0.5)) == [(1, "b", pytest.approx(0.8))]
    assert ve.similarity_long(sims, labels, "url").count() == 6
    assert ve.similarity_wide(sims, labels, "url").columns == ["url", "sim_a", "sim_b"]
    with pytest.raises(Exception, match="entries"):
        ve.similarity_arrays(made(spark, "url long, embedding array<float>", (1, [1.0])), labels, "url").collect()


def test_pca_scores_are_centred(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(60, 4)) * [5, 2, 1, 0.1] + 7
    sims = made(spark, "url long, sims array<double>", *[(i, [float(x) for x in r]) for i, r in enumerate(data)])
    got = ve.pca_scores(sims, "url", 3).orderBy("url").collect()
    centred = data - data.mean(axis=0)
    _, s, axes = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(np.abs([r.pc1 for r in got]), np.abs(centred @ axes[0]))
    assert got[0].explained == pytest.approx(list((s**2 / (s**2).sum())[:3]))


def test_hash_embeddings(spark):
    pages = made(spark, "url long, text string", (1, "Laser beam"), (2, "beam, laser"), (3, ""))
    got = {r.url: r.embedding for r in ve.embed_hashing(pages, "url", size=16).collect()}
    assert got[1] == got[2] and len(got[3]) == 16
    assert sum(x * x for x in got[1]) == pytest.approx(1, abs=1e-5)


def test_parse_answers(spark):
    good = '{"primary_field": null, "fields": ["a", "b"], "explanation": "None, True", "confidence": "High"}'
    literal = "{'primary_field': None, 'fields': ['a'], 'explanation': 'is None, or \"True\"', 'confidence': \"it's\"}"
    rows = made(spark, "id long, answer string", (1, good), (2, literal), (3, '{"fields": ['), (4, None), (5, "sorry"))
    got = [tuple(r) for r in lb.parse_answers(rows).orderBy("id").collect()]
    assert got == [
        (1, None, ["a", "b"], "None, True", "High"), (2, None, ["a"], 'is None, or "True"', "it's"),
        (3, None, None, None, None), (4, None, None, None, None), (5, None, None, None, None)]


def test_python_literals(spark):
    rows = made(
        spark, "id long, answer string",
        (1, "{'primary_field': None, 'fields': ('a', 'b (c), d'), 'explanation': 'x, ]', 'confidence': 'Low',}"),
        (2, "{'primary_field': 'a', 'fields': ['a',], 'explanation': \"it's (so),\", 'confidence': 'High'}"))
    got = [tuple(r) for r in lb.parse_answers(rows).orderBy("id").collect()]
    assert got == [(1, None, ["a", "b (c), d"], "x, ]", "Low"), (2, "a", ["a"], "it's (so),", "High")]


def test_read_batch(spark, tmp_path):
    line = '{"custom_id": "CHCHE000000001-9", "response": {"body": {"choices": [{"message": {"content": "%s"}}]}}}'
    path = tmp_path / "batch.jsonl"
    path.write_text("\n".join([line % r'{\"fields\": [\"a\"]}', line % "oops", '{"custom_id": "CHCHE000000002"}']))
    got = found(lb.read_batch(spark, str(path)).select("id", "fields"))
    assert got == [("CHCHE000000001", None), ("CHCHE000000001", ["a"]), ("CHCHE000000002", None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        lb.read_batch(spark, str(path), strict=True).collect()
    assert found(lb.read_batch(spark, str(path), id_chars=5).select("id").distinct()) == [("CHCHE",)]
    with pytest.raises(Exception, match="fewer than 40"):
        lb.read_batch(spark, str(path), id_chars=40).collect()


def test_prompts(spark, hits):
    texts = made(spark, "id long, text string", (1, "abcdef"))
    texts = texts.selectExpr("id", "0L AS part", "text")
    assert found(lb.prompts(texts, "head:", 4)) == [(1, 0, 0, "head:abcd"), (1, 0, 1, "head:ef")]
    assert found(lb.candidates(hits, 2)) == [(1, "a", 2)]
    assert "- x\n" in lb.instructions(["x"]) and "- x: what it is\n" in lb.instructions({"x": "what it is"})


def test_samples(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    part = sampling.sample_fraction(rows, "k", 0.3, seed=1)
    assert found(part) == found(sampling.sample_fraction(rows.repartition(5), "k", 0.3, seed=1))
    assert 230 < part.count() < 370
    assert sampling.sample_ids(rows, "k", 10).count() == 10
    labels = made(spark, "id long, category string", *[(i, "a") for i in range(20)], (3, "b"), (30, "b"), (31, None))
    urls = made(spark, "id long, url string", *[(i, f"u{i}") for i in range(40)])
    sample = sampling.review_sample(labels, urls, per_category=5).collect()
    assert sorted((r.category, r.id) for r in sample) == [
        ("None", 31), ("a", 0), ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 30)]


def test_sources(spark, tmp_path):
    rows = spark.range(10).selectExpr("id", "cast(id as string) AS s")
    folder = str(tmp_path / "t")
    src.write_parquet(rows, f"{folder}/good")
    (tmp_path / "t" / "good" / "bad.parquet").write_text("not parquet")
    assert src.read_parquet(spark, folder, schema="id long, s string", skip_corrupt=True).count() == 10
    bad = [r.file for r in src.unreadable_files(spark, folder, "id long, s string").collect()]
    assert len(bad) == 1 and bad[0].endswith("bad.parquet")
    ragged = tmp_path / "r.csv"
    ragged.write_text("a,b\n1,2,3\n4\n")
    got = src.read_csv(spark, str(ragged), schema="a int, b int", ragged=True)
    assert found(got) == [(1, 2), (4, None)]
    with pytest.raises(ValueError):
        src.read_csv(spark, str(ragged), ragged=True)
    assert src.read_csv(spark, src.write_csv(rows, str(tmp_path / "c"))).dtypes == [("id", "int"), ("s", "int")]


def test_file_with_a_damaged_row_group(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "files"
    folder.mkdir()
    rows = pa.table({"id": np.random.default_rng(0).integers(0, 1 << 60, 50_000)})
    for name in ("good", "bad"):
        pq.write_table(rows, folder / f"{name}.parquet", row_group_size=10_000, compression="zstd", use_dictionary=False)
    pq.write_table(rows.slice(0, 0), folder / "empty.parquet")
    group = pq.ParquetFile(folder / "bad.parquet").metadata.row_group(3).column(0)
    data = bytearray((folder / "bad.parquet").read_bytes())
    data[group.data_page_offset : group.data_page_offset + 4_000] = b"\xff" * 4_000
    (folder / "bad.parquet").write_bytes(bytes(data))
    bad = [r.file for r in src.unreadable_files(spark, str(folder), "id long").collect()]
    assert len(bad) == 1 and bad[0].endswith("bad.parquet")
    assert src.read_whole_files(spark, str(folder), "id long").count() == 50_000


def test_ctime(spark):
    frame = made(spark, "t string", ("Mon Jan  1 00:00:07 2024",), ("Sun Dec 31 23:59:59 2023",), ("x",), (None,))
    got = [str(r[0]) for r in frame.select(tx.parse_ctime(F.col("t"))).collect()]
    assert got == ["2024-01-01 00:00:07", "2023-12-31 23:59:59", "None", "None"]
