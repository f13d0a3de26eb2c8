"""Whole-word matching against a plain scan written from the rule."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from firmlens.operators import keywords as kw


def scan(text, phrases, compat=False):
    """Every whole-word occurrence, character by character."""
    found, low = Counter(), text.lower()
    for phrase in phrases:
        for start in range(len(low) - len(phrase) + 1):
            if low[start:start + len(phrase)] != phrase:
                continue
            before = low[start - 1] if start else ""
            after = low[start + len(phrase):start + len(phrase) + 1]
            if before and (before.isalnum() or before == "_"):
                continue
            if after and (after.isalnum() or (after == "_" and not compat)):
                continue
            if compat and start == 0:
                continue
            found[phrase] += 1
    return found


def expected(pages, phrases, compat=False):
    return sorted((u, k, n) for u, t in pages for k, n in scan(t, phrases, compat).items())


def got(spark, pages, phrases, **how):
    texts = spark.createDataFrame(pages, "url long, text string").repartition(3)
    keywords = spark.createDataFrame([(p,) for p in phrases], "keyword string")
    return sorted(tuple(r) for r in kw.match_keywords(texts, keywords, **how).collect())


def made_up(n, seed):
    rng = random.Random(seed)
    pieces = ["aa", "a", "b", "_", " ", " ", ".", "é", "É", "1", "c++", "aa aa", "(", "\n", "ß", "-"]
    pages = [(i, "".join(rng.choices(pieces, k=rng.randint(0, 30)))) for i in range(n)]
    phrases = {"".join(rng.choices(pieces, k=rng.randint(1, 4))).lower() for _ in range(120)}
    return pages, sorted(p for p in phrases if p.strip() and p == p.lower())


@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("broadcast_phrases", [1000, 0])
def test_random_texts(spark, compat, broadcast_phrases):
    pages, phrases = made_up(600, seed=5)
    assert got(spark, pages, phrases, compat=compat, broadcast_phrases=broadcast_phrases) == expected(
        pages, phrases, compat)


def test_rules(spark):
    pages = [(1, "Laser cutting, laser; lasers _laser laser_ LASER"), (2, "aa aa aa."), (3, ""), (4, "c++ or c++11")]
    assert got(spark, pages, ["laser", "aa aa", "c++"]) == [(1, "laser", 3), (2, "aa aa", 2), (4, "c++", 1)]


def test_compat_loses_the_first_position(spark):
    assert got(spark, [(1, "laser and laser_")], ["laser"], compat=True) == [(1, "laser", 1)]


def test_null_text_and_quote_end(spark):
    assert got(spark, [(1, None), (2, r"x \E y")], [r"\e y", "x"]) == [(2, r"\e y", 1), (2, "x", 1)]


def test_dictionary(spark):
    raw = spark.createDataFrame(
        [("a", "Laser beam,  x-ray , the"), ("a", "laser beam"), ("b", "laser beam, abcd")],
        "category string, prompt_output string")
    assert sorted(map(tuple, kw.keyword_dictionary(raw).collect())) == [
        ("a", "laser beam"), ("a", "x-ray"), ("b", "laser beam")]
    assert sorted(r[0] for r in kw.keyword_list(raw).collect()) == ["abcd", "laser beam", "x-ray"]
    assert kw.joined_dictionary(kw.keyword_dictionary(raw)).filter("category = 'a'").first()[1] == "laser beam, x-ray"


def test_lists_and_labels(spark):
    pages = spark.createDataFrame([(1, "f"), (2, "f")], "url long, id string")
    hits = spark.createDataFrame([(1, "laser", 2), (1, "beam", 1)], "url long, keyword string, n long")
    dictionary = spark.createDataFrame([("a", "laser"), ("b", "laser"), ("a", "beam")], "category string, keyword string")
    lists = kw.match_lists(pages, hits)
    assert {r.url: r.matches for r in lists.collect()} == {1: ["beam", "laser", "laser"], 2: []}
    assert kw.hits_from_lists(lists).count() == 3
    labelled = sorted(map(tuple, kw.label_unmatched(lists, dictionary).collect()))
    assert labelled.count((1, "laser", "a")) == 2 and labelled[-1] == (2, "No keyword", "No category")
    assert kw.attach_firm(kw.attach_category(hits, dictionary), pages).count() == 3
    doubled = pages.unionByName(pages)
    assert kw.attach_firm(hits, doubled).count() == 4
    assert kw.attach_firm(hits, doubled, distinct_pages=True).count() == 2


@pytest.mark.parametrize("broadcast_phrases", [1000, 0])
def test_repeated_and_null_keys(spark, broadcast_phrases):
    """Both plans give the hits of every row, whatever its key."""
    pages = [(1, "laser, ++ and laser"), (1, "laser, ++ and laser"), (1, "laser"), (None, "laser ++"), (2, None), (None, None), (None, "none")]
    phrases = ["laser", "++", "and laser"]
    texts = spark.createDataFrame(pages, "url long, text string").repartition(3)
    keywords = spark.createDataFrame([(p,) for p in phrases], "keyword string")
    found = [tuple(r) for r in kw.match_keywords(texts, keywords, broadcast_phrases=broadcast_phrases).collect()]
    want = [(u, k, n) for u, t in pages if t is not None for k, n in scan(t, phrases).items()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_hot_word_is_split(spark):
    """A third of all rows hold one word, and the dictionary is joined by a shuffle."""
    pages = [(i, "the laser" if i % 3 == 0 else f"word{i} of {i % 50}") for i in range(3000)]
    phrases = ["the", "the laser", *[f"word{i}" for i in range(0, 3000, 7)]]
    assert got(spark, pages, phrases, broadcast_phrases=0) == expected(pages, phrases)
