"""Subword ids against the tokenizer library on whole texts."""

from __future__ import annotations

from functools import cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from firmlens.operators import subwords
from firmlens.operators import text as to
from firmlens.plans import QUERIES
from firmlens.sources.files import stored

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = ["", None, " \n\t", "The cat's hat, 2024!", "DON'T we'LL", "naïve café 漢字 \U0001f600\U0001f600", "<|endoftext|> a", "x" * 3_000,
       "a b " * 2_000, "--- *** ???", "Über straße end", "1234567890", "'s", "it's"]


@cache
def library() -> Tokenizer:
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return own


def expected(text: str | None) -> list[int]:
    return library().encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("most", [500_000, 0])
def test_ids_are_the_library_s(spark, most):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (None, "null key")]
    docs = [(1000 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    pages = spark.createDataFrame(texts + docs, "url long, text string").repartition(3)
    found = [(r.url, tuple(r["__ids"])) for r in subwords.subword_ids(pages, PATH, broadcast_pieces=most).collect()]
    assert sorted(map(repr, found)) == sorted(repr((k, tuple(expected(t)))) for k, t in texts + docs)


@pytest.mark.parametrize("most", [40, 300])
def test_frequent_pieces_are_not_joined(spark, monkeypatch, most):
    written = {}
    monkeypatch.setattr(to, "stored", lambda table, name: written.setdefault(name, stored(table, name)))
    docs = [(i, t) for i, t in enumerate(ODD)] + [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    pages = spark.createDataFrame(docs, "url long, text string").repartition(3)
    found = [(r.url, tuple(r["__ids"])) for r in subwords.subword_ids(pages, PATH, broadcast_pieces=most).collect()]
    assert sorted(found) == sorted((k, tuple(expected(t))) for k, t in docs)
    counts = sorted((r.n, r.piece) for r in subwords.counted_pieces(pages).collect())
    joined = {w for r in written["rare-words"].collect() for w in r.rare}
    assert len(counts) > most and 0 < len(counts) - len(joined) <= most
    rarest = max(n for n, p in counts if p in joined)
    assert joined == {p for n, p in counts if n <= rarest}


def test_windows(spark):
    pages = spark.createDataFrame([(1, "one two three four five"), (2, None)], "url long, text string")
    ids = expected("one two three four five")
    rows = subwords.subword_encode(pages, PATH, 4, before=7, after=8, pad=9).orderBy("url", "window").collect()
    assert [(r.url, r.window, r.input_ids, r.attention_mask) for r in rows] == [
        (1, 0, [7, *ids[:2], 8], [1] * 4), (1, 1, [7, *ids[2:4], 8], [1] * 4), (1, 2, [7, ids[4], 8, 9], [1, 1, 1, 0]), (2, 0, [7, 8, 9, 9], [1, 1, 0, 0]),
    ]


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["subword_encode"](spark, SF).orderBy("url", "window").collect()
    got: dict = {}
    for r in rows:
        own = [i for i, m in zip(r.input_ids, r.attention_mask, strict=True) if m]
        assert len(r.input_ids) == len(r.attention_mask) == 512 and own[0] == 49406 and own[-1] == 49407
        got.setdefault(r.url, []).extend(own[1:-1])
    assert got == {k: expected(t) for k, t in docs.items()}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "url long, text string")
    assert subwords.subword_encode(pages, PATH, 8).count() == 0
