"""The registered queries against libraries and brute force, all their columns."""

from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_documents import base, naive_spans, removed
from tokenizers import Tokenizer

from firmlens.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark) -> dict:
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name: str) -> list:
    return queries.QUERIES[name](spark, SF).collect()


@pytest.fixture(scope="module")
def ids(texts) -> dict:
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return dict(zip(texts, (e.ids for e in own.encode_batch(list(texts.values()), add_special_tokens=False)), strict=True))


def test_packing(spark, ids):
    pieces: dict = {}
    places: dict = {}
    for r in rows(spark, "op2_best_fit_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for key, own in pieces.items():
        whole, at = [*ids[key], 2], 0
        for n, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (n, at) and r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
            assert n == 0 or r.length == 1024  # the first piece may be shorter
            at += r.length
        assert at == len(whole) and (len(own) == 1) == (len(whole) <= 1024)
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(places) <= -(-sum(len(v) + 1 for v in ids.values()) // 1024) * 1.02 + 2


def test_token_counts(spark, texts, ids):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows(spark, "op3_token_counts")}
    assert got == {k: (len(t.encode()), len(ids[k]), len(ids[k]) > 512) for k, t in texts.items()}


def test_quality(spark, texts):
    found = rows(spark, "op4_line_quality")
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found} == {
        k: base(t) for k, t in texts.items()
    }
    assert not any(r.kept and r.base_failed for r in found)


def test_bpe_round_trip(spark, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows(spark, "op8_bpe_transducer")}
    expected = {}
    for k, t in texts.items():
        coded = own.encode_ordinary(t)
        expected[k] = (len(coded), hashlib.sha256(np.array(coded, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert got == expected


def test_secrets(spark, texts):
    for r in rows(spark, "op9_secret_scan"):
        known = naive_spans(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in known) for k in ("assign", "access", "hex")]
        listed = [f"{k}:{a}:{b}" for k, a, b in known]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == listed


def test_suffix_dedup(spark, texts):
    found = rows(spark, "op10_suffix_dedup")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    assert got == {k: tuple(v) for k, *v in removed(list(texts.items()), 400, False)}
    assert all(r.n_kept == r.n_bytes - r.n_removed and len(r.kept_text.encode()) >= r.n_kept for r in found)
    assert all(r.kept_text == texts[r.doc_id] for r in found if not r.n_removed)
