"""Pre-tokens, token counts, packing, encoding and decoding against the public libraries."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_tables import ordered, texts_of
from tokenizers import Tokenizer

from firmlens.llm import packing, pretokens, queries, token_counts, transducer

JSON, RANKS = queries.BYTE_BPE, queries.MULTI_BPE
SPLIT = regex.compile(public_tokenizers.PATTERN)
SOME = st.text(st.sampled_from("a's't're'llvemd \n\t  é1²½.,'’ 　 \U0001f600漢字<|endoftext|>"), max_size=60)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def ranked():
    ranks = transducer.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(SOME, min_size=1, max_size=4))
def test_pretokens(texts):
    words, first = pretokens.pretokens(texts)
    assert [words[a:b] for a, b in zip(first, first[1:], strict=False)] == [SPLIT.findall(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(SOME | st.text(max_size=20), min_size=1, max_size=4))
def test_different_pretokens(texts):
    words, place, first = pretokens.different_pretokens(texts)
    assert len(set(words)) == len(words) and set(place.tolist()) == set(range(len(words)))
    expected = [SPLIT.findall(t) for t in texts]
    assert [[words[i] for i in place[a:b]] for a, b in zip(first, first[1:], strict=False)] == expected
    table = pretokens.Remembered(lambda own: [w.encode() for w in own])
    assert list(pretokens.looked_up_bytes(texts, table)) == [t.encode() for t in texts]


def test_a_word_is_looked_up_once_for_a_group_of_texts():
    asked = []

    class Table(pretokens.Remembered):
        def __call__(self, words):
            asked.extend(words)
            return super().__call__(words)

    table = Table(lambda words: [len(w) for w in words])
    assert list(pretokens.looked_up(["one one one", "one two" * 50], table)) == [[3, 4, 4], [3, *[7] * 49, 4]]
    assert len(asked) == len(set(asked)) == 4


def test_every_character_is_split_as_the_library_does(library):
    classes = pretokens.classes_without(token_counts.unknown_to(JSON))
    chars = [chr(i) for i in [*range(1, 0xD800, 5), *range(0xE000, 0x33000, 11), 0x3AAAA, 0x10FFFF]]
    for at in range(0, len(chars), 500):
        texts = ["a" + c + "1." for c in chars[at : at + 500]]
        words, first = pretokens.pretokens(texts, classes)
        for text, a, b in zip(texts, first, first[1:], strict=False):
            spans = [text[x:y] for _, (x, y) in library.pre_tokenizer.pre_tokenize_str(text)]
            assert words[a:b] == spans, hex(ord(text[1]))


def test_remembered_stays_bounded_and_right():
    calls = []
    table = pretokens.Remembered(lambda words: [calls.append(w) or len(w) for w in words], most=50)
    for i in range(0, 1000, 10):
        words = ["every"] + ["x" * (1 + (i + j) % 300) for j in range(10)]
        assert table(words) == [len(w) for w in words]
        assert len(table.new) + len(table.old) <= 130
    assert calls.count("every") == 1


@pytest.mark.parametrize("name", ["odd", "documents", "nothing"])
def test_counts_are_the_librarys(request, name, library):
    table = request.getfixturevalue(name)
    found = token_counts.token_counts(table, JSON).collect()
    expected = [(k, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in texts_of(table)]
    assert ordered(map(tuple, found)) == ordered(expected)


@pytest.mark.parametrize("name", ["odd", "documents", "nothing"])
@pytest.mark.parametrize("length", [1024, 64])
def test_packing(request, name, length, library):
    table = request.getfixturevalue(name)
    rows = packing.pack_documents(table, JSON, length, keep_ids=True).collect()
    expected = []
    for k, t in texts_of(table):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        head = len(ids) % length or min(length, len(ids))
        for piece, start in enumerate([0, *range(head, len(ids), length)]):
            own = ids[start : (head if piece == 0 else start + length)]
            expected.append((k, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == ordered(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for own in places.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= length
    assert len(places) <= 1.02 * sum(r.length for r in rows) / length + 2


def test_sequences_hold_their_pieces(documents):
    packed = packing.pack_documents(documents.limit(30), JSON, 256, keep_ids=True)
    rows = packed.collect()
    total = sum(len(r.ids) for r in packing.sequences(packed).collect())
    assert total == sum(r.length for r in rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_best_fit(sizes):
    sizes = np.array(sizes, np.int64)
    room, expected = [], np.empty(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        fitting = [r for r in room if r >= sizes[i]]
        if fitting:
            room[room.index(min(fitting))] -= sizes[i]
        else:
            room.append(50 - sizes[i])
    bins = packing.best_fit(sizes, 50)
    filled = np.bincount(bins, sizes) if len(sizes) else np.zeros(0)
    assert sorted(50 - filled) == sorted(room) and expected.size == bins.size


def test_rounds_join_open_sequences(spark, monkeypatch):
    """Also with tiny tasks every item is placed once, and few more sequences are needed."""
    monkeypatch.setattr(packing, "TASK_ITEMS", 40)
    items = spark.range(2000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "id * 37 % 300 + 1 AS length", "id AS ids_crc32")
    rows = packing.pack_items(items, 1000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(2000))
    assert len({r.sequence_id for r in rows}) <= 1.1 * sum(r.length for r in rows) / 1000 + 1


@pytest.mark.parametrize("name", ["odd", "documents", "nothing"])
def test_encoding_is_the_librarys_and_decodes(request, name, ranked):
    table = request.getfixturevalue(name)
    encoded = transducer.encode_texts(table, RANKS, public_tokenizers.PATTERN)
    rows = transducer.decode_texts(encoded, RANKS).collect()
    both = transducer.encode_texts(table, RANKS, public_tokenizers.PATTERN, with_text=True).collect()
    assert ordered((r.doc_id, bytes(r.ids), r.text) for r in both) == ordered((r.doc_id, bytes(r.ids), r.text) for r in rows)
    found = [(r.doc_id, hashlib.sha256(r.ids).hexdigest(), r.text) for r in rows]
    ids = [(k, np.array(ranked.encode_ordinary(t or ""), "<u4").tobytes(), t or "") for k, t in texts_of(table)]
    assert ordered(found) == ordered((k, hashlib.sha256(i).hexdigest(), t) for k, i, t in ids)


def test_transducer_with_few_states(ranked):
    machine = transducer.Transducer(transducer.read_ranks(RANKS), most_states=20)
    for text in ["internationalization", "ééé" * 40, "abc" * 700, "\U0001f600\U0001f601", "Donaudampfschiffahrt"]:
        assert machine.encode(text.encode()) == ranked._core_bpe.encode_single_piece(text.encode())
        assert len(machine.states) <= 21


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(1, 7), max_size=30))
def test_utf8_stream_in_any_chunks(data, cuts):
    stream, out, at = transducer.Utf8Stream(), "", 0
    for n in [*cuts, len(data)]:
        out += stream.feed(data[at : at + n])
        at += n
    assert out + stream.close() == data.decode("utf-8", "replace")


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_utf8_stream_holds_less_than_a_character(text):
    stream = transducer.Utf8Stream()
    for i, byte in enumerate(text.encode()):
        stream.feed(bytes([byte]))
        assert len(stream.held) < 4, i
    assert stream.close() == ""
