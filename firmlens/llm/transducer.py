"""Byte-level BPE as a transducer that is made deterministic while it runs.

The encoding of a text is the path of tokens in which every two neighbours would be left
apart by the merges. For each place in a text exactly one token ends such a path there. A
state is the last token written and the bytes read since, with the paths through them;
reading a byte adds the token that ends at the new place. A path is dropped when no longer
token can begin where it ends, and as soon as all remaining paths begin with the same
tokens these are written. The last token decides only whether a token right behind it may
stand there, so a transition has at most two outcomes, and states that differ in the last
token share them. Both are made at their first use and kept, within a bound.
"""

from __future__ import annotations

import base64
import gc
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.pretokens import Remembered, classes_without, grouped, looked_up, unknown_chars

#: States kept in a task; beyond, the transducer is built anew.
MOST_STATES = 40_000
#: Pairs of tokens whose judgement is kept.
MOST_PAIRS = 250_000
#: Rows of an Arrow batch that are worked on at once.
SLICE = 1000
NEVER = 1 << 40
ONE_BYTE = [bytes([b]) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class State:
    __slots__ = ("live", "pending", "step")

    def __init__(self, pending: bytes, live: list[tuple[int, tuple[int, ...]]]):
        #: Bytes read behind the last token written.
        self.pending = pending
        #: Places where a token can begin that ends behind ``pending``, with the tokens on the
        #: path there; the last place is the end of ``pending``.
        self.live = live
        #: By byte: the token right behind the last one written that it completes (or None), and
        #: what follows, state and tokens written, if that token may stand there and if not.
        self.step: dict[int, list] = {}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks, self.most_states = ranks, most_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        #: Of every token and beginning of a token: its rank, if it has one, and whether a longer token begins with it.
        self.known: dict[bytes, tuple[int | None, bool]] = {
            token[:i]: (ranks.get(token[:i]), True) for token in ranks for i in range(1, len(token))
        }
        for token, rank in ranks.items():
            self.known.setdefault(token, (rank, False))
        self.apart: dict[int, bool] = {}
        self.spines: dict[int, tuple[list[int], list[int]] | None] = {}
        self.states: dict[tuple, State] = {}
        self.forget()

    def _spines(self, token: int) -> tuple[list[int], list[int]] | None:
        """The tokens that come to stand first and last while the merges make ``token``, each
        list closed by ``NEVER``; None if the merges make something else of its bytes."""
        if token not in self.spines:
            ranks = self.ranks
            parts = [bytes([b]) for b in self.bytes_of[token]]
            left, right = [ranks[parts[0]]], [ranks[parts[-1]]]
            while len(parts) > 1:
                best, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if best == NEVER:
                    break
                if at == 0:
                    left.append(best)
                if at == len(parts) - 2:
                    right.append(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.spines[token] = ([*left, NEVER], [*right, NEVER]) if len(parts) == 1 else None
        return self.spines[token]

    def stay_apart(self, first: int, second: int) -> bool:
        """Whether the merges leave ``second`` behind ``first`` (-1: nothing) as it is."""
        if len(self.apart) > MOST_PAIRS:
            self.apart.clear()
        held = self._spines(second) is not None if first == -1 else self._stay_apart(first, second)
        self.apart[first << 20 | second] = held
        return held

    def _stay_apart(self, first: int, second: int) -> bool:
        own, other = self._spines(first), self._spines(second)
        if own is None or other is None:
            return False
        right, left = own[1], other[0]
        get, bytes_of = self.ranks.get, self.bytes_of
        i = j = 0
        before, behind = bytes_of[right[0]], bytes_of[left[0]]
        while True:
            # The neighbours at the border until either is merged into the next of its side;
            # of two merges of one rank the left one comes first.
            next_right, next_left = right[i + 1], left[j + 1]
            across = get(before + behind)
            if across is not None and across < next_right and across <= next_left:
                return False
            if next_right <= next_left:
                if next_right == NEVER:
                    return True
                i += 1
                before = bytes_of[next_right]
            else:
                j += 1
                behind = bytes_of[next_left]

    def forget(self) -> None:
        for state in self.states.values():
            state.step.clear()  # states refer to each other
        self.states.clear()
        self.start = State(b"", [(0, ())])

    def _open(self, state: State, byte: int) -> list:
        """A transition without its outcomes."""
        if len(self.states) > self.most_states:
            self.forget()
        first = None
        if state.live[0] == (0, ()):
            first = self.known.get(state.pending + ONE_BYTE[byte], (None, False))[0]
        step = state.step[byte] = [first, None, None]
        return step

    def _follow(self, state: State, byte: int, step: list, held: bool) -> tuple[State, tuple[int, ...]]:
        """The outcome of a transition whose first token may stand (``held``) or not."""
        pending = state.pending + ONE_BYTE[byte]
        live = []
        path = (step[0],) if held else None
        for entry in state.live:
            place, tokens = entry
            token, longer = self.known.get(pending[place:], (None, False))
            if path is None and token is not None and tokens:
                key = tokens[-1] << 20 | token
                apart = self.apart.get(key)
                if apart or apart is None and self.stay_apart(tokens[-1], token):
                    path = (*tokens, token)
            if longer:
                live.append(entry)
        if path is None:
            raise ValueError("the vocabulary lacks a byte")
        common = 0
        if not live:
            common = len(path)
        else:
            for token in live[0][1]:
                if path[common] != token or any(tokens[common : common + 1] != (token,) for _, tokens in live):
                    break
                common += 1
        live.append((len(pending), path))
        written = path[:common]
        if written:
            cut = sum(len(self.bytes_of[t]) for t in written)
            pending = pending[cut:]
            live = [(place - cut, tokens[common:]) for place, tokens in live]
        key = (pending, *live)
        after = self.states.get(key)
        if after is None:
            after = self.states[key] = State(pending, live)
        step[1 if held else 2] = (after, written)
        return after, written

    def encode(self, data: bytes) -> list[int]:
        """The tokens of one pre-token."""
        if data in self.ranks:
            return [self.ranks[data]]
        out: list[int] = []
        state, last, apart = self.start, -1, self.apart
        for byte in data:
            step = state.step.get(byte) or self._open(state, byte)
            first = step[0]
            held = False
            if first is not None:
                held = apart.get(last << 20 | first)
                if held is None:
                    held = self.stay_apart(last, first)
            state, written = step[1 if held else 2] or self._follow(state, byte, step, held)
            if written:
                out.extend(written)
                last = written[-1]
        out.extend(state.live[-1][1])
        return out


class Utf8Stream:
    """Text of bytes that come in chunks, which may end inside a character.

    The state is the beginning of a character that further bytes can complete. Bytes that
    no valid text holds become replacement characters.
    """

    # The lead bytes whose second byte has a narrower range than 80 to BF.
    SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}

    def __init__(self) -> None:
        self.held = b""

    @classmethod
    def _lacks(cls, data: bytes) -> bool:
        """Whether ``data`` is the beginning of one character and lacks its end."""
        lead = data[0]
        size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
        low, high = cls.SECOND.get(lead, (0x80, 0xBF))
        return len(data) < size and all(
            (low <= b <= high) if i == 0 else 0x80 <= b <= 0xBF for i, b in enumerate(data[1:])
        )

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        cut = next((len(data) - n for n in (1, 2, 3) if n <= len(data) and self._lacks(data[-n:])), len(data))
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


def decoded(ids: Iterable[int], bytes_of: dict[int, bytes], chunk: int = 4096) -> Iterator[str]:
    """The text of ids, a part for each ``chunk`` of them."""
    ids, stream = list(ids), Utf8Stream()
    for first in range(0, len(ids), chunk):
        yield stream.feed(b"".join(map(bytes_of.__getitem__, ids[first : first + chunk])))
    yield stream.close()


@cache
def unknown_to_tiktoken(pattern: str) -> bytes:
    """Characters that the library joins to no word. A small vocabulary, in which only a
    word's first character merges with the next byte, shows what it takes for one word."""

    def continues(before: str, chars: str) -> np.ndarray:
        single = {bytes([b]): b for b in range(256)}
        pairs = {before.encode() + bytes([b]): 256 + b for b in range(256)}
        small = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single | pairs, special_tokens={})
        ids = np.array(small.encode_ordinary("\n".join(before + c for c in chars)))
        return ids[np.append(0, np.flatnonzero(ids == 10) + 1)] >= 256

    return unknown_chars(continues)


@cache
def encoder(path: str, unknown: bytes) -> tuple[Remembered, Transducer]:
    machine = Transducer(read_ranks(path))

    def encode(words: list[str]) -> list[bytes]:
        return [np.array(machine.encode(w.encode()), "<u4").tobytes() for w in words]

    return Remembered(encode, classes=classes_without(unknown)), machine


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", with_text: bool = False
) -> DataFrame:
    """``(key, ids)``: the ids of each row's whole text as little-endian unsigned 32-bit
    integers in one binary value. ``with_text`` adds the ``text`` that they decode to, in
    the same pass.

    ``ranks`` is a vocabulary of byte strings with ranks; ``pattern`` splits texts and must
    be the one that :mod:`firmlens.llm.pretokens` reproduces. A null text counts as an empty
    one, which has no ids. Null and repeated keys stay; other columns are not read. Long
    words take memory for the bytes not yet written only.
    """
    if regex.sub(r"\s", "", pattern) != regex.sub(r"\s", "", PATTERN):
        raise ValueError("only the byte-level pattern is supported")
    unknown = unknown_to_tiktoken(pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered, machine = encoder(ranks, unknown)
        gc.disable()  # nothing here waits for the collector, which would go through all states again and again
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):  # a task holds the texts and ids of a slice
                part = batch.slice(first, SLICE)
                ids = [b"".join(own) for group in grouped(part.column(1).to_pylist()) for own in looked_up(group, remembered)]
                columns, names = [part.column(0), pa.array(ids, pa.binary())], [key, "ids"]
                if with_text:
                    columns.append(pa.array(["".join(decoded(np.frombuffer(i, "<u4").tolist(), machine.bytes_of)) for i in ids], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names)
        gc.enable()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        encode, f"`{key}` {kind}, ids binary" + (", text string" if with_text else "")
    )


def decode_texts(encoded: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the ``text`` of its ids (null for null)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = encoder_bytes(ranks)
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                values = part.column(part.schema.get_field_index(ids)).to_pylist()
                texts = [None if v is None else "".join(decoded(np.frombuffer(v, "<u4").tolist(), bytes_of)) for v in values]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "text"])

    plain = encoded.drop("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(decode, f"{schema}, text string")


@cache
def encoder_bytes(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}


# Fixed value: the byte-level pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
