"""Token counts by merging whole batches of pre-tokens at once.

A batch of different pre-tokens is one ragged array of symbols. In each step every
sequence applies its own lowest-ranked pair, at all places at once; a sequence without a
known pair leaves the batch, and its symbols are counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from firmlens.llm.pretokens import Remembered, classes_without, grouped, looked_up_parts, unknown_chars

NEVER = np.iinfo(np.int32).max
#: Symbols merged in one array.
BATCH_SYMBOLS = 1 << 19


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """Pairs with their ranks, in arrays. Every pair must make a symbol of its own, as
    trained vocabularies have it; then equal pairs of a sequence can be merged together."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        if len(set(made.tolist())) != len(made):
            raise ValueError("two pairs of the vocabulary make the same symbol")
        self.width = max(vocab.values()) + 1
        key = left * self.width + right
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made[order]
        self.of_byte = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.special = next((t["content"] for t in spec.get("added_tokens", [])), None)

    def ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (``NEVER`` if unknown) and its place in the table."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NEVER), at

    def surviving(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols left of each (non-empty) word."""
        counts = np.zeros(len(words), np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = 0
        while first < len(words):
            last = first + max(1, int(np.searchsorted(np.cumsum(size[first:]), BATCH_SYMBOLS)))
            counts[first:last] = self._merged(b"".join(words[first:last]), size[first:last])
            first = last
        return counts

    def _merged(self, data: bytes, size: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(size), np.int64)
        symbol = self.of_byte[np.frombuffer(data, np.uint8)]
        word = np.repeat(np.arange(len(size)), size)
        # rank[i] belongs to the pair (i, i + 1); the last symbol of a word has none.
        rank = np.full(len(symbol), NEVER, np.int32)
        made = np.zeros(len(symbol), np.int64)

        def rate(at: np.ndarray) -> None:
            rank[at] = NEVER
            at = at[at + 1 < len(symbol)]
            at = at[word[at] == word[at + 1]]
            rank[at], made[at] = self.ranked(symbol[at], symbol[at + 1])

        rate(np.arange(len(symbol)))
        while len(symbol):
            begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            length = np.diff(np.append(begin, len(symbol)))
            lowest = np.minimum.reduceat(rank, begin)
            over = lowest == NEVER
            if over.any():
                counts[word[begin[over]]] = length[over]
                stay = np.repeat(~over, length)
                symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
                if not len(symbol):
                    break
                lowest, length = lowest[~over], length[~over]
            chosen = rank == np.repeat(lowest, length)
            # In a run of one symbol the pairs overlap: every second one counts from the left.
            place = np.arange(len(symbol))
            run = place - np.maximum.accumulate(np.where(chosen, -1, place))
            chosen &= run % 2 == 1
            at = np.flatnonzero(chosen)
            symbol[at] = self.made[made[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
            at -= np.arange(len(at))
            rate(np.concatenate([at, at[at > 0] - 1]))
        return counts


@cache
def merges(path: str) -> Merges:
    return Merges(path)


@cache
def unknown_to(path: str) -> bytes:
    """Characters that the vocabulary's library, whose Unicode version is its own, joins to no word."""
    splitter = Tokenizer.from_file(path).pre_tokenizer

    def continues(before: str, chars: str) -> np.ndarray:
        words = splitter.pre_tokenize_str("\n".join(before + c for c in chars))
        ends = np.array([end for _, (_, end) in words])
        return np.isin(np.arange(len(chars)) * 3 + 1, ends, invert=True)

    return unknown_chars(continues)


@cache
def counter(path: str, unknown: bytes) -> Remembered:
    table = merges(path)
    return Remembered(
        lambda words: table.surviving([w.encode() for w in words]).tolist(), classes=classes_without(unknown)
    )


def token_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens)``: one row for each row of ``docs``.

    ``tokenizer`` is a byte-level BPE file in JSON form. Its special string inside a text
    is one token. A null text counts as an empty one (no bytes, no tokens); null and
    repeated keys stay as they are; other columns are not read. Memory is bounded by one
    Arrow batch, and a very long word is merged in the same way as a short one.
    """

    unknown = unknown_to(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered, special = counter(tokenizer, unknown), merges(tokenizer).special
        for batch in batches:
            n_tokens: list[int] = []
            for group in grouped(batch.column(1).to_pylist()):
                for parts in looked_up_parts(group, remembered, special):
                    n_tokens.append(sum(map(sum, parts)) + len(parts) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64())], [key, "n_bytes", "n_tokens"]
            )

    whole = F.coalesce(F.col(text), F.lit(""))
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, whole.alias("text"), F.octet_length(whole).cast("long").alias("n_bytes")).mapInArrow(
        count, f"`{key}` {kind}, n_bytes long, n_tokens long"
    )
