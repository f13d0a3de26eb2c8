"""Pre-tokens of byte-level tokenizers, found with array operations instead of a regular expression.

The pattern that the arrays reproduce, alternatives tried in this order at each place:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache
from typing import Any

import numpy as np
import pyarrow as pa
import regex

Continues = Callable[[str, str], np.ndarray]

OTHER, LETTER, NUMBER, SPACE, MARK = range(5)
#: Stands between texts in an array of code points.
BETWEEN = 0x110000
# The code points of the Unicode property White_Space.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Pre-tokens whose results a task remembers, in each of two generations.
REMEMBERED = 1 << 18
#: Characters of text whose pre-tokens are looked up together.
GROUP_CHARS = 1 << 20


@cache
def char_classes() -> np.ndarray:
    """Class of every code point, and last that of the mark between texts."""
    table = np.zeros(BETWEEN + 1, np.uint8)
    every = np.concatenate([np.arange(0xD800), np.arange(0xE000, BETWEEN)]).astype("<u4")
    text = every.tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.finditer(pattern, text):
            table[every[run.start() : run.end()]] = kind
    table[WHITE] = SPACE
    table[BETWEEN] = MARK
    return table


def unknown_chars(continues: Continues) -> bytes:
    """Letters and numbers that a library of an older Unicode version takes for others, as
    32-bit code points. ``continues(before, chars)`` says of each character whether it goes
    on with the pre-token that ``before`` begins."""
    found = []
    for kind, before in ((LETTER, "a"), (NUMBER, "1")):
        code = np.flatnonzero(char_classes() == kind).astype("<u4")
        found.append(code[~continues(before, code.tobytes().decode("utf-32-le"))])
    return np.concatenate(found).tobytes()


@cache
def classes_without(unknown: bytes) -> np.ndarray:
    table = char_classes().copy()
    table[np.frombuffer(unknown, "<u4")] = OTHER
    return table


def starts(code: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Places in an array of code points where a pre-token begins; marks are pre-tokens too."""
    kind = classes[code]
    begin = np.ones(len(code), bool)
    np.not_equal(kind[1:], kind[:-1], out=begin[1:])
    begin |= kind == MARK
    # The last white character before a word stands alone, or is part of the word if it is a blank.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != MARK))
    begin[last] = True
    begin[last[code[last] == 32] + 1] = False
    quotes = np.flatnonzero(code == 39)
    quotes = quotes[begin[quotes]]
    if len(quotes):
        padded = np.append(code, [0, 0])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quotes), bool)
        for pair in ("re", "ve", "ll"):
            long |= (one == ord(pair[0])) & (two == ord(pair[1]))
        begin[quotes[short | long] + 1] = False
        after = np.concatenate([quotes[short] + 2, quotes[long] + 3])
        begin[after[after < len(code)]] = True
    return np.flatnonzero(begin)


def _begins(texts: list[str], classes: np.ndarray | None) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts with a mark between them, its code points, the places where pre-tokens begin,
    which of these are no marks, and the places of the marks."""
    joined = "\0".join(texts)
    code = np.frombuffer(joined.encode("utf-32-le"), "<u4").copy()
    marks = np.cumsum([len(text) + 1 for text in texts])[:-1] - 1
    code[marks] = BETWEEN
    begin = starts(code, char_classes() if classes is None else classes)
    return joined, code, begin, code[begin] != BETWEEN, marks


def pretokens(texts: list[str], classes: np.ndarray | None = None) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of all texts in one list, and for each text the place of its first
    one, with the number of all at the end."""
    joined, code, begin, own, marks = _begins(texts, classes)
    end = np.append(begin[1:], len(code))
    begin, end = begin[own], end[own]
    first = np.concatenate([[0], np.searchsorted(begin, marks), [len(begin)]])
    return [joined[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], first


def different_pretokens(texts: list[str], classes: np.ndarray | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different pre-tokens of all texts, the index of every pre-token among them, and for
    each text the place of its first one, with the number of all at the end."""
    joined, code, begin, own, marks = _begins(texts, classes)
    data = joined.encode()
    at = np.append(begin, len(code))
    if len(data) > len(code):
        width = 1 + (code >= 0x80).astype(np.int32) + (code >= 0x800) + (code >= 0x10000)
        width[marks] = 1
        at = np.append(0, np.cumsum(width))[at]
    found = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))
    if len(marks):
        found, begin = found.filter(pa.array(own)), begin[own]
    first = np.concatenate([[0], np.searchsorted(begin, marks), [len(begin)]])
    coded = found.dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), first


class Remembered:
    """Results of a function of single pre-tokens.

    Two generations hold the recent ones, so that memory stays bounded and frequent
    pre-tokens are worked out once in a task.
    """

    def __init__(self, compute: Callable[[list[str]], Sequence[Any]], most: int = REMEMBERED, classes: np.ndarray | None = None):
        self.compute, self.most, self.classes = compute, most, classes
        self.new: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def __call__(self, words: list[str]) -> list[Any]:
        if len(self.new) > self.most:
            self.new, self.old = {}, self.new
        found = list(map(self.new.get, words))
        missing = {word for word, value in zip(words, found, strict=True) if value is None}
        if not missing:
            return found
        kept = {word: self.old[word] for word in missing if word in self.old}
        fresh = [word for word in missing if word not in kept]
        self.new.update(kept)
        self.new.update(zip(fresh, self.compute(fresh), strict=True))
        return [self.new[word] for word in words]


def grouped(texts: Iterable[str], most: int = GROUP_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``most`` characters; a longer text is a run of its own."""
    group: list[str] = []
    size = 0
    for text in texts:
        if group and size + len(text) > most:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def looked_up(texts: list[str], remembered: Remembered) -> Iterator[list[Any]]:
    """For each text the results of its pre-tokens."""
    words, place, first = different_pretokens(texts, remembered.classes)
    found = list(map(remembered(words).__getitem__, place.tolist()))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield found[a:b]


def looked_up_bytes(texts: list[str], remembered: Remembered) -> Iterator[bytes]:
    """For each text the results of its pre-tokens, which are bytes, after each other."""
    words, place, first = different_pretokens(texts, remembered.classes)
    found = pa.array(remembered(words), pa.large_binary()).take(pa.array(place))
    _, offsets, data = found.buffers()
    ends = np.frombuffer(offsets, np.int64)[found.offset : found.offset + len(found) + 1][first].tolist() if len(found) else [0] * len(first)
    for a, b in zip(ends, ends[1:], strict=False):
        yield data[a:b].to_pybytes() if b > a else b""


def looked_up_parts(
    texts: list[str], remembered: Remembered, special: str | None, look: Callable[[list[str], Remembered], Iterator[Any]] = looked_up
) -> Iterator[list[Any]]:
    """For each text what ``look`` gives for each of the parts that the ``special`` string separates."""
    if special is None or not any(special in text for text in texts):
        yield from ([own] for own in look(texts, remembered))
        return
    parts = [text.split(special) for text in texts]
    found = look([part for own in parts for part in own], remembered)
    for own in parts:
        yield [next(found) for _ in own]
