"""Secrets in texts: assignments, access keys, hexadecimal strings, and strings that a
tokenizer finds strange.

A vocabulary made from ordinary text has long tokens for what is ordinary. A run of key
characters that needs many tokens for its length is random, whether it has digits or not.
If a run as a whole is not, its parts between separators are judged by themselves: a
random string may stand behind a path or a name. Strings that are known to be something
else are left out: digests of the usual lengths, universally unique identifiers and plain
numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.transducer import PATTERN, read_ranks

# The kinds with their patterns and the shortest value that counts.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
SHORTEST_VALUE, SHORTEST_ACCESS = 8, 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
PART = re.compile(r"[A-Za-z0-9]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
HEX_ONLY = re.compile(r"[0-9a-fA-F]+")
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal digits.
DIGESTS = {32, 40, 56, 64, 96, 128}

#: Strings with fewer characters to a token are taken for random. The ratio of a short string
#: says less: so many times as few are asked for from each length on.
CHARS_PER_TOKEN = 2.0
STRICTNESS = {20: 1.0, 16: 0.8, 12: 0.75}
SHORTEST_RANDOM, SHORTEST_WHOLE = 12, 20
#: A run is judged as a whole if its parts have so many characters on average.
PART_CHARS = 8
#: Characters of a run that are encoded at once; a longer run is judged by the sum of its parts.
RUN_PART = 10_000

SPANS = "array<struct<kind string, start int, end int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@cache
def vocabulary(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("secrets", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})


def is_random(run: str, encoding: tiktoken.Encoding, chars_per_token: float) -> bool:
    if len(run) < SHORTEST_RANDOM or not any(c.isalpha() for c in run):
        return False
    if HEX_ONLY.fullmatch(run) and len(run) in DIGESTS or UUID.fullmatch(run):
        return False
    tokens = sum(len(encoding.encode_ordinary(run[i : i + RUN_PART])) for i in range(0, len(run), RUN_PART))
    strictness = next(v for n, v in STRICTNESS.items() if len(run) >= n)
    return len(run) < chars_per_token * strictness * tokens


def random_parts(run: str, encoding: tiktoken.Encoding, chars_per_token: float) -> list[tuple[int, int]]:
    """Places in a run that are random: the whole of it, or parts between separators."""
    identifiers = [m.span() for m in UUID.finditer(run)]
    parts = [m.span() for m in PART.finditer(run)]
    if not parts:
        return []
    even = sum(b - a for a, b in parts) >= PART_CHARS * len(parts)
    if len(run) >= SHORTEST_WHOLE and even and not identifiers and is_random(run, encoding, chars_per_token):
        return [(0, len(run))]
    free = [(a, b) for a, b in parts if not any(x < b and a < y for x, y in identifiers)]
    return [(a, b) for a, b in free if is_random(run[a:b], encoding, chars_per_token)]


def find(text: str, encoding: tiktoken.Encoding, chars_per_token: float) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by start and then kind."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= SHORTEST_VALUE]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST_ACCESS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = list(spans)
    for m in RUN.finditer(text):
        start, stop = m.span()
        if any(x <= start and stop <= y for _, x, y in base):
            continue
        for a, b in random_parts(m[0], encoding, chars_per_token):
            if not any(x <= start + a and start + b <= y for _, x, y in base):
                spans.append(("random", start + a, start + b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(
    docs: DataFrame, ranks: str, key: str = "doc_id", text: str = "text", chars_per_token: float = CHARS_PER_TOKEN
) -> DataFrame:
    """``(key, spans)``: one row for each row of ``docs``.

    Every match of the three patterns is a span; spans may overlap. A ``random`` span is a
    run, or a part of one, that lies in none of them and passes the test. A null or empty text has no spans;
    null and repeated keys stay; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(ranks)
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find(t, encoding, chars_per_token)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, SPAN_TYPE)], [key, "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(work, f"`{key}` {kind}, spans {SPANS}")


def redact(
    docs: DataFrame, ranks: str, mark: str = "[SECRET]", text: str = "text", chars_per_token: float = CHARS_PER_TOKEN
) -> DataFrame:
    """``docs`` with every stretch of its texts that spans cover replaced by ``mark``.

    All columns and rows stay; a null text stays null. Overlapping spans are one stretch.
    """
    at = docs.columns.index(text)

    def blank(value: str, encoding: tiktoken.Encoding) -> str:
        out, done = [], 0
        for _, a, b in find(value, encoding, chars_per_token):
            if a >= done:
                out += [value[done:a], mark]
            done = max(done, b)
        return "".join([*out, value[done:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(ranks)
        for batch in batches:
            texts = [None if t is None else blank(t, encoding) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(work, docs.schema)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
