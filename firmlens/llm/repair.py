"""Repair of conversations by the cheapest edits that make user and assistant alternate.

The rows of a conversation become symbols of a role and a fault. Equal symbols in a row
are a run. A row takes the state of what was written so far (nothing, system, user,
assistant) to the next; its costs are a matrix of the min-plus semiring, and a run's are a
power of it, made of cached squares. Costs to the end are carried backward over runs.
Then the edits of each row are read off forward, the first in the alphabet of equally cheap
ones, in pieces that Spark joins to the texts again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.functions.positions import PLACE, RANGE, sorted_ranges
from firmlens.llm.storage import stored

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
WHITE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Initials of roles as they may follow each other, and those of other roles.
ROLES, OTHER = "sua", "x"
LEGAL = ("su", "ua", "au")
#: Faults of a row, in the order in which they count.
GOOD, TRUNCATED, BLANK, DUPLICATE = range(4)
#: A symbol is one letter: four for each initial in ``sua`` and for others, by fault.
FIRST_SYMBOL = ord("A")
#: What was written so far: nothing, a system turn, a user's, an assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the turn that may be put in or given another role.
NEXT = (USER, USER, ASSISTANT, USER)
WRITTEN = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60
#: Rows of a conversation in a piece, of which a task holds the symbols or the lines.
PIECE_BITS = 10


def symbol(role: int, fault: int) -> int:
    return FIRST_SYMBOL + 4 * role + fault


def kept_as(role: int, state: int) -> int | None:
    """The state after a row that keeps its role, None where it can't stand."""
    if role == 0:
        return SYSTEM if state == NOTHING else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


@lru_cache(maxsize=None)
def row_edits(code: int) -> tuple[tuple[str, int, int, int], ...]:
    """``(edit, cost, from, to)`` of a row with this symbol, edits in alphabetical order."""
    role, fault = divmod(code - FIRST_SYMBOL, 4)
    edits = [("D", DELETE_COST, s, s) for s in range(4)]
    if fault in (GOOD, TRUNCATED):
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        edits += [("K", KEEP_COST + more, s, to) for s in range(4) if (to := kept_as(role, s)) is not None]
        edits += [("R", REROLE_COST + more, s, NEXT[s]) for s in range(4)]
    return tuple(edits)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the min-plus semiring; ``b`` is a matrix or a vector."""
    return np.minimum((a[:, :, None] + b[None]).min(1) if b.ndim == 2 else (a + b[None]).min(1), FAR)


@lru_cache(maxsize=None)
def put_in() -> np.ndarray:
    """Costs of turns put in between two rows."""
    once = np.full((4, 4), FAR)
    np.fill_diagonal(once, 0)
    for state in range(4):
        once[state, NEXT[state]] = INSERT_COST
    return product(once, product(once, once))


@lru_cache(maxsize=None)
def power(code: int, bit: int) -> np.ndarray:
    """Costs from state to state of 2 ** ``bit`` rows with this symbol."""
    if bit:
        half = power(code, bit - 1)
        return product(half, half)
    row = np.full((4, 4), FAR)
    for _, cost, before, after in row_edits(code):
        row[before, after] = min(row[before, after], cost)
    return product(put_in(), row)


@lru_cache(maxsize=None)
def at_end() -> tuple[int, ...]:
    """Costs to the end from each state behind the last row."""
    return tuple(product(put_in(), np.array([0, FAR, FAR, 0])).tolist())


def over_run(code: int, count: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to the end before ``count`` rows with this symbol, from those behind them."""
    value, bit = np.array(rest), 0
    while count >> bit:
        if count >> bit & 1:
            value = product(power(code, bit), value)
        bit += 1
    return tuple(value.tolist())


@lru_cache(maxsize=1 << 16)
def _row_costs(code: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(product(power(code, 0), np.array(rest)).tolist())


def before_row(code: int, rest: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before one row. They depend on differences, of which there are few."""
    least = min(rest)
    return tuple(v + least for v in _row_costs(code, tuple(v - least for v in rest)))


@lru_cache(maxsize=1 << 16)
def _choice(code: int, state: int, rest: tuple[int, ...]) -> tuple[str, int]:
    costs, edits = _row_costs(code, rest), ""
    while True:
        fits = {e: to for e, cost, s, to in row_edits(code) if s == state and cost + rest[to] == costs[state]}
        # In the alphabet a turn put in comes after a deletion and before all others.
        if "D" in fits or INSERT_COST + costs[NEXT[state]] > costs[state]:
            edit = min(fits)
            return edits + edit, fits[edit]
        edits, state = edits + "I", NEXT[state]


def row_choice(code: int, state: int, rest: tuple[int, ...]) -> tuple[str, int]:
    """The edits up to and with a row, and the state behind it: the first in the alphabet of
    those that cost least with what follows."""
    least = min(rest)
    return _choice(code, state, tuple(v - least for v in rest))


class Plan(NamedTuple):
    """Cost of a conversation, the edits before and at each row, and those behind the last."""

    cost: int
    rows: list[str]
    last: str


def runs_of(symbols: bytes) -> list[tuple[int, int]]:
    codes = np.frombuffer(symbols, np.uint8)
    if not len(codes):
        return []
    begin = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return list(zip(codes[begin].tolist(), np.diff(np.append(begin, len(codes))).tolist(), strict=True))


def plan(symbols: bytes) -> Plan:
    """The cheapest edits of a conversation with these symbols."""
    runs = runs_of(symbols)
    behind = [at_end()]
    for code, count in reversed(runs):
        behind.append(over_run(code, count, behind[-1]))
    behind.reverse()
    state, rows = NOTHING, []
    for (code, count), rest in zip(runs, behind[1:], strict=True):
        inside = [rest]
        for _ in range(count - 1):
            inside.append(before_row(code, inside[-1]))
        for after in reversed(inside):
            edits, state = row_choice(code, state, after)
            rows.append(edits)
    last = ""
    while state not in (NOTHING, ASSISTANT):
        last, state = last + "I", NEXT[state]
    return Plan(int(behind[0][NOTHING]), rows, last)


def damaged(talks: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``talks`` with faults that depend on the CRC of key and turn only: of 20 rows one is
    dropped, one emptied, one loses its ends of sentences, one stands twice, one becomes the
    user's. A null is one space. For tests of :func:`repair`."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (key, turn)]
    rows = talks.select(
        key, turn, F.coalesce(F.col(role), F.lit(" ")).alias(role), F.coalesce(F.col(text), F.lit(" ")).alias(text),
        (F.crc32(F.concat(words[0], F.lit(":"), words[1])) % 20).alias("__fault"),
    ).filter("__fault != 0")
    times = F.array_repeat(F.lit(0), F.when(F.col("__fault") == 3, 2).otherwise(1))
    return rows.select(
        key, turn, F.when(F.col("__fault") == 4, "user").otherwise(F.col(role)).alias(role),
        F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate(text, ENDS, "")).otherwise(F.col(text)).alias(text),
        F.explode(times).alias("__time"),
    ).drop("__time")


class Repaired(NamedTuple):
    #: ``(key, blank, duplicate, truncated, illegal, gaps, cost, audit)``, a row for each key.
    report: DataFrame
    #: ``(key, at, role, text)``: the turns that stay or are put in, by their place in the audit.
    turns: DataFrame


def _symbols(placed: DataFrame) -> DataFrame:
    """``(k, range, place, symbol)`` of the rows, without their texts."""
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    kind = F.coalesce(*[F.when(initial == c, i) for i, c in enumerate(ROLES)], F.lit(len(ROLES)))
    rows = placed.select(
        "k", F.col(RANGE).alias("range"), F.col(PLACE).alias("place"), "role", kind.alias("kind"),
        F.xxhash64("text").alias("hash1"), F.xxhash64(F.lit("text"), "text").alias("hash2"),
        F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(GOOD).alias("fault"),
    )
    same = ["k", "role", "hash1", "hash2"]
    first = F.min(F.struct("range", "place")).alias("first")
    # Written, so that the join deals both sides anew and a text that fills a conversation is split.
    again = stored(rows.groupBy(*same).agg(first, F.count("*").alias("n")).filter("n > 1").drop("n"), "again")
    met = rows.join(again, [rows[c].eqNullSafe(again[c]) for c in same], "left")
    later = again["first"].isNotNull() & (F.struct(rows["range"], rows["place"]) > again["first"])
    fault = F.when(rows["fault"] == BLANK, BLANK).when(later, DUPLICATE).otherwise(rows["fault"])
    code = F.char(FIRST_SYMBOL + 4 * rows["kind"] + fault)
    return met.select(rows["k"], rows["range"], rows["place"], code.alias("symbol"))


PLANNED = (
    "first boolean, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "range int, steps array<struct<place: long, at: long, role: string>>"
)
STEP = pa.struct([("place", pa.int64()), ("at", pa.int64()), ("role", pa.string())])
COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _planned(symbols: DataFrame, kind: str) -> DataFrame:
    """For each piece of a conversation its steps; with the first piece the conversation's counts.

    Pieces of ``PIECE`` rows are gathered first, then a conversation's pieces: one byte for
    each row, as many as the audit has, which is one value of the result.
    """
    piece = F.shiftright("place", PIECE_BITS).alias("piece")
    sorted_rows = F.array_sort(F.collect_list(F.struct("place", "symbol")))
    pieces = symbols.groupBy("k", "range", piece).agg(sorted_rows.alias("rows")).select(
        "k", "range", F.col("rows")[0]["place"].alias("place"), F.array_join(F.transform("rows", lambda r: r.symbol), "").alias("symbols")
    )
    talks = pieces.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("range", "place", "symbols"))).alias("pieces"))

    def steps(own: list[dict], found: Plan) -> Iterator[tuple[int, list[dict]]]:
        at, row, written = 0, 0, 0  # turns of user and assistant so far
        for i, part in enumerate(own):
            out = []
            for offset, code in enumerate(part["symbols"].encode()):
                for edit in found.rows[row]:
                    place = None if edit == "I" else part["place"] + offset
                    system = edit == "K" and (code - FIRST_SYMBOL) // 4 == 0
                    if edit != "D":
                        out.append({"place": place, "at": at, "role": None if edit == "K" else WRITTEN[USER + written % 2]})
                        written += not system
                    at += 1
                row += 1
            if i == len(own) - 1:
                for _ in found.last:
                    out.append({"place": None, "at": at, "role": WRITTEN[USER + written % 2]})
                    written += 1
                    at += 1
            yield part["range"], out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in PLANNED.split(", ")[:8]] + ["steps"]
        types = [pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.int32(), pa.list_(STEP)]
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column(1)[i].as_py()
                symbols = "".join(p["symbols"] for p in own).encode()
                found = plan(symbols)
                codes = np.frombuffer(symbols, np.uint8) - FIRST_SYMBOL
                fault = np.bincount(codes % 4, minlength=4)
                initials = np.frombuffer((ROLES + OTHER).encode(), np.uint8)[codes // 4]
                pairs = initials[:-1].astype(int) * 256 + initials[1:]
                illegal = int((~np.isin(pairs, [256 * ord(a) + ord(b) for a, b in LEGAL])).sum())
                counts = [int(fault[f]) for f in (BLANK, DUPLICATE, TRUNCATED)] + [illegal, found.cost]
                for part, (place, out) in enumerate(steps(own, found)):
                    head = [True, *counts, "".join(found.rows) + found.last] if part == 0 else [False, *[None] * 6]
                    values = [*head, place, out]
                    key = batch.column(0).slice(i, 1)
                    yield pa.RecordBatch.from_arrays([key, *[pa.array([v], t) for v, t in zip(values, types, strict=True)]], ["k", *names])

    return talks.mapInArrow(work, f"k {kind}, {PLANNED}")


def repair(talks: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The cheapest edits after which a conversation's role initials are ``(s?(ua)+)?``.

    Rows stand by turn, nulls first, then by role and text. Of a row's faults the first
    counts: blank (no character but white ones), duplicate (role and text stood before in the
    conversation), truncated (the last character that isn't white ends no sentence). A row can
    be kept (cost 0), get the role of user or assistant (2), or be deleted (3; blank and
    duplicate ones must be); a row that stays truncated costs 1 more; an empty turn can be put
    in anywhere (2). The audit has the edits' initials D, I, K, R in order; of equally cheap
    audits it is the least one. ``illegal`` counts neighbours whose initials aren't su, ua or
    au; ``gaps`` the turns between the least and the greatest that are absent.

    A null role or text is one space. Rows with a null key are one conversation; a null turn
    is no turn of the count of gaps. Without rows there is no conversation. Other columns are
    not read. ``talks`` should come from files, see ``sorted_ranges``.

    A conversation of any length is dealt to sorted ranges and handled in pieces. Only its
    symbols meet in one task, a byte for each row, as its audit is one value.
    """
    rows = talks.select(
        F.col(key).alias("k"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    order = [F.asc_nulls_first("k"), F.asc_nulls_first("turn"), "role", "text"]
    placed = sorted_ranges(rows, *order).rows
    planned = stored(_planned(_symbols(placed), talks.schema[key].dataType.simpleString()), "planned")
    turns = placed.select("k", "turn").distinct().groupBy("k").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    # One shuffle for both: rows of a key are put together by an aggregate.
    both = planned.filter(F.col("first")).select("k", *COUNTS, "audit").unionByName(turns, allowMissingColumns=True)
    report = both.groupBy("k").agg(*[F.max(c).alias(c) for c in [*COUNTS, "audit"]], F.coalesce(F.max("gaps"), F.lit(0)).alias("gaps"))
    steps = planned.select("k", "range", F.explode("steps").alias("step")).select("k", "range", "step.*")
    there = steps.filter("place is not null").withColumnsRenamed({"k": "own", "role": "given"})
    stay = placed.join(there, (placed[RANGE] == there["range"]) & (placed[PLACE] == there["place"])).select(
        "k", "at", F.coalesce("given", "role").alias("role"), "text"
    )
    new = steps.filter("place is null").select("k", "at", "role", F.lit("").alias("text"))
    return Repaired(report.withColumnRenamed("k", key), stay.unionByName(new).withColumnRenamed("k", key))


def digests(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, sha256)`` of the lines ``role:text`` of each conversation's turns, joined by
    newlines. Lines are joined in pieces first. A digest is a fold over all bytes in order:
    a conversation's pieces pass one task, which holds one batch of them."""
    piece = F.shiftright("at", PIECE_BITS).alias("piece")
    line = F.concat("role", F.lit(":"), "text")
    lines = F.array_sort(F.collect_list(F.struct("at", line.alias("line"))))
    pieces = turns.groupBy(F.col(key).alias("k"), piece).agg(F.array_join(F.transform(lines, lambda r: r.line), "\n").alias("lines"))
    kind = turns.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None
        for batch in batches:
            keys, sums = [], []
            for i in range(batch.num_rows):
                k = batch.column(0)[i]
                if own is None or k != own:
                    if own is not None:
                        keys.append(own)
                        sums.append(digest.hexdigest())
                    own, digest = k, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(batch.column(1)[i].as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(sums, pa.string())], ["k", "sha256"])
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], own.type), pa.array([digest.hexdigest()])], ["k", "sha256"])

    dealt = pieces.repartition("k").sortWithinPartitions("k", "piece").select("k", "lines")
    return dealt.mapInArrow(work, f"k {kind}, sha256 string").withColumnRenamed("k", key)
