"""Repair of conversations against a search of all edits."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import oracle
import pytest

from firmlens.llm import queries, repair

SF = "/root/testdata/sf0.001"
TALK = "conv_id long, turn long, role string, text string"


def search(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """Cheapest edits of (initial, fault) rows by best-first search over whole audits."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", out):
            return cost, audit, list(out)
        if len(audit) > 2 * len(rows) + 4 or not re.fullmatch("s?(ua)*u?", out):
            continue
        steps = [(2, "I", i, c) for c in "ua"]
        if i < len(rows):
            initial, fault = rows[i]
            steps.append((3, "D", i + 1, ""))
            if fault in ("", "truncated"):
                more = fault == "truncated"
                steps += [(more, "K", i + 1, initial)] + [(2 + more, "R", i + 1, c) for c in "ua"]
        for c, edit, j, letter in steps:
            heapq.heappush(heap, (cost + c, audit + edit, j, out + letter))
    raise AssertionError("no repair")


FAULTS = {"": repair.GOOD, "truncated": repair.TRUNCATED, "blank": repair.BLANK, "duplicate": repair.DUPLICATE}


def symbols(rows: list[tuple[str, str]]) -> bytes:
    return bytes(repair.symbol("sua".find(initial) % 4, FAULTS[fault]) for initial, fault in rows)


def test_plans_are_cheapest_and_first_in_the_alphabet():
    rng = random.Random(4)
    kinds = list(itertools.product("suax", FAULTS))
    cases = [[], *([k] for k in kinds), *([a, b] for a in kinds for b in kinds)]
    cases += [[rng.choice(kinds) for _ in range(rng.randint(3, 6))] for _ in range(150)]
    cases += [[kind] * n for kind in kinds for n in (3, 4, 5)]
    for rows in cases:
        cost, audit, _ = search(rows)
        found = repair.plan(symbols(rows))
        assert (found.cost, "".join(found.rows) + found.last) == (cost, audit), rows


def test_powers_of_runs_are_steps_one_by_one():
    for code in (repair.symbol(r, f) for r in range(4) for f in range(4)):
        value = repair.at_end()
        for n in range(1, 40):
            value = repair.before_row(code, value)
            assert repair.over_run(code, n, repair.at_end()) == value
    many = repair.over_run(repair.symbol(1, 0), 10**12, repair.at_end())
    assert many[repair.NOTHING] == 10**12  # half of them get the other role


def plain(rows: list) -> dict:
    """Brute force over rows (conv_id, turn, role, text)."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in talks.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in own:
            shown = text.rstrip(" \t\n\v\f\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [role[:1] if role[:1] in tuple("sua") else "x" for _, role, _ in own]
        cost, audit, letters = search(list(zip(initials, faults, strict=True)))
        lines, i, letters = [], 0, iter(letters)
        for edit in audit:
            letter = None if edit == "D" else next(letters)
            role = own[i][1] if edit == "K" else {"u": "user", "a": "assistant", None: ""}[letter]
            if edit != "D":
                lines.append(f"{role}:{'' if edit == 'I' else own[i][2]}")
            i += edit != "I"
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(spark, rows, tmp_path) -> dict:
    table = spark.createDataFrame(rows, TALK).selectExpr("*", "0 as k", "0 as place", "0 as symbol", "'' as audit", "0 as at", "0 as range").repartition(3)
    table.write.mode("overwrite").parquet(str(tmp_path / "talks"))
    result = repair.repair(spark.read.parquet(str(tmp_path / "talks")))
    sums = {r.conv_id: r.sha256 for r in repair.digests(result.turns).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sums.get(r.conv_id, nothing))
        for r in result.report.collect()
    }


def odd_talks() -> list[tuple]:
    rng = random.Random(9)
    roles, texts = ["system", "user", "assistant", None, "tool", "", "user"], ["Yes.", "No", "", None, " \n", "Why?", "straße!", "x" * 3_000 + ".", "Yes. "]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(roles), rng.choice(texts)) for c in range(40) for _ in range(rng.randint(1, 7))]
    return rows + rows[:9] + [(None, 1, "user", "Hi."), (None, None, None, None), (100, None, "assistant", "A."), (101, -5, "user", "A"), (101, 7, "user", "B")]


@pytest.mark.parametrize("bits", [10, 1])
def test_repair_of_odd_conversations(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(repair, "PIECE_BITS", bits)
    rows = odd_talks()
    assert found(spark, rows, tmp_path) == plain(rows)


def test_a_long_conversation_is_dealt_to_pieces(spark, tmp_path):
    rng = random.Random(1)
    rows = [(1, i, rng.choice(["user", "user", "assistant"]), rng.choice(["Same.", f"Own {i}."])) for i in range(9_000)] + [(2, 0, "user", "Q?"), (2, 1, "assistant", "A.")]
    got = found(spark, rows, tmp_path)
    assert got[2][:7] == (0, 0, 0, 0, 0, 0, "KK")
    faults = [r[2:] in {x[2:] for x in rows[max(0, i - 60) : i]} for i, r in enumerate(rows[:9_000])]
    assert got[1][2] == sum(1 for i, r in enumerate(rows[:9_000]) if r[3] == "Same." and any(x[2:] == r[2:] for x in rows[:i][-9_000:])) and sum(faults) <= got[1][2]
    seen, lines, out = set(), [], ""
    coded = []
    for _, _, role, text in rows[:9_000]:
        coded.append((role[0], "duplicate" if (role, text) in seen else ""))
        seen.add((role, text))
    plan = repair.plan(symbols(coded))
    assert got[1][5:7] == (plan.cost, "".join(plan.rows) + plan.last)
    for (_, _, role, text), edits in zip(rows[:9_000], plan.rows, strict=True):
        for edit in edits:
            given = {"K": role[0]}.get(edit, "u" if out[-1:] != "u" else "a")
            if edit != "D":
                out += given
                lines.append(f"{ {'u': 'user', 'a': 'assistant'}[given] }:{'' if edit == 'I' else text}")
    lines += ["assistant:"] * len(plan.last)
    assert got[1][7] == hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_nothing(spark, tmp_path):
    assert found(spark, [], tmp_path) == {}


def test_damage_is_as_in_sql(spark):
    got = oracle.spark_rows(queries.QUERIES["op13_conversation_repair"](spark, SF))
    assert oracle.difference(got, oracle.duck_rows(oracle.connect(SF), queries.ORACLES["op13_conversation_repair"])) == ""
    assert len(got[1]) == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()


def test_query_with_odd_rows(spark, tmp_path):
    """Nulls, and conversations of which the damage leaves nothing."""
    rows = odd_talks()
    spark.createDataFrame(rows, TALK).write.parquet(str(tmp_path / "conversations.parquet"))
    got = oracle.spark_rows(queries.QUERIES["op13_conversation_repair"](spark, str(tmp_path)))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert oracle.difference(got, oracle.duck_rows(con, queries.ORACLES["op13_conversation_repair"])) == ""
    assert np.all([len(r) == 9 for r in got[1]])
