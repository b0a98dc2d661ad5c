"""Conversation repair against a plain dynamic program over costs and audits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from postern.llm import turns
from postern.llm.queries import QUERIES
from postern.llm.common import table as read

SCHEMA = "conv_id long, turn long, role string, text string, _row string, chunk int"
LEGAL = re.compile(r"(s?(ua)+)?")


def least(rows: list[tuple[str, int]], i: int, state: str, memo: dict) -> tuple[int, str]:
    """Least (cost, audit) from a state ("", "s", "u" or "a" went last) for (initial, fault) rows."""
    if (i, state) in memo:
        return memo[i, state]
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    # Two inserts at most stand at one place: a third could be left out with the one before it.
    def ways(state, inserts):
        if i == len(rows):
            if state in ("", "a"):
                yield 0, ""
        else:
            initial, fault = rows[i]
            cost, audit = least(rows, i + 1, state, memo)
            yield cost + 4, "D" + audit
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if initial in after[state]:
                    cost, audit = least(rows, i + 1, initial, memo)
                    yield cost + more, "K" + audit
                for other in after[state].replace("s", ""):
                    cost, audit = least(rows, i + 1, other, memo)
                    yield cost + 3 + more, "R" + audit
        if inserts < 3:
            for other in after[state].replace("s", ""):
                for cost, audit in ways(other, inserts + 1):
                    yield cost + 3, "I" + audit

    memo[i, state] = min(ways(state, 0))
    return memo[i, state]


def plain_repair(table: list[tuple], damaged: bool = True) -> list[tuple]:
    out = []
    key = lambda t: (t is not None, t or 0)
    for conv_id in {r[0] for r in table}:
        rows = []
        for _, turn, role, text, *_ in (r for r in table if r[0] == conv_id):
            role, text = " " if role is None else role, " " if text is None else text
            shown = [" " if x is None else str(x) for x in (conv_id, turn)]
            fault = zlib.crc32(":".join(shown).encode()) % 20 if damaged else 9
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            rows += [(turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        rows.sort(key=lambda r: (key(r[0]), r[1], r[2]))
        seen, marked = set(), []
        for _, role, text in rows:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role[:1] or "x", fault))
        memo: dict = {}
        for i in range(len(marked), 0, -1):  # from the back, so that the recursion stays flat
            for state in ("", "s", "u", "a"):
                least(marked, i, state, memo)
        cost, audit = least(marked, 0, "", memo) if rows else (0, "")
        repaired, state, i = [], "", 0
        for edit in audit:
            role, text = rows[i][1:] if i < len(rows) else (None, None)
            i += edit != "I"
            if edit == "D":
                continue
            state = role[0] if edit == "K" else "a" if state == "u" else "u"
            role = role if edit == "K" else {"u": "user", "a": "assistant"}[state]
            repaired.append(f"{role}:{'' if edit == 'I' else text}")
        assert LEGAL.fullmatch("".join(r[0] for r in repaired)) and i == len(rows)
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = [sum(f == kind for _, f in marked) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        sha = hashlib.sha256("\n".join(repaired).encode()).hexdigest()
        out.append((conv_id, gaps, *faults, illegal, cost, audit, sha))
    return sorted(out, key=repr)


def found(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def awkward(conversations: int = 60, most: int = 14) -> list[tuple]:
    rng = random.Random(7)
    texts = ["Fine.", "Well!", "Why?", "cut off", "", " \t\n", "end. \x0b", "Same.", None, "a ", "x. ", "long " * 4000 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "sudo"]
    rows = []
    for conv_id in [None, *range(conversations)]:
        for turn in range(rng.randrange(1, most)):
            known = rng.random() < 0.9
            rows.append((conv_id, turn + rng.choice([0, 0, 0, 2]) if known else None, rng.choice(roles), rng.choice(texts), "x", 1))
    rows += [(500, None, None, None, None, None)] * 5 + rows[:4] * 3
    rows += [(c, t, "user", "Gone.", "y", 2) for c in range(600, 640) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    rng.shuffle(rows)
    return rows


def test_tables_hold_the_cheapest_edits():
    own = turns.Tables()
    rng = random.Random(2)
    kinds = [("x", "blank")] + [(i, f) for i in "suax" for f in ("", "truncated")]
    assert len(kinds) == turns.SYMBOLS and own.before.shape[0] == turns.SYMBOLS**turns.BLOCK
    for n in [*range(12)] * 30:
        symbols = np.array([rng.randrange(turns.SYMBOLS) for _ in range(n)], np.int64)
        edits, q, cost = own.expand(symbols, 0, turns.START)
        audit = "".join(edits) + turns.closing(q)
        assert (cost, audit) == least([kinds[s] for s in symbols], 0, "", {})
        before, extra, state = own.transition(symbols)
        assert own.vectors[before[0]][turns.START] + extra[0] == cost and state[0][turns.START] == q


def test_least_edits_by_trying_all():
    """The plain program itself, against all audits of short conversations."""
    for rows in itertools.product([("s", ""), ("u", "truncated"), ("a", ""), ("x", "blank")], repeat=2):
        tried = []
        for n in range(7):
            for audit in itertools.product("DIKR", repeat=n):
                cost, roles, i = 0, "", 0
                for edit in audit:
                    if edit == "I":
                        cost, roles = cost + 3, roles + ("a" if roles[-1:] == "u" else "u")
                        continue
                    if i == len(rows) or (edit != "D" and rows[i][1] == "blank"):
                        break
                    if edit == "D":
                        cost += 4
                    else:
                        cost += 3 * (rows[i][1] == "truncated") + 3 * (edit == "R")
                        roles += rows[i][0] if edit == "K" else "a" if roles[-1:] == "u" else "u"
                    i += 1
                else:
                    if i == len(rows) and LEGAL.fullmatch(roles):
                        tried.append((cost, "".join(audit)))
        assert least(list(rows), 0, "", {}) == min(tried)


@pytest.mark.parametrize(("rows", "partitions"), [(1 << 16, 4), (3, 4), (1, 7), (5, 1)])
def test_repair_equals_plain_program(spark, monkeypatch, rows, partitions):
    """Chunks of few rows and more partitions part conversations at any place."""
    monkeypatch.setattr(turns, "CHUNK_ROWS", rows)
    data = awkward()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = found(turns.repair(turns.damage(spark.createDataFrame(data, SCHEMA).repartition(5))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows == plain_repair(data)


def test_one_conversation_in_many_partitions(spark, monkeypatch):
    """A conversation that holds most rows, many of them equal, and a very long text."""
    monkeypatch.setattr(turns, "CHUNK_ROWS", 50)
    rng = random.Random(4)
    roles = ["user", "assistant", "system", "x"]
    data = [(1, t, rng.choice(roles), rng.choice(["a.", f"b {t}", f"c {t}!"]), None, None) for t in range(900)]
    data += [(1, 7, "user", "same.", None, None)] * 300 + [(2, 0, "user", "w " * 300_000, None, None), (2, 1, "assistant", "y.", None, None)]
    assert found(turns.repair(turns.damage(spark.createDataFrame(data, SCHEMA)))) == plain_repair(data)


def test_repair_of_no_rows(spark):
    assert turns.repair(turns.damage(spark.createDataFrame([], SCHEMA))).count() == 0


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_repair"](spark, sf_dir)) == plain_repair(rows)
