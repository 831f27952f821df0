"""Conversation repair against a search written row by row, on damaged tables and odd conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pyarrow.parquet as pq
import pytest
from oracle import MEDIUM, SMALL

from starflow.llm import conversation_repair as cr
from starflow.llm import queries as llm

BLANKS = " \t\n\x0b\x0c\r"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def faults_of(rows):
    found, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(BLANKS)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows, faults):
    """Least cost, then least text of edits, over all ways: forward through the rows, with at most three rows
    put in at a time. Every state is a tuple of the initials so far that matter."""

    def after(state, initial):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[state].find(initial) >= 0

    @lru_cache(None)
    def best(at, state, put):
        options = []
        if put < 3:
            for initial in "ua":
                if after(state, initial):
                    cost, text = best(at, initial, put + 1)
                    options.append((cost + 3, "I" + text))
        if at == len(rows):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            extra = 3 if faults[at] == "truncated" else 0
            cost, text = best(at + 1, state, 0)
            options.append((cost + 4, "D" + text))
            if faults[at] not in ("blank", "duplicate"):
                initial = rows[at][1][:1]
                for edit, to, price in [("K", initial, 0), ("R", "u", 3), ("R", "a", 3)]:
                    if to and after(state, to):
                        cost, text = best(at + 1, to, 0)
                        options.append((cost + price + extra, edit + text))
        return min(options, default=(10**9, ""))

    for at in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(at, state, 0)
    return best(0, "", 0)


def mended(rows, edits):
    lines, state, at = [], "", 0
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    for edit in edits:
        if edit == "I":
            state = follow[state]
            lines.append(names[state] + ":")
            continue
        _, role, text = rows[at]
        at += 1
        if edit == "K":
            state = role[0]
            lines.append(f"{role}:{text}")
        elif edit == "R":
            state = follow[state]
            lines.append(f"{names[state]}:{text}")
    assert at == len(rows)
    return "\n".join(lines)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def report(rows):
    rows = in_order(rows)
    faults = faults_of(rows)
    turns = {r[0] for r in rows if r[0] is not None}
    initials = [r[1][:1] for r in rows]
    cost, audit = cheapest(tuple(rows), tuple(faults))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        audit,
        hashlib.sha256(mended(rows, audit).encode()).hexdigest(),
    )


def brute_force(table):
    """The query's contract, from plain rows (conv_id, turn, role, text)."""
    damaged = {}
    for conv, turn, role, text in table:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        damage = zlib.crc32(key.encode()) % 20
        own = damaged.setdefault(conv, [])
        if damage == 1:
            text = ""
        elif damage == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif damage == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(damage, 1)
    return {(conv, *report(rows)) for conv, rows in damaged.items()}


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
def test_query_equals_brute_force(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table]
    found = llm.op13_conversation_repair(spark, sf_dir)
    assert found.columns == COLUMNS
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_force(rows)


def odd_conversations(seed):
    draw = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None, "User", "s", "assistant", "user"]
    texts = ["Yes.", "No", "What?", "", " \t\n", None, "é\x0b!", "go on", "Done! \r", "日本"]
    rows = []
    for conv in [*range(40), None]:
        for _ in range(draw.randint(1, 12)):
            turn = draw.choice([None, *range(8), -3, 10**12])
            rows.append((conv, turn, draw.choice(roles), draw.choice(texts)))
    return rows + draw.choices(rows, k=30)


def written(spark, tmp_path, rows, extra="7 AS part, 'x' AS piece, 1 AS edits, 2 AS copies"):
    path = str(tmp_path / "conversations.parquet")
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.selectExpr("*", *extra.split(", ")).repartition(5).write.parquet(path)
    return str(tmp_path)


@pytest.mark.parametrize("seed", range(3))
def test_odd_conversations_equal_brute_force(spark, tmp_path, seed):
    rows = odd_conversations(seed)
    found = llm.op13_conversation_repair(spark, written(spark, tmp_path, rows))
    assert {tuple(r) for r in found.collect()} == brute_force(rows)


def test_conversations_cut_into_pieces_equal_whole_ones(spark, tmp_path, monkeypatch):
    """Pieces of three symbols, over many partitions: ranks decide ties as the edits' text would."""
    monkeypatch.setattr(cr, "PIECE", 3)
    rows = odd_conversations(9)
    draw = random.Random(4)
    rows += [(500, t, draw.choice(["user", "assistant", "system"]), draw.choice(["a.", "b", "c?", ""])) for t in range(300)]
    rows += [(501, 1, "user", "Again.")] * 200
    found = llm.op13_conversation_repair(spark, written(spark, tmp_path, rows))
    assert {tuple(r) for r in found.collect()} == brute_force(rows)


def test_no_conversations(spark, tmp_path):
    path = written(spark, tmp_path, [(1, 0, "user", "x")])
    empty = spark.read.parquet(f"{path}/conversations.parquet").filter("false")
    counts, found = cr.diagnose(empty)
    assert counts.collect() == [] and found.collect() == []
    assert cr.repaired(empty, found).collect() == []


def test_rules_are_shared_and_multiply_to_the_same(spark):
    draw = random.Random(1)
    symbols = "".join(chr(97 + k) for k in range(12))
    texts = ["".join(draw.choices(symbols, k=draw.randint(1, 40))) for _ in range(300)] + ["dg" * 50, "d" * 33]
    rules = cr.learn_rules(spark.createDataFrame([(t,) for t in texts], "symbols string"))
    assert rules and len(set(rules)) == len(rules)
    plain, packed = cr.Grammar([]), cr.Grammar(rules)
    assert sum(map(len, packed.compress(texts))) < 0.8 * sum(map(len, texts))

    def ways(grammar):
        found = {}
        for places, block in grammar.blocks(texts):
            for i in range(4):
                for j in range(4):
                    costs = block.cost[:, i, j]
                    made = block.texts(places * 0 + i, places * 0 + j)
                    for place, cost, text in zip(places, costs, made):
                        found[place, i, j] = (cost, text) if cost < 1 << 40 else None
        return found

    assert ways(plain) == ways(packed)
