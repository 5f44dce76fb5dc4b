"""Conversation repair against an enumeration of all edits, its SQL, and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from conftest import rows

from tidemark.llm import conversations as c
from tidemark.llm.oracle import SQL

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")
COLUMNS = ["conv_id", *c.COUNTS, "audit", "repaired_sha256"]


def damaged(table):
    """Rows after damage by conversation, in plain Python."""
    found = {}
    for conv, turn, role, text in table:
        kept = found.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if fault == 3 else 1)
    for kept in found.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return found


def faults(kept):
    seen, found = set(), []
    for _, role, text in kept:
        if BLANK.match(text):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        elif text.rstrip(" \t\n\v\f\r")[-1] not in ".!?":
            found.append("truncated")
        else:
            found.append("")
        seen.add((role, text))
    return found


def cheapest(kept, found):
    """(cost, audit, lines) by trying all edits, with at most three inserts in a place."""
    best = None

    def step(i, inserted, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(kept) and PATTERN.fullmatch("".join(r[:1] or "-" for r, _ in out)):
            best = min(best or (cost, audit, out), (cost, audit, out))
        if inserted < 3:
            for role in ("user", "assistant"):
                step(i, inserted + 1, cost + 2, audit + "I", [*out, (role, "")])
        if i == len(kept):
            return
        _, role, text = kept[i]
        step(i + 1, 0, cost + 3, audit + "D", out)
        if found[i] not in ("blank", "duplicate"):
            extra = found[i] == "truncated"
            step(i + 1, 0, cost + extra, audit + "K", [*out, (role, text)])
            for other in ("user", "assistant"):
                step(i + 1, 0, cost + 2 + extra, audit + "R", [*out, (other, text)])

    # A bound from deleting everything keeps the search small.
    best = (3 * len(kept), "D" * len(kept), [])
    step(0, 0, 0, "", [])
    return best


def expected(table):
    result = []
    for conv, kept in damaged(table).items():
        found = faults(kept)
        cost, audit, out = cheapest(kept, found)
        turns = [t for t, _, _ in kept if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        result.append((
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[found.count(f) for f in c.FAULTS],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
        ))
    return sorted(result, key=lambda t: [(v is None, v) for v in t])


def random_table(seed, conversations=60, longest=5):
    pick = random.Random(seed)
    table = []
    for conv in range(conversations):
        for turn in range(pick.randint(1, longest)):
            table.append((
                conv if conv else None,
                pick.choice([None, turn, turn, turn, turn * 2]),
                pick.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                pick.choice(["Yes.", "No!", "cut off", "", " \t", None, "Why?\n", "é😀.", "nbsp "]),
            ))
    return table


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_against_all_edits(spark, seed):
    table = random_table(seed)
    df = spark.createDataFrame(table, SCHEMA)
    got = rows(c.repair(c.damage(df), damaged=True), *COLUMNS)
    assert got == expected(table)


def test_sql_against_all_edits():
    table = random_table(4)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", table)
    result = con.execute(SQL["op13_scalar_repair"])
    names = [d[0] for d in result.description]
    got = [tuple(r[names.index(n)] for n in COLUMNS) for r in result.fetchall()]
    assert sorted(got, key=lambda t: [(v is None, v) for v in t]) == expected(table)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repair(c.damage(empty), damaged=True).count() == 0
    clash = spark.createDataFrame(
        [("x", 0, "user", "Hi.", True, 9, "c"), ("x", 1, "assistant", "Hello.", False, 9, "c"),
         ("y", None, None, None, True, 9, "c")],
        "conv_id string, turn int, role string, text string, dropped boolean, copy int, fault string",
    )
    got = rows(c.repair(clash), "conv_id", "blank", "cost", "audit")
    assert got == [("x", 0, 0, "KK"), ("y", 1, 3, "D")]
    # Without a row left after damage: crc32 of "k:0" modulo 20 is 0.
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    digest = hashlib.sha256(b"").hexdigest()
    assert rows(c.repair(c.damage(df), damaged=True), *COLUMNS) == [
        (gone, 0, 0, 0, 0, 0, 0, "", digest)
    ]


def test_repeated_rows_and_long_texts(spark):
    long = "word " * 200_000 + "end."
    table = [(1, 0, "user", long), (1, 0, "user", long), (1, 1, "assistant", "Yes.")]
    got = rows(c.repair(spark.createDataFrame(table, SCHEMA)), "duplicate", "cost", "audit")
    assert got == [(1, 3, "KDK")]


def plain(kept, found):
    """(cost, audit) of a long conversation: the same minimum over (cost, letters)."""
    paths = {0: (0, "")}
    for (_, role, _), fault in zip(kept, found):
        after = {}
        for q, (cost, audit) in paths.items():
            for edge in c._edges(role[:1], fault in ("blank", "duplicate"), fault == "truncated"):
                if edge[0] == q:
                    letters = f"{edge[3]:0{edge[4]}o}"
                    way = (cost + edge[2], audit + "".join(" DIKR"[int(x)] for x in letters))
                    after[edge[1]] = min(after.get(edge[1], way), way)
        paths = after
    ends = [(cost + 2 * len(c._close(q)), audit + "I" * len(c._close(q)))
            for q, (cost, audit) in paths.items()]
    return min(ends)


@pytest.mark.parametrize("roles", ["usa", "s", "uuua", "ua", "x"])
def test_long_conversations(spark, roles):
    """Thousands of rows: letters are settled or the digits widened, never cut."""
    pick = random.Random(5)
    names = {"u": "user", "s": "system", "a": "assistant", "x": "tool"}
    kept = [(i, names[pick.choice(roles)], f"Text {i}{pick.choice(['.', ''])}") for i in range(3000)]
    df = spark.createDataFrame([(7, *r) for r in kept], SCHEMA)
    cost, audit = plain(kept, faults(kept))
    assert rows(c.repair(df), "cost", "audit") == [(cost, audit)]
    assert len(audit) >= 3000
