"""The Jaccard join against all pairs, also through many small blocks."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
from conftest import no_more_shuffle_files, rows, shuffle_files
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.common import stored
from tidemark.llm.oracle import SQL

SCHEMA = "doc_id long, text string"
COLUMNS = ["doc_id", "n_shingles", "n_links", "component_id"]


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(table):
    """By comparing all pairs of rows."""
    sets = [shingles(text) for _, text in table]
    near = [[] for _ in table]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and 100 * len(a & b) >= 80 * len(a | b):
                near[i].append(j)
    result = []
    for i, (doc_id, _) in enumerate(table):
        reached, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        ids = [table[j][0] for j in reached if table[j][0] is not None]
        result.append((doc_id, len(sets[i]), len(near[i]), min(ids) if sets[i] and ids else doc_id))
    return sorted(result, key=lambda t: [(v is None, v) for v in t])


def corpus(seed):
    """Families of near copies of some sizes, boilerplate, copies, short and odd texts."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    licence = " ".join(pick.choices(words, k=40))
    table = []
    for family in range(12):
        base = pick.choices(words, k=pick.choice([6, 9, 20, 60, 200]))
        for _ in range(pick.choice([1, 3, 25])):
            text = list(base)
            for _ in range(pick.randint(0, max(1, len(base) // 25))):
                text[pick.randrange(len(text))] = pick.choice(words)
            if pick.random() < 0.2:
                text = text[: pick.randint(1, len(text))]
            table.append(" ".join(text) + (f" {licence}" if family % 3 == 0 else ""))
    table += ["", None, "one", "One  two", "one two", "one two three four", " \n\t", "É é", "é É",
              "a b c d e", "A B\tC d\ne", "a b c d e f", "x " * 300, "x " * 9, "x y " * 2000,
              licence, licence + " tail"]
    pick.shuffle(table)
    ids = [None if i % 13 == 5 else i // 2 if i % 7 == 0 else i for i in range(len(table))]
    return list(zip(ids, table))


@pytest.mark.parametrize("seed, size", [(1, 256), (2, 3)])
def test_against_all_pairs(spark, monkeypatch, seed, size):
    """Blocks of a few documents give what large ones give."""
    monkeypatch.setattr(jaccard, "BLOCK_DOCUMENTS", size)
    table = corpus(seed)
    docs = spark.createDataFrame(table, SCHEMA).withColumns(
        {name: F.lit("clash") for name in ("key", "n", "block", "root", "links", "family", "of")}
    )
    assert rows(jaccard.jaccard_join(docs), *COLUMNS) == expected(table)


def test_sql_against_all_pairs():
    table = [(i, text) for i, (_, text) in enumerate(corpus(4))]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", table)
    result = con.execute(SQL["op11_grouped_prefix_join"])
    names = [d[0] for d in result.description]
    got = [tuple(r[names.index(n)] for n in COLUMNS) for r in result.fetchall()]
    assert sorted(got) == expected(table)


def test_large_family_of_near_copies(spark):
    """Many different texts within reach of each other, in many blocks."""
    base = [f"b{i}" for i in range(150)]
    table = [(i, " ".join([*base[: i % 147], f"x{i}", *base[i % 147 + 1 :]])) for i in range(400)]
    got = rows(jaccard.jaccard_join(spark.createDataFrame(table, SCHEMA)), *COLUMNS)
    assert got == expected(table)
    assert {r[3] for r in got} == {0}


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert rows(jaccard.jaccard_join(empty), *COLUMNS) == []
    named = spark.createDataFrame([("b", "a b c"), ("a", "A b  c"), (None, None)], "doc_id string, text string")
    assert rows(jaccard.jaccard_join(named), *COLUMNS) == [
        ("a", 1, 1, "a"), ("b", 1, 1, "a"), (None, 0, 0, None)
    ]
    alone = spark.createDataFrame([(1, "only one text"), (2, "and another")], SCHEMA)
    assert rows(jaccard.jaccard_join(alone), *COLUMNS) == [(1, 1, 0, 1), (2, 1, 0, 2)]


def test_prefix_and_size_bounds():
    """The least overlap and the prefix are right at the edge of the threshold."""
    for n in range(1, 200):
        for m in range(n, 250):
            needed = next((k for k in range(n + 1) if 100 * k >= 80 * (n + m - k)), None)
            least = int(jaccard.least_shared(np.int64(n), np.int64(m)))
            assert least == needed if needed is not None else least > n
            if needed is not None:
                assert jaccard.prefix_size(n) >= n - needed + 1
                assert jaccard.prefix_size(m) >= m - needed + 1


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS_AT_ONCE", 7)
    pick = np.random.default_rng(1)
    for _ in range(20):
        sides = [
            [np.unique(pick.integers(0, 60, pick.integers(1, 40)).astype(np.uint64)) for _ in range(k)]
            for k in pick.integers(1, 6, 2)
        ]
        made = jaccard.shared_counts(*sides)
        assert made.tolist() == [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]


def test_a_stored_step_leaves_no_shuffle_files(spark):
    """They would take disk until the driver's next garbage collection, for all steps at once."""
    before = shuffle_files(spark)
    found = stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "test-step")
    assert no_more_shuffle_files(spark, before)
    assert rows(found) == [(k, 143 if k < 6 else 142) for k in range(7)]
