"""Packing of rows that share an id or have none, against plain greedy packing; ids of
other types."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.llm import pii, shards, simhash, substrings


def balance(found):
    sizes, counts = Counter(), Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
        counts[r["shard"]] += 1
    return sizes, counts


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_without_an_id_of_their_own(spark, doc_id):
    """Half of the rows have no id, or one id, and one text."""
    table = [(doc_id, "one and the same text")] * 4000
    table += [(10 + i, f"text {i} " + "x" * (i % 90)) for i in range(4000)]
    found = shards.pack(spark.createDataFrame(table, "doc_id long, text string")).collect()
    sizes, counts = balance(found)
    even = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(size - even) < 0.1 * even for size in sizes.values())
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    for r in found[:200]:
        assert r["law"] == "bytes" and r["grown_shard"] is None
    crc = {r["doc_id"]: r["text_crc32"] for r in found}
    assert all(crc[i] == zlib.crc32(text.encode()) for i, text in table)


def test_groups_are_packed_as_by_a_plain_loop(spark):
    """Groups too large for bundles, each placed where the dot product is highest."""
    texts = [f"{'word ' * (3 + i * 7 % 11)}{i} {'y' * (i * 37 % 150)}" for i in range(60)]
    table = [(i * 100 + k, text) for i, text in enumerate(texts) for k in range(1 + i % 4)]
    got = shards.pack(spark.createDataFrame(table, "doc_id long, text string")).collect()
    total = [0, 0, 0]
    groups = defaultdict(lambda: [0, 0, 0])
    for _, text in table:
        vector = [len(text.encode()) + 1, len(text.split()), 1]
        groups[text] = [a + b for a, b in zip(groups[text], vector)]
        total = [a + b for a, b in zip(total, vector)]
    shares = {t: [8 * a / b for a, b in zip(v, total)] for t, v in groups.items()}
    md5 = {t: __import__("hashlib").md5(t.encode()).hexdigest() for t in groups}
    left = [[1.0, 1.0, 1.0] for _ in range(8)]
    place = {}
    for text in sorted(shares, key=lambda t: (-sum(shares[t]), md5[t])):
        dots = [sum(a * b for a, b in zip(room, shares[text])) for room in left]
        place[text] = max(range(8), key=lambda s: (round(dots[s], 9), -s))
        left[place[text]] = [a - b for a, b in zip(left[place[text]], shares[text])]
    by_id = {i: text for i, text in table}
    assert {r["doc_id"]: r["shard"] for r in got} == {i: place[t] for i, t in by_id.items()}


def test_repeats_with_ids_of_text(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    table = [("b", f"{passage} tail"), ("a", f"head {passage}"), ("c", "short"), (None, passage)]
    got = substrings.remove_repeats(spark.createDataFrame(table, "doc_id string, text string"))
    assert rows(got, "doc_id", "n_removed", "kept") == [
        ("a", 0, f"head {passage}"), ("b", 30, "tail"), ("c", 0, "short"), (None, 30, "")
    ]


def test_a_defined_representative_whatever_the_columns(spark):
    """Columns with the names of helpers; ties by digest; identical rows once."""
    text = "some words that are all the same here"
    table = [(2, text, "x"), (1, text, "y"), (1, text, "y"), (None, text, "z"), (5, "else", "w")]
    names = "doc_id long, text string, _near_id string"
    docs = spark.createDataFrame(table, names).withColumns(
        {n: F.lit("clash") for n in ("_near_root", "digest", "fp", "root", "row", "unnamed")}
    )
    kept = simhash.keep_representatives(docs)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id", "_near_id") == [(1, "y"), (5, "w")]
    nameless = spark.createDataFrame([(None, text), (None, text + "!")], "doc_id long, text string")
    assert len({tuple(r) for r in simhash.keep_representatives(nameless).collect()}) >= 1


def test_many_matches_in_one_text_and_clashing_columns(spark):
    """Two hundred thousand numbers: their places are laid out in parts."""
    text = " ".join(f"{i % 100:02d}x" for i in range(200_000)) + " mail a@b.co"
    table = [(1, text, "x"), (2, "+1 212 555 0199 and a@b.co", "y"), (3, None, "z")]
    docs = spark.createDataFrame(table, "doc_id long, text string, _pii_base string")
    found = {r.doc_id: r.base for r in pii.find_spans(docs).collect()}
    assert [(s.kind, s.start, s.stop) for s in found[1]] == [("email", len(text) - 6, len(text))]
    assert [(s.kind, s.start, s.stop) for s in found[2]] == [("phone", 0, 15), ("email", 20, 26)]
    done = pii.redact_documents(docs.filter("doc_id > 1"))
    assert rows(done) == [(2, "[PHONE] and [EMAIL]", "y"), (3, None, "z")]
