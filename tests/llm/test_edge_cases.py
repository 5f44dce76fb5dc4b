"""Nulls, empty and long texts, ties, repeated rows, empty tables and further columns."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    bpe,
    decontaminate,
    grade,
    langid,
    pii,
    rules,
    shards,
    simhash,
    substrings,
    toxicity,
)

PROSE = " ".join(f"word{i % 37} and{i % 11}" for i in range(40))
LONG = "lorem ipsum dolor " * 12_000
ITEM = "the quick brown fox jumps over the lazy dog near the old mill"
CLASHES = ("score", "label", "fp", "rank", "shard", "row", "piece", "doc", "class", "window",
           "base", "candidates", "spans", "group", "size", "ids", "kept", "bin", "key")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD = [
    (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1),
    (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \n\t ", None, "a", 4),
    (6, LONG, "en", "b", 1), (None, PROSE + " tail", "de", "b", 1), (None, None, None, None, None),
    (7, f"Start. {ITEM.upper()}! End.", "en", "a", 1), (8, "x", None, "a", 1),
    (9, "é😀 mail a@b.co, +1 (212) 555-0199", "fr", None, 2), (10, "!!! ### $$$ 123", "en", "a", 3),
]
LABELS = [(1, 1, 0), (2, 1, 0), (6, 0, 1), (9, 1, 1), (10, 0, 0), (4, None, None), (None, 1, 1),
          (1, 1, 0), (99, 0, 0)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    docs = docs.withColumns({name: F.lit("clash") for name in CLASHES})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    items = [(0, ITEM), (1, None), (2, ""), (3, "too short"), (4, ITEM)]
    return docs, labels, spark.createDataFrame(items, "item_id long, text string")


def every_row(docs, labels):
    """Each operator that returns a row per document."""
    return {
        "rules": lambda: rules.isolation_rules(docs, labels),
        "bpe": lambda: bpe.decode(bpe.encode(docs)),
        "pii": lambda: pii.find_spans(docs),
        "substrings": lambda: substrings.remove_repeats(docs),
        "simhash": lambda: simhash.near_duplicates(docs),
        "grade": lambda: grade.grade_documents(docs, grade.ratings_from_labels(labels)),
        "langid": lambda: langid.identify(docs),
        "shards": lambda: shards.pack(docs),
        "toxicity": lambda: toxicity.toxic_passages(docs, labels),
    }


NAMES = ("rules", "bpe", "pii", "substrings", "simhash", "grade", "langid", "shards", "toxicity")


@pytest.mark.parametrize("name", NAMES)
def test_every_document_gets_a_row(tables, name):
    docs, labels, _ = tables
    found = every_row(docs, labels)[name]()
    assert rows(found, "doc_id") == rows(docs, "doc_id")


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(tables, name):
    docs, labels, _ = tables
    assert every_row(docs.limit(0), labels.limit(0))[name]().collect() == []


@pytest.mark.parametrize("name", ("rules", "grade", "langid", "toxicity"))
def test_nothing_to_learn_from(tables, name):
    docs, labels, _ = tables
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert every_row(unlabelled, labels.limit(0))[name]().count() == len(ODD)


def test_rules_of_empty_texts(tables):
    docs, labels, _ = tables
    found = {r.doc_id: r for r in rules.isolation_rules(docs, labels).collect()}
    assert (found[3].n_words, found[3].base_failed, found[3].kept) == (0, True, False)
    assert found[6].n_repeat_words == 36_000 and not found[6].kept


def test_bpe_of_empty_and_long_texts(tables):
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode(bpe.encode(tables[0])).collect()}
    assert decoded[3] == b"" and decoded[4] == b"" and decoded[6] == LONG.encode()


def test_decontamination_ignores_short_and_empty_items(tables):
    docs, _, items = tables
    hits = rows(decontaminate.contaminated(docs, items), "doc_id", "item_id", "edits")
    assert hits == [(7, 0, 0), (7, 4, 0)]
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []


def test_spans_and_redaction(tables):
    found = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.spans]
             for r in pii.find_spans(tables[0]).collect()}
    assert found[9] == [("email", 8, 14), ("phone", 16, 33)]
    assert found[3] == found[4] == []
    texts = {r.doc_id: (r.text, r.n_chars) for r in pii.redact_documents(tables[0]).collect()}
    assert texts[9] == ("é😀 mail [EMAIL], [PHONE]", 24)
    assert texts[3] == (None, None) and texts[6][0] == LONG


def test_repeated_rows_are_one_document(tables):
    found = substrings.remove_repeats(tables[0].filter("doc_id < 3"))
    assert rows(found, "doc_id", "n_removed") == [(1, 0), (2, 80), (2, 80)]


def test_near_duplicates_without_id_or_text(tables):
    found = simhash.near_duplicates(tables[0])
    parts = {r.doc_id: r.component_id for r in found.collect()}
    assert parts[1] == parts[2] == 1
    assert parts[3] == parts[4] == parts[5] == 3
    assert rows(simhash.keep_representatives(tables[0]).filter("doc_id in (1, 2)"), "doc_id") == [(1,)]


def test_undetermined_language(tables):
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(tables[0]).collect()}
    assert found[3] == found[4] == found[10] == ("und", 0.0)


def test_slots_have_no_gap(tables):
    found = shards.pack(tables[0], shards=3)
    for shard, in rows(found.select("shard").distinct()):
        slots = [r[0] for r in rows(found.filter(F.col("shard") == shard), "slot")]
        assert slots == list(range(len(slots)))


def test_stages_keep_the_columns(spark, tables, tmp_path):
    docs, labels, items = tables
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, str(tmp_path))
            assert table.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path))
        assert last.count() == table.count()


def test_contamination_is_found_whatever_text_comes_before(spark):
    items = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    words = ITEM.split()
    damaged = [words[:-1], [*words[:-1], "hill"], words[:-2], [*words[:-1], "hill", *["so"] * 30]]
    texts = [(i, " ".join(w)) for i, w in enumerate([["one", "two", "three"], *damaged] * 2)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    found = rows(decontaminate.contaminated(docs, items), "doc_id", "edits")
    assert found == [(1, 1), (2, 1), (3, 2), (4, 1), (6, 1), (7, 1), (8, 2), (9, 1)]


def test_overlapping_items_are_each_found(spark):
    words = [f"w{i * i % 9973}" for i in range(150)]
    texts = [(0, words[:100]), (1, words[50:150])]
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, " ".join(words[30:150])), (2, " ".join(words))], "doc_id long, text string"
    )
    found = rows(decontaminate.contaminated(docs, items), "doc_id", "item_id", "edits")
    assert found == [(1, 1, 0), (2, 0, 0), (2, 1, 0)]


def test_long_items_are_found(spark):
    words = [f"w{i * i % 99991}" for i in range(10_000)]
    items = [(0, words), (1, words[:6_500])]
    damaged = [w if i % 12 else "changed" for i, w in enumerate(words[:6_500])]
    texts = [["one", *words, "two"], damaged]
    table = [(i, " ".join(w)) for i, w in items]
    texts = [(i, " ".join(w)) for i, w in enumerate(texts)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame(table, "item_id long, text string")
    found = rows(decontaminate.contaminated(docs, items), "doc_id", "item_id", "edits")
    assert found == [(0, 0, 0), (0, 1, 0), (1, 1, sum(w == "changed" for w in damaged))]


def test_clean_rows_stay_whatever_their_ids(spark):
    items = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    texts = [(None, f"so {ITEM}"), (None, PROSE), (None, None), (5, f"{ITEM} so"), (5, "clean"), (6, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = decontaminate.keep_uncontaminated(docs, items)
    assert kept.columns == docs.columns
    assert rows(kept) == [(5, "clean"), (6, ""), (None, PROSE), (None, None)]


@pytest.mark.parametrize("hot", [0, substrings.HOT_OCCURRENCES])
def test_texts_without_or_with_one_id_are_documents_of_their_own(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_OCCURRENCES", hot)
    a, b, c, d, e = ([f"{name}{i}" for i in range(30)] for name in "abcde")
    texts = [(1, a), (None, a + b), (None, c + d), (7, e + b), (7, c), (None, c + d)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    found = rows(substrings.remove_repeats(docs), "doc_id", "n_removed", "kept")
    kept = [(1, 0, a), (7, 0, c), (7, 0, e + b), (None, 30, d), (None, 30, d), (None, 60, [])]
    assert found == [(i, n, " ".join(w)) for i, n, w in kept]
