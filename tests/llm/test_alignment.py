"""Token alignment against the tokenizers' own output and plain loops."""

from __future__ import annotations

import hashlib
import json
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from conftest import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment as al

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None, "", " ", "a", "plain words here", " two  blanks   and\ttabs\nlines \n\n end ",
    "don't it's we'll I'VE 12345 3.14 x=y;z", "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve café ﬁn ① Ⅷ ﷺ", "日本語のテキスト 漢字かな交じり文", "😀👍🏽 emoji ZWJ 👩‍👩‍👧",
    "lower ▁ mark", "ends with ▁", "nul \x00 char \x1c\x1d   line", "a" * 3000,
    "word " * 500, " " * 700, "x  y 　z", "éà " * 40 + "é", "one two one two one",
    "plain words here", "ﬀ" * 50, "\n", "tab\there 	there", "mixed العربية עברית ไทย",
]


@pytest.fixture(scope="module")
def tokenizers():
    with open(al.default_byte_bpe(), "rb") as a, open(al.default_pieces(), "rb") as b:
        return al._pair(a.read(), b.read())


def plain_tokens():
    """text -> ids of both tokenizers with the bytes of each, from the files alone."""
    a = Tokenizer.from_file(al.default_byte_bpe())
    a.encode_special_tokens = True
    with open(al.default_byte_bpe()) as file:
        vocabulary = json.load(file)["model"]["vocab"]
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in visible}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in visible)}
    a_bytes = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items()}
    b = sentencepiece.SentencePieceProcessor(model_file=al.default_pieces())

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        found = [
            [(i, a_bytes[i]) for i in a.encode(" " + text, add_special_tokens=False).ids],
            [(i, b_bytes(i)) for i in b.encode(text)],
        ]
        whole = (" " + text).encode()
        same = all(b"".join(raw for _, raw in side) == whole for side in found)
        return found if text and same else [[], []]

    return tokens


def groups_of(a, b):
    """Groups of both sides' ids, walking over the bytes."""
    groups, i, j, end_a, end_b = [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        left, right = [], []
        while True:
            if end_a <= end_b:
                left.append(a[i][0])
                end_a += len(a[i][1])
                i += 1
            else:
                right.append(b[j][0])
                end_b += len(b[j][1])
                j += 1
            if end_a == end_b:
                break
        groups.append((left, right))
    return groups


def expected(table):
    tokens = plain_tokens()
    found = []
    for doc_id, text in table:
        a, b = tokens(text or "")
        found.append((doc_id, len(a), len(b), groups_of(a, b)))
    # Tokens whose ranges end together are the last ones of a group.
    counts = Counter((left[-1], right[-1]) for *_, groups in found for left, right in groups)
    best = Counter()
    for (_, b_id), n in counts.items():
        best[b_id] = max(best[b_id], n)
    result = []
    for doc_id, n_a, n_b, groups in found:
        links = [(left[-1], right[-1]) for left, right in groups]
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        result.append((
            doc_id, n_a, n_b, len(groups), len(links),
            sum(counts[pair] == best[pair[1]] for pair in links),
            sum(counts[pair] for pair in links),
            hashlib.sha256(shown.encode()).hexdigest() if n_a else "",
        ))
    return sorted(result, key=lambda t: [(v is None, v) for v in t])


def aligned(spark, docs):
    return al.with_counts(al.stored(al.packed(docs), "test-alignment"))


@pytest.mark.parametrize("broadcast", [al.BROADCAST_PAIRS, 0])
def test_against_plain_loops(spark, monkeypatch, broadcast):
    """Both ways of looking pairs up; odd, NULL, empty and repeated texts and ids."""
    monkeypatch.setattr(al, "BROADCAST_PAIRS", broadcast)
    table = [(i if i % 7 else None, text) for i, text in enumerate(TEXTS)] + [(3, "a"), (3, "b c")]
    docs = spark.createDataFrame(table, "doc_id long, text string").withColumns(
        {name: F.lit("clash") for name in ("pair", "links", "best", "row", "pairs", "block", "at")}
    )
    assert rows(aligned(spark, docs), *COLUMNS) == expected(table)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows(aligned(spark, docs), *COLUMNS) == expected(table)


def test_empty_table_and_other_ids(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert aligned(spark, empty).columns == COLUMNS[:5] + COLUMNS[7:] + COLUMNS[5:7]
    assert aligned(spark, empty).count() == 0
    named = spark.createDataFrame([("k", "plain words")], "doc_id string, text string")
    assert rows(aligned(spark, named), "doc_id") == [("k",)]


def test_products_against_dense_matrices():
    random = np.random.default_rng(3)
    for _ in range(30):
        n, k, m = random.integers(1, 12, 3)
        dense = random.integers(0, 3, (n, k)), random.integers(0, 3, (k, m))
        a, b = (
            al.Csr(np.concatenate(([0], np.cumsum((x > 0).sum(1)))), x.nonzero()[1], x.shape[1],
                   x[x > 0])
            for x in dense
        )
        made = np.zeros((n, m), np.int64)
        for first, slab in a.slabs(b, limit=int(random.integers(1, 20))):
            made[slab.rows() + first, slab.columns] = slab.entries()
        assert (made == dense[0] @ dense[1]).all()
        back = b.transpose()
        turned = np.zeros((m, k), np.int64)
        turned[back.rows(), back.columns] = back.entries()
        assert (turned == dense[1].T).all()


def test_kinds_of_links(spark, monkeypatch):
    """Overlaps weigh the shared bytes, group links are all pairs of a group."""
    monkeypatch.setattr(al, "PRODUCTS", 50)
    tokens = plain_tokens()
    table = [(i, t) for i, t in enumerate(TEXTS) if t and len(t) < 100]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    names = ["doc_id", "a_place", "b_place", "a_id", "b_id", "weight"]
    wanted = {kind: [] for kind in al.KINDS}
    for doc_id, text in table:
        a, b = tokens(text)
        ends = [np.cumsum([len(raw) for _, raw in side]).tolist() for side in (a, b)]
        shared = set(ends[0]) & set(ends[1])
        for i, (a_id, a_raw) in enumerate(a):
            for j, (b_id, b_raw) in enumerate(b):
                stop, last = ends[0][i], ends[1][j]
                common = min(stop, last) - max(stop - len(a_raw), last - len(b_raw))
                row = (doc_id, i, j, a_id, b_id)
                if common > 0:
                    wanted["overlap"].append((*row, common))
                    if stop == last:
                        wanted["end"].append((*row, common))
                if sum(x < stop for x in shared) == sum(x < last for x in shared):
                    wanted["group"].append((*row, 1))
    for kind in al.KINDS:
        assert rows(al.token_links(docs, kind), *names) == sorted(wanted[kind])
    with pytest.raises(ValueError):
        al.token_links(docs, "none")


def test_written_groups_and_long_texts(spark):
    long = "some words and ünïcode " * 20_000 + "x" * 100_000
    docs = spark.createDataFrame([(1, long), (2, "a b")], "doc_id long, text string")
    got = {r.doc_id: r for r in al.alignments(docs).collect()}
    groups = groups_of(*plain_tokens()(long))
    shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    assert got[1].groups == shown and got[1].n_groups == len(groups)


def test_words_are_independent(tokenizers):
    """What makes cutting at single blanks right: no piece goes on behind a blank."""
    a, b = tokenizers
    assert b.can_cut
    for text in filter(None, TEXTS):
        words = al.CUT.split(text)
        assert " ".join(words) == text
        for tokenizer in (a, b):
            apart, size = tokenizer.encode(words)
            assert size.sum() == len(apart)
            assert apart.tolist() == tokenizer.encode([text])[0].tolist()
    every = [w for text in filter(None, TEXTS) for w in al.CUT.split(text)] * 50
    for tokenizer in (a, b):
        ids, size = tokenizer.encode(every)
        at = np.cumsum(size) - size
        for word, low, n in zip(every[:120], at, size):
            assert ids[low : low + n].tolist() == tokenizer.encode([word])[0].tolist()
