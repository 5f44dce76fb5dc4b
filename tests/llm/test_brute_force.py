"""Operators against brute force on the smallest given tables."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import tiktoken
import xxhash
from conftest import rows

from tidemark.llm import bpe, components, decontaminate, pii, rules, shards, simhash, substrings
from tidemark.llm import langid, toxicity
from tidemark.llm.common import read

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in read(spark, SF, "documents").collect()}


def test_rule_counts(spark, docs):
    for r in rules.op1_isolation_rules(spark, SF).collect():
        text = docs[r.doc_id]
        words = WORD.findall(text)
        places: dict = {}
        for i in range(len(words) - 7):
            places.setdefault(tuple(words[i : i + 8]), []).append(i)
        covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
        )
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))


def test_isolated_rows_score_higher():
    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.normal(0, 1, (2000, 7)), np.full((5, 7), 9.0)])
    scores = rules.fit_forest(rows, trees=50).scores(rows)
    assert scores[-5:].min() > np.quantile(scores[:-5], 0.99)


def reference_encoding():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


HARD = {-1: "a" * 700 + "'re" * 90 + " " * 300 + "x", -2: "é😀" * 200 + "\n" * 150 + " 12",
        -3: "1" * 130 + "don't we'll " * 40, -4: " " * 500, -5: "字" * 333,
        -6: "word 'll  \t x" * 60, -7: ("字" * 40 + "，") * 20 + " 's" * 90}


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (200, 40), (bpe.CHUNK, bpe.OVERLAP)])
def test_chunked_encoding_is_that_of_whole_texts(spark, docs, chunk, overlap):
    """Chunk sizes travel to the workers as arguments; all long texts are cut."""
    repeat = 1 if chunk < bpe.CHUNK else 300
    texts = {**docs, **{i: text * repeat for i, text in HARD.items()}}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = reference_encoding()
    for r in bpe.decode(bpe.encode(table, chunk=chunk, overlap=overlap)).collect():
        ids = expected.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == np.array(ids, "<u4").tobytes(), r.doc_id
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    cut = bpe.pieces(table, bpe.default_pattern(), chunk, overlap).groupBy("doc_id").count()
    several = dict(map(tuple, cut.collect()))
    assert set(several) == {i for i, text in texts.items() if len(text) > chunk}
    # Words with blanks between them are cut in every chunk or nearly so.
    for i in (-3, -6):
        assert several[i] > len(texts[i]) / chunk / 3


def test_one_step_for_encoding_and_decoding(spark, docs):
    texts = {**docs, **{i: text * 300 for i, text in HARD.items()}, 0: None, -9: ""}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    both = bpe.digests(bpe.round_trip(table))
    assert rows(both) == rows(bpe.digests(bpe.decode(bpe.encode(table))))


def least_edits(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_recall_and_precision(spark, docs):
    rng = random.Random(5)
    items = {r.item_id: r.text for r in read(spark, SF, "benchmark").collect()}
    texts = {i: t for i, t in docs.items() if 50 < len(t) < 1500}
    hosts, planted = list(texts.values()), {}
    for number, (item, text) in enumerate(sorted(items.items()) * 3):
        words = text.split()
        for _ in range(rng.randint(0, decontaminate.max_edits(len(words)))):
            place = rng.randrange(len(words))
            edit = rng.randrange(3)
            if edit == 0:
                words[place] = "changed"
            elif edit == 1:
                words.insert(place, "added")
            else:
                del words[place]
        host = rng.choice(hosts).split()
        cut = rng.randrange(len(host))
        texts[10_000 + number] = " ".join([*host[:cut], *words, *host[cut:]])
        planted[10_000 + number] = item
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {
        (r.doc_id, r.item_id): r.edits
        for r in decontaminate.contaminated(table, read(spark, SF, "benchmark")).collect()
    }

    def plain(text):
        return text.lower().encode().translate(None, decontaminate._PUNCTUATION).split()

    for (doc, item), edits in found.items():
        assert edits == least_edits(plain(items[item]), plain(texts[doc]))
        assert edits <= decontaminate.max_edits(len(plain(items[item])))
    assert sum((d, i) in found for d, i in planted.items()) >= 0.95 * len(planted)
    # Pairs that no one planted: brute force over some of the given documents.
    for doc in sorted(d for d in texts if d < 10_000)[:60]:
        for item, text in items.items():
            near = least_edits(plain(text), plain(texts[doc])) <= decontaminate.max_edits(
                len(plain(text))
            )
            assert near == ((doc, item) in found)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_card(digits):
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10))
                for i, d in enumerate(reversed(digits)))
    return 14 <= len(digits) <= 19 and total % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind == "ip" and all(len(p.lstrip("0")) <= 3 and int(p) <= 255
                                           for p in m.group().split(".")),
                "card": is_card(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def test_base_spans(spark, docs):
    pieces = ["a@b.c_d@e.f", "x@y.z..", "1.2.3.4.5", "256.1.1.1", "001.02.3.4", "+1 (234) 567-8901",
              "4111 1111 1111 1111", "4111-1111-1111-1112", "@", ".", "+", "é😀", "12", "a.b@c", "-1"]
    rng = random.Random(3)
    made = {-n: "".join(rng.choice(pieces) + rng.choice(["", " ", "-", "."]) for _ in range(12))
            for n in range(1, 400)}
    texts = {**docs, **made}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.find_spans(table).collect():
        assert [tuple(s) for s in r.base] == base_spans(texts[r.doc_id]), texts[r.doc_id]
        assert set(map(tuple, r.base)) <= set(map(tuple, r.spans))


def test_labeler_reliabilities():
    # Two labelers that agree and a third that contradicts them.
    patterns = [(1, 1, 0, 60), (0, 0, 1, 40), (1, 1, None, 20), (0, 0, 0, 10)]
    (_, *rates), posterior = pii.estimate(patterns)
    assert posterior[0] > 0.9 > 0.1 > posterior[1]
    assert rates[0] > 0.9 and rates[2] < 0.3


def remaining(docs):
    seen, out = set(), {}
    for doc in sorted(docs):
        words = docs[doc].encode().split()
        covered = bytearray(len(words))
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                covered[i : i + 20] = b"\1" * 20
            seen.add(window)
        out[doc] = [w for w, c in zip(words, covered) if not c]
    return out


@pytest.mark.parametrize("hot", [3, substrings.HOT_OCCURRENCES])
def test_repeats(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_OCCURRENCES", hot)
    expected = remaining(docs)
    for r in substrings.op5_super_kmers(spark, SF).collect():
        kept = expected[r.doc_id]
        assert r.n_removed == r.n_words - len(kept)
        assert r.kept_sha256 == hashlib.sha256(b" ".join(kept)).hexdigest()


def plain_simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("block", [2, simhash.CELL_BLOCK])
def test_simhash_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "CELL_BLOCK", block)
    rng = random.Random(11)
    texts = {}
    for family in range(40):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 60, 300]))]
        for _ in range(6):
            texts[len(texts)] = " ".join(words)
            words[rng.randrange(len(words))] = f"n{rng.randrange(9)}"
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    prints = {d: plain_simhash(t) for d, t in texts.items()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    expected = roots(near, prints)
    found = simhash.near_duplicates(table).collect()
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in found} == prints
    assert {r.doc_id: r.component_id for r in found} == expected


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    pairs += [(200 + rng.randrange(80), 200 + rng.randrange(80)) for _ in range(60)]
    rng.shuffle(pairs)
    edges = spark.createDataFrame(pairs, "a long, b long")
    nodes = {n for pair in pairs if pair[0] != pair[1] for n in pair}
    expected = {n: r for n, r in roots(pairs, nodes).items() if n != r}
    assert {r.node: r.root for r in components.components(edges).collect()} == expected


def test_packing_balances_and_keeps_groups(spark, docs):
    found = shards.op9_vector_packing(spark, SF).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() / sizes.min() < 1.25
    found["text"] = found["doc_id"].map(docs)
    assert (found.groupby("text")["shard"].nunique() == 1).all()
    assert found["size"].sum() == sum(len(t.encode()) + 1 for t in docs.values())


def test_hot_groups_are_split(spark):
    table = spark.createDataFrame(
        [(i, "same" if i % 3 else f"text {i}") for i in range(900)], "doc_id long, text string"
    )
    counts = shards.pack(table).toPandas().groupby("shard")["doc_id"].count()
    assert counts.max() - counts.min() < 40


def test_maximal_segments():
    def slow(scores):
        """All maximal segments by the recursive definition."""
        best = max(((sum(scores[i:j]), i - j, i, j) for i in range(len(scores))
                    for j in range(i + 1, len(scores) + 1)), default=None)
        if not best or best[0] <= 0:
            return []
        _, _, i, j = best
        return slow(scores[:i]) + [(i, j)] + [(a + j, b + j) for a, b in slow(scores[j:])]

    rng = random.Random(7)
    for _ in range(300):
        # Distinct powers keep sums from tying.
        scores = [rng.choice([-1, 1]) * rng.random() for _ in range(rng.randrange(12))]
        total = [0.0]
        for s in scores:
            total.append(total[-1] + s)
        rises = [(i, total[i], total[i + 1]) for i, s in enumerate(scores) if s > 0]
        assert [(s, e) for s, e, _ in toxicity.maximal_segments(iter(rises))] == slow(scores)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in read(spark, sf, "documents").collect()}
    held = langid.op8_language_filters(spark, sf).filter("held_out").collect()
    right = [r.lang_pred == truth[r.doc_id] for r in held if truth[r.doc_id]]
    assert np.mean(right) > 0.97
    toxic = {r.doc_id: r.toxic for r in read(spark, sf, "labels").collect()}
    scored = [r for r in toxicity.op10_toxic_segments(spark, sf).collect() if r.doc_id in toxic]
    held = [r.predicted == toxic[r.doc_id] for r in scored if r.held_out]
    assert np.mean(held) > 0.9


def test_classifiers_keep_good_and_reject_poor(spark):
    from tidemark.llm import grade

    sf = "/root/testdata/sf0.01"
    quality = {r.doc_id: r.quality for r in read(spark, sf, "labels").collect()}
    for query in (grade.op7_ordinal_quality, rules.op1_isolation_rules):
        kept = {r.doc_id: r.kept for r in query(spark, sf).collect()}
        good = [kept[d] for d, q in quality.items() if q == 1]
        poor = [kept[d] for d, q in quality.items() if q == 0]
        assert np.mean(good) > 0.9 and np.mean(poor) < 0.15
