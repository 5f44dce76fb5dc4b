"""The ordinal classifier and the language filters against plain formulas and on rows
they were not fitted on."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm import grade, langid
from tidemark.llm.common import is_held_out, read

SF = "/root/testdata/sf0.01"


def graded(n, seed):
    """Texts of few words with a grade that depends on them, and some noise."""
    pick = random.Random(seed)
    good, bad, other = (
        [f"{kind}{i}" for i in range(20)] for kind in ("good", "bad", "word")
    )
    texts, grades = [], []
    for _ in range(n):
        words = [pick.choice(pick.choice([good, bad, other, other])) for _ in range(12)]
        worth = sum(w in good for w in words) - sum(w in bad for w in words)
        texts.append(" ".join(words).encode())
        grades.append(0 if worth + pick.gauss(0, 0.5) < -1 else 2 if worth > 1 else 1)
    return texts, np.array(grades)


def matrix(texts):
    """Rows, features and values as plain loops over the words give them."""
    rows, features, values = [], [], []
    for i, text in enumerate(texts):
        counts: dict[int, int] = {}
        own, _ = grade.word_features([text])
        for pair in own.tolist():
            for feature in pair:
                counts[feature] = counts.get(feature, 0) + 1
        for feature, count in sorted(counts.items()):
            rows.append(i)
            features.append(feature)
            values.append(count / math.sqrt(len(text.split())))
    return np.array(rows), np.array(features, np.int64), np.array(values)


def loss(model, texts, grades):
    """Mean penalised negative log-likelihood of the cumulative-link model, each grade
    counting alike, written out per text."""
    total, sizes = 0.0, np.bincount(grades, minlength=3)
    for text, g in zip(texts, grades):
        own, _ = grade.word_features([text])
        eta = sum(model.weights[int(f)] for pair in own for f in pair) / math.sqrt(len(own))
        above = [1.0, *(1 / (1 + math.exp(-(eta - t))) for t in model.thresholds), 0.0]
        total -= math.log(max(above[g] - above[g + 1], 1e-9)) / (3 * sizes[g])
    return total + grade.PENALTY / 2 * float((model.weights**2).sum())


@pytest.fixture(scope="module")
def fitted():
    texts, grades = graded(600, 1)
    return grade.fit(*matrix(texts), grades, 3), texts, grades


def test_the_fit_is_near_a_minimum_of_the_loss(fitted):
    model, texts, grades = fitted
    assert model.thresholds[0] < model.thresholds[1]
    best = loss(model, texts, grades)
    start = grade.OrdinalModel(np.zeros(grade.FEATURES), np.array([-1.0, 0.0]))
    assert best < 0.5 * loss(start, texts, grades)
    pick = np.random.default_rng(2)
    used = np.flatnonzero(model.weights)
    for _ in range(6):
        step = np.zeros(grade.FEATURES)
        step[used] = pick.normal(0, 1.0, len(used))
        moved = grade.OrdinalModel(model.weights + step, model.thresholds + pick.normal(0, 0.5))
        assert loss(moved, texts, grades) > best


def test_expected_grade_and_tail_on_other_texts(fitted):
    model, _, _ = fitted
    texts, grades = graded(400, 9)
    above, n_words = model.exceedance(texts)
    for text, row in list(zip(texts, above))[:50]:
        own, _ = grade.word_features([text])
        eta = sum(model.weights[int(f)] for pair in own for f in pair) / math.sqrt(len(own))
        wanted = [1 / (1 + math.exp(-(eta - t))) for t in model.thresholds]
        assert np.allclose(row, wanted) and row[0] >= row[1]
    assert (n_words == 12).all()
    expected = above.sum(1)
    means = [expected[grades == g].mean() for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert ((expected > 1) == (grades > 1))[grades != 1].mean() > 0.9


def plain_grams(text):
    """Distinct byte n-grams of a lower-case text, with blanks for what is no letter."""
    raw = b" " + bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in text) + b" "
    found = []
    for n in langid.GRAMS:
        found += [raw[i : i + n] for i in range(len(raw) - n + 1) if raw[i + n - 2 : i + n] != b"  "]
    return found


def test_grams_are_those_of_plain_slices():
    texts = [b"", b"a", b"hello  world", "naïve café!".encode(), b"1234", b"ab ab ab"]
    hashes, owners = langid.grams(texts)
    for i, text in enumerate(texts):
        own = hashes[owners == i]
        wanted = plain_grams(text)
        assert len(own) == len(wanted) and len(set(own.tolist())) == len(set(wanted))


def test_filters_against_sets_of_grams():
    """Shares from the Bloom filters, less false positives, are those of exact sets."""
    pick = random.Random(4)
    alphabet = {"x": "abcdefg", "y": "efghijk", "z": "uvwxyz"}

    def text(name, n):
        return " ".join("".join(pick.choices(alphabet[name], k=5)) for _ in range(n)).encode()

    samples = {name: text(name, 400) for name in alphabet}
    learned = {name: set(plain_grams(sample)) for name, sample in samples.items()}
    hashes, owners = langid.grams(list(samples.values()))
    filters = langid.BitmaskFilters.build(list(samples), owners, hashes)
    tests = [text(name, 30) for name in alphabet] + [b"", b"qqq"]
    got = filters.hits(tests)
    for row, sample in zip(got, tests):
        own = plain_grams(sample)
        for share, name in zip(row, samples):
            wanted = sum(g in learned[name] for g in own) / max(len(own), 1)
            assert abs(share - wanted) < 0.02
    assert got[:3].argmax(1).tolist() == [0, 1, 2]


def test_languages_of_rows_held_out(spark):
    docs = read(spark, SF, "documents")
    found = langid.op8_language_filters(spark, SF)
    known = docs.select("doc_id", "lang", "text").join(found, "doc_id")
    rows = known.filter(is_held_out(4, 2) & known["lang"].isNotNull()).collect()
    rows = [r for r in rows if r.held_out and sum(map(str.isalpha, r.text or "")) >= 40]
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.95
