"""Language identification by language-bitmask filters over character n-grams.

One bit-sliced Bloom filter holds the n-grams of all languages: a slot is a mask with
one bit per language, and the AND of an n-gram's slots names every language that
contains it. Per-language popcounts over a text, corrected for false positives, decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import (
    blocks,
    by_block,
    is_held_out,
    read,
    sampled_texts,
    stored,
    stratified_ids,
    texts_of,
)

SLOTS = 1 << 19
GRAMS = (2, 3, 4)  # bytes of lower-case UTF-8
# Bound of the fitting sample: documents per language.
SAMPLE_PER_LANGUAGE = 2000
# An n-gram belongs to a language if it is this frequent there, and at least this
# fraction as frequent as in the language where it is most frequent. The first bounds
# the n-grams per language and length to its inverse.
MIN_RATE = 2e-5
MIN_OF_TOP = 0.3
BITS = 64  # languages per mask

UNDETERMINED = "und"

# ASCII other than letters separates; bytes of other characters are kept.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
# Any byte that can start or continue a letter.
_MAYBE_LETTER = np.array([c >= 128 or 97 <= c <= 122 or 65 <= c <= 90 for c in range(256)])


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of lower-case texts, and the text of each."""
    parts = [b" " + t.translate(_LETTERS) + b" " for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    text_of = np.repeat(np.arange(len(parts)), sizes)
    wide = data.astype(np.uint64)
    hashes, owners = [], []
    for n in GRAMS:
        packed = np.zeros(max(len(data) - n + 1, 0), np.uint64)
        for i in range(n):
            packed = (packed << np.uint64(8)) | wide[i : len(data) - n + 1 + i]
        inside = text_of[n - 1 :] == text_of[: len(data) - n + 1]
        # Two blanks in a row say nothing.
        blank = packed & np.uint64(0xFFFF) == np.uint64(0x2020)
        use = inside & ~blank
        hashes.append(tokens.mix(packed[use] + np.uint64(n << 56)))
        owners.append(text_of[: len(inside)][use])
    return np.concatenate(hashes), np.concatenate(owners)


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (
        (hashes % np.uint64(SLOTS)).astype(np.int64),
        ((hashes >> np.uint64(32)) % np.uint64(SLOTS)).astype(np.int64),
    )


@dataclass
class BitmaskFilters:
    languages: list[str]
    masks: np.ndarray  # (planes, SLOTS); a plane has BITS languages
    false_rate: np.ndarray

    @classmethod
    def build(cls, languages: list[str], language: np.ndarray, hashes: np.ndarray) -> BitmaskFilters:
        planes = max(1, -(-len(languages) // BITS))
        masks = np.zeros((planes, SLOTS), np.uint64)
        fill = np.zeros(len(languages))
        for i in range(len(languages)):
            own = np.zeros(SLOTS, bool)
            for slots in _slots(hashes[language == i]):
                own[slots] = True
            masks[i // BITS] |= own.astype(np.uint64) << np.uint64(i % BITS)
            fill[i] = own.mean()
        return cls(languages, masks, fill**2)

    def hits(self, texts: list[bytes]) -> np.ndarray:
        """Share of each text's n-grams in each language, less the false positives."""
        hashes, text_of = grams(texts)
        one, two = _slots(hashes)
        n = np.bincount(text_of, minlength=len(texts)).astype(float)
        found = np.zeros((len(texts), len(self.languages)))
        for plane, mask in enumerate(self.masks):
            both = mask[one] & mask[two]
            for i in range(plane * BITS, min((plane + 1) * BITS, len(self.languages))):
                bit = (both >> np.uint64(i % BITS)) & np.uint64(1)
                found[:, i] = np.bincount(text_of, bit, len(texts))
        rate = self.false_rate[None, :]
        return np.maximum(found / np.maximum(n, 1)[:, None] - rate, 0) / (1 - rate)


def fit(sample: DataFrame) -> BitmaskFilters:
    """Filters from a stored sample (text, label); counting is done by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = texts_of(batch, lower=True), batch.column("label").to_pylist()
            for language in sorted(set(labels)):
                own = [t for t, label in zip(texts, labels) if label == language]
                for start, end in blocks(own):
                    hashes, n = np.unique(grams(own[start:end])[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([language] * len(n)), pa.array(hashes.view(np.int64)), pa.array(n)],
                        names=["label", "gram", "n"],
                    )

    counted = sample.mapInArrow(count, "label string, gram long, n long")
    counts = stored(counted.groupBy("label", "gram").agg(F.sum("n").alias("n")), "langid-counts")
    totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "label").select(
        "label", "gram", (F.col("n") / F.col("total")).alias("rate")
    )
    top = F.max("rate").over(Window.partitionBy("gram"))
    kept = (
        rates.filter(F.col("rate") >= MIN_RATE / len(GRAMS))
        .withColumn("top", top)
        .filter(F.col("rate") >= MIN_OF_TOP * F.col("top"))
        .select("label", "gram")
        .toPandas()
    )
    languages = sorted(r[0] for r in totals.select("label").collect())
    numbers = {name: i for i, name in enumerate(languages)}
    return BitmaskFilters.build(
        languages,
        kept["label"].map(numbers).to_numpy(int),
        kept["gram"].to_numpy(np.int64).view(np.uint64),
    )


def has_letter(text: bytes) -> bool:
    if not _MAYBE_LETTER[np.frombuffer(text, np.uint8)].any():
        return False
    return any(map(str.isalpha, text.decode()))


def identify(docs: DataFrame, learn_from: Column | None = None) -> DataFrame:
    """doc_id, lang_pred and score (share of the winner among all languages' hits).

    Languages are those of the labelled rows (``lang`` not NULL) where ``learn_from``
    holds; the filters are fitted on at most SAMPLE_PER_LANGUAGE documents of each. A
    text that is NULL or has no letter is ``und`` with score 0; ties, also of texts that
    hit no language, go to the first language by name; without a labelled row every
    text is ``und``. Repeated rows are judged alike; an empty table gives no rows;
    columns other than doc_id, text and lang are ignored, and lang is only learned from.
    Texts of any length are judged whole.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    ids = stratified_ids(known.select("doc_id", "lang"), "lang", SAMPLE_PER_LANGUAGE)
    filters = fit(sampled_texts(docs, ids, "langid-sample"))

    def judge(texts: list[bytes]) -> dict[str, object]:
        named = np.array([bool(filters.languages) and has_letter(t) for t in texts], bool)
        if not filters.languages:
            return {"lang_pred": [UNDETERMINED] * len(texts), "score": np.zeros(len(texts))}
        hits = filters.hits(texts)
        best = hits.argmax(1)
        total = hits.sum(1)
        share = hits[np.arange(len(texts)), best] / np.where(total > 0, total, 1)
        names = np.array(filters.languages, object)[best]
        names[~named] = UNDETERMINED
        return {"lang_pred": names.tolist(), "score": np.where(named, share, 0.0)}

    return by_block(docs, judge, "lang_pred string, score double", lower=True)


def op8_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, ~is_held_out(4, 2))
    return found.select("doc_id", is_held_out(4, 2).alias("held_out"), "lang_pred", "score")
