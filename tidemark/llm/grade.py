"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k) = sigmoid(w x - t_k): one weight per hashed text feature, shared by all
grades, and one ordered threshold per step between grades. The expected grade and the
tail probability of the lowest acceptable grade select documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from . import tokens
from .common import blocks, by_block, read, sampled_texts, stratified_ids, texts_of

FEATURES = 1 << 14
# Bound of the fitting sample: documents per grade.
SAMPLE_PER_GRADE = 2500
STEPS = 80
PENALTY = 1e-4
KEEP_AT = 0.5


def word_features(texts: list[bytes]) -> tuple[np.ndarray, tokens.Block]:
    """Two feature numbers per word, of the word and of its last three bytes."""
    block = tokens.Block(texts)
    ends = block.ends
    tails = tokens.span_hashes(
        block.data, np.maximum(block.starts, ends - 3), ends, tokens.WORD_BASE
    )
    words = block.word_hashes()
    return np.column_stack([words, tails]) % np.uint64(FEATURES), block


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per step between grades

    def exceedance(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """P(grade > k) of each text for every k, and its number of words."""
        features, block = word_features(texts)
        worth = self.weights[features.astype(np.int64)].sum(1)
        total = tokens.sums_between(worth, block.first) / np.sqrt(np.maximum(block.n_words, 1))
        return _sigmoid(total[:, None] - self.thresholds[None, :]), block.n_words


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit(
    rows: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray, n_grades: int
) -> OrdinalModel:
    """Maximum likelihood with a small ridge penalty, by Adam over the whole sample.

    ``rows`` ascends; it, ``features`` and ``values`` are the sparse matrix. Steps
    between thresholds are exponentials, so the thresholds stay ordered.
    """
    n, steps = len(grades), n_grades - 1
    at = np.searchsorted(rows, np.arange(n + 1))
    class_size = np.bincount(grades, minlength=n_grades)
    weight = (n / n_grades) / np.maximum(class_size, 1)[grades] / n
    shape = np.zeros(FEATURES + steps)
    shape[FEATURES] = -1.0
    first, second = np.zeros_like(shape), np.zeros_like(shape)
    for step in range(1, STEPS + 1):
        w, free = shape[:FEATURES], shape[FEATURES:]
        gaps = np.exp(free[1:])
        cuts = free[0] + np.concatenate(([0.0], np.cumsum(gaps)))
        eta = tokens.sums_between(w[features] * values, at)
        above = _sigmoid(eta[:, None] - cuts[None, :])
        padded = np.column_stack([np.ones(n), above, np.zeros(n)])
        slope = padded * (1 - padded)
        chance = np.maximum(
            padded[np.arange(n), grades] - padded[np.arange(n), grades + 1], 1e-9
        )
        low, high = slope[np.arange(n), grades], slope[np.arange(n), grades + 1]
        d_eta = -weight * (low - high) / chance
        d_cuts = np.zeros(steps)
        for k in range(steps):
            d_cuts[k] += (weight * low / chance)[grades == k + 1].sum()
            d_cuts[k] -= (weight * high / chance)[grades == k].sum()
        slopes = np.concatenate((
            np.bincount(features, d_eta[rows] * values, FEATURES) + PENALTY * w,
            [d_cuts.sum()],
            np.cumsum(d_cuts[::-1])[::-1][1:] * gaps,
        ))
        first = 0.9 * first + 0.1 * slopes
        second = 0.99 * second + 0.01 * slopes**2
        rate = 0.1 / (1 + step / STEPS)
        shape -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    free = shape[FEATURES:]
    return OrdinalModel(
        shape[:FEATURES].copy(), free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))
    )


def _sample_matrix(sample: DataFrame) -> tuple[np.ndarray, ...]:
    """Row numbers, features, values and grades of the stored sample, on the driver.

    Bounded by the sample: a row has at most FEATURES entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels = texts_of(batch), batch.column("label").to_pylist()
            for start, end in blocks(texts):
                features, block = word_features(texts[start:end])
                key = np.repeat(block.word_text(), 2) * FEATURES + features.ravel().astype(np.int64)
                cells, count = np.unique(key, return_counts=True)
                scale = np.sqrt(np.maximum(block.n_words, 1))[cells // FEATURES]
                at = np.searchsorted(cells // FEATURES, np.arange(end - start + 1))
                offsets = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(offsets, pa.array((cells % FEATURES).astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array((count / scale).astype(np.float32))),
                        pa.array(labels[start:end], pa.int32()),
                    ],
                    names=["features", "values", "grade"],
                )

    table = sample.mapInArrow(
        run, "features array<int>, values array<float>, grade int"
    ).toArrow()
    features = table.column("features").combine_chunks()
    lengths = np.diff(features.offsets.to_numpy())
    return (
        np.repeat(np.arange(len(lengths)), lengths),
        features.flatten().to_numpy().astype(np.int64),
        table.column("values").combine_chunks().flatten().to_numpy().astype(np.float64),
        table.column("grade").to_numpy().astype(np.int64),
    )


def fit_ratings(docs: DataFrame, ratings: DataFrame) -> Judge:
    """Judge fitted on at most SAMPLE_PER_GRADE rated documents of each grade."""
    clean = ratings.filter("grade >= 0").select("doc_id", F.col("grade").cast("int").alias("grade"))
    sample = sampled_texts(docs, stratified_ids(clean, "grade", SAMPLE_PER_GRADE), "grade-sample")
    rows, features, values, grades = _sample_matrix(sample)
    seen = np.unique(grades)
    if len(seen) < 2:
        return Judge(None, float(seen[0]) if len(seen) else 0.0)
    return Judge(fit(rows, features, values, grades, int(grades.max()) + 1))


@dataclass
class Judge:
    """A model, or the only grade there is when nothing can be learned."""

    model: OrdinalModel | None
    only: float = 0.0

    def __call__(self, texts: list[bytes], accept: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= accept) of each text."""
        if self.model is None:
            some = tokens.Block(texts).n_words > 0
            return np.where(some, self.only, 0.0), some * 1.0
        above, n_words = self.model.exceedance(texts)
        above[n_words == 0] = 0.0
        return above.sum(1), above[:, accept - 1].copy()


def grade_documents(docs: DataFrame, ratings: DataFrame, accept: int = 1) -> DataFrame:
    """doc_id, expected_grade, tail_prob = P(grade >= accept), and kept (at least 0.5).

    ``ratings`` has (doc_id, grade) with grades from 0 up; the model is fitted on a
    bounded sample of them (SAMPLE_PER_GRADE documents per grade), weighted so that
    each grade counts alike. A text without a word has expected grade and tail
    probability 0 and is rejected. If fewer than two grades are rated, nothing can be
    learned: every text with a word gets the only grade (or 0) and is kept. Repeated
    rows are judged alike; an empty table gives no rows; other columns are ignored; texts
    of any length are judged whole.
    """
    judge = fit_ratings(docs, ratings)

    def work(texts: list[bytes]) -> dict[str, object]:
        expected, tail = judge(texts, accept)
        return {"expected_grade": expected, "tail_prob": tail, "kept": tail >= KEEP_AT}

    return by_block(docs, work, "expected_grade double, tail_prob double, kept boolean")


def keep_graded(docs: DataFrame, ratings: DataFrame, accept: int = 1) -> DataFrame:
    """Rows of ``docs``, with all their columns, that :func:`grade_documents` keeps."""
    judge = fit_ratings(docs, ratings)

    @F.arrow_udf(BooleanType())
    def passes(text: pa.Array) -> pa.Array:
        texts = texts_of(pa.RecordBatch.from_arrays([text], names=["text"]))
        parts = [judge(texts[start:end], accept)[1] >= KEEP_AT for start, end in blocks(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return docs.filter(passes("text"))


def ratings_from_labels(labels: DataFrame) -> DataFrame:
    """Grade 0 for poor quality, 1 for good but toxic, 2 for good and not toxic."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, 2 - F.coalesce("toxic", F.lit(0)))
    return labels.select("doc_id", grade.cast("int").alias("grade")).filter("grade IS NOT NULL")


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return grade_documents(docs, ratings_from_labels(labels))
