"""Toxicity by maximum-scoring segments.

Each token scores its log-odds between toxic and other documents under a Dirichlet
prior, shrunk by its standard error, less a drift that makes ordinary text negative.
A linear scan finds all maximal-scoring segments of a text. Their scores are
calibrated by the extreme-value law of ordinary texts of the same length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
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

BUCKETS = 1 << 18
# Bound of the fitting sample: documents per label.
SAMPLE_PER_LABEL = 4000
PRIOR_TOKENS = 20_000.0
STEM = 4  # first bytes of a word; they speak for words too rare to be learned
DRIFT = 0.5
SIGNIFICANT = 0.01
NOTABLE = 1.0  # surprises below this do not count towards a text's total
MAX_SURPRISE = 60.0

# ASCII letters and digits in lower case; other ASCII separates words.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 or c == 10 else 32
    for c in range(256)
)


def token_block(texts: list[bytes]) -> tuple[tokens.Block, np.ndarray]:
    """Words of the texts, and for each the bucket of the word and that of its stem."""
    block = tokens.Block([t.translate(_PLAIN) for t in texts])
    stem_ends = np.minimum(block.ends, block.starts + STEM)
    stems = tokens.span_hashes(block.data, block.starts, stem_ends, tokens.WORD_BASE)
    words = block.word_hashes() % np.uint64(BUCKETS)
    return block, np.column_stack([words, stems % np.uint64(BUCKETS) + np.uint64(BUCKETS)]).astype(
        np.int64
    )


@dataclass
class ToxicModel:
    """Token scores, the law of the best segment of ordinary texts, and its calibration."""

    scores: np.ndarray
    rate: float = 1.0
    mode: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    def segments(self, texts: list[bytes]) -> list[list[tuple[int, int, float]]]:
        """Maximal-scoring segments of each text: first word, end word, score."""
        block, buckets = token_block(texts)
        scores = self.scores[buckets].max(1) - DRIFT
        total = np.concatenate(([0.0], np.cumsum(scores)))
        places = np.flatnonzero(scores > 0)
        cuts = np.searchsorted(places, block.first)
        found = []
        for i in range(len(texts)):
            first = block.first[i]
            at = places[cuts[i] : cuts[i + 1]]
            rises = zip(at.tolist(), total[at].tolist(), total[at + 1].tolist())
            found.append([(s - first, e - first, v) for s, e, v in maximal_segments(rises)])
        return found

    def total_surprise(self, segments: list[tuple[int, int, float]], n_words: int) -> float:
        """Sum of the surprises of all segments that are not to be expected."""
        rated = [self.surprise(v, n_words) for *_, v in segments]
        return min(MAX_SURPRISE, sum(r for r in rated if r >= NOTABLE))

    def surprise(self, score: float, n_words: int) -> float:
        """-ln of the chance that an ordinary text of this length has such a segment."""
        x = self.rate * (score - self.mode) - np.log(max(n_words, 1))
        expected = np.exp(-min(max(x, -700.0), 700.0))  # segments expected by chance
        chance = -np.expm1(-min(expected, 700.0))
        return float(min(MAX_SURPRISE, -np.log(max(chance, 1e-300))))

    def probability(self, surprise: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * surprise + self.intercept, -40, 40)))


def maximal_segments(rises: Iterator[tuple[int, float, float]]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments from the positive tokens of a text, in linear time.

    A rise is (position, prefix sum before it, prefix sum after it). A segment on the
    stack is (start, end, sum before, sum after, nearest segment with a lower sum before).
    """
    stack: list[tuple[int, int, float, float, int]] = []
    for position, before, after in rises:
        start, end = position, position + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append((start, end, before, after, j))
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, high - low) for s, e, low, high, _ in stack]


def token_scores(counts: np.ndarray) -> np.ndarray:
    """Scores from the counts (2, 2 * BUCKETS) of words and stems under label 0 and 1.

    The Dirichlet prior spreads PRIOR_TOKENS over tokens by their overall share. A
    log-odds ratio within one standard error of 0 counts as 0.
    """
    scores = []
    for part in (counts[:, :BUCKETS], counts[:, BUCKETS:]):
        all_tokens = part.sum(0) + 0.5
        smooth = part + PRIOR_TOKENS * all_tokens / all_tokens.sum()
        rest = smooth.sum(1, keepdims=True) - smooth
        odds = np.log(smooth) - np.log(rest)
        ratio = odds[1] - odds[0]
        error = np.sqrt((1.0 / smooth).sum(0))
        scores.append(np.sign(ratio) * np.maximum(np.abs(ratio) - error, 0.0))
    return np.concatenate(scores)


def _token_counts(sample: DataFrame) -> np.ndarray:
    """Word and stem counts per label, summed by Spark; bounded by 4 * BUCKETS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2 * BUCKETS), np.int64)
        for batch in batches:
            texts = texts_of(batch)
            labels = np.array(batch.column("label").to_pylist(), np.int64)
            for start, end in blocks(texts):
                block, buckets = token_block(texts[start:end])
                of = labels[start:end][block.word_text()] * 2 * BUCKETS
                cells = (of[:, None] + buckets).ravel()
                counts += np.bincount(cells, minlength=4 * BUCKETS).reshape(2, -1)
        label, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (label, bucket, counts[label, bucket])],
            names=["label", "bucket", "n"],
        )

    found = sample.mapInArrow(run, "label long, bucket long, n long")
    table = found.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, 2 * BUCKETS))
    counts[table["label"].to_numpy(int), table["bucket"].to_numpy(int)] = table["n"]
    return counts


def fit(sample: DataFrame, share_toxic: float) -> ToxicModel:
    """Model from a stored sample (text, label); ``share_toxic`` is that of all labels."""
    model = ToxicModel(token_scores(_token_counts(sample)))

    def best(texts: list[bytes]) -> dict[str, object]:
        block, _ = token_block(texts)
        found = [[v for *_, v in s] for s in model.segments(texts)]
        return {
            "top": np.array([max(v, default=0.0) for v in found]),
            "values": pa.array(found, pa.list_(pa.float64())),
            "n_words": block.n_words.astype(np.int64),
        }

    ranked = by_block(
        sample.withColumn("doc_id", F.col("label").cast("long")), best,
        "top double, values array<double>, n_words long",
    ).toPandas()
    toxic = ranked["doc_id"].to_numpy(int) == 1
    top, n_words = ranked["top"].to_numpy(), ranked["n_words"].to_numpy()
    usual = ~toxic & (n_words > 0)
    if usual.sum() >= 2:
        # Gumbel law by moments; a text's length shifts it by ln(length) / rate.
        model.rate = float(np.pi / np.sqrt(6.0) / max(top[usual].std(), 0.5))
        shifted = top[usual] - np.log(n_words[usual]) / model.rate
        model.mode = float(shifted.mean() - np.euler_gamma / model.rate)
    surprise = np.array(
        [model.total_surprise([(0, 0, v) for v in vs], n) for vs, n in zip(ranked["values"], n_words)]
    )
    model.slope, model.intercept = _logistic(surprise, toxic)
    # The sample has other shares of the labels than the table.
    share = min(max(share_toxic, 1e-6), 1 - 1e-6)
    sampled = min(max(toxic.mean() if len(toxic) else share, 1e-6), 1 - 1e-6)
    model.intercept += np.log(share / (1 - share)) - np.log(sampled / (1 - sampled))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope (not negative) and intercept by Newton's method with a little ridge."""
    if not y.any() or y.all():
        return 0.0, 20.0 if len(y) and y.all() else -20.0
    design, beta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - 1e-3 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta += np.clip(step, -2.0, 2.0)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def toxic_passages(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None) -> DataFrame:
    """doc_id, score (0 to 1), predicted, n_passages, and passages: the significant
    segments as (start, end, score) in words of the text split at ASCII non-alphanumerics.

    Labels are learned from the rows where ``learn_from`` holds, from at most
    SAMPLE_PER_LABEL documents per label. A NULL or empty text has no segment and gets
    the score of the least toxic text. With no label, or one kind only, every score is
    that kind's. Repeated rows are judged alike; an empty table gives no rows; columns
    other than doc_id and text are ignored.
    """
    known = labels.filter("toxic IN (0, 1)").select("doc_id", "toxic")
    if learn_from is not None:
        known = known.filter(learn_from)
    known = stored(known, "toxic-labels")
    share = known.agg(F.avg("toxic")).first()[0]
    sample = sampled_texts(docs, stratified_ids(known, "toxic", SAMPLE_PER_LABEL), "toxic-sample")
    model = fit(sample, share or 0.0)

    def judge(texts: list[bytes]) -> dict[str, object]:
        block, _ = token_block(texts)
        surprise, passages = np.zeros(len(texts)), []
        for i, segments in enumerate(model.segments(texts)):
            n = int(block.n_words[i])
            rated = [(s, e, v, model.surprise(v, n)) for s, e, v in segments]
            surprise[i] = model.total_surprise(segments, n)
            passages.append([
                {"start": int(s), "end": int(e), "score": float(v)}
                for s, e, v, unlikely in rated if unlikely >= -np.log(SIGNIFICANT)
            ])
        score = model.probability(surprise)
        return {
            "score": score,
            "predicted": (score >= 0.5).astype(np.int32),
            "n_passages": np.array([len(p) for p in passages], np.int64),
            "passages": pa.array(passages, _PASSAGES),
        }

    schema = (
        "score double, predicted int, n_passages long, "
        "passages array<struct<start: int, end: int, score: double>>"
    )
    return by_block(docs, judge, schema)


_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def op10_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    found = toxic_passages(docs, labels, ~is_held_out(5, 0))
    return found.select(
        "doc_id", is_held_out(5, 0).alias("held_out"), "score", "predicted", "n_passages"
    )
