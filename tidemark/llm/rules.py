"""Quality rules judged by an isolation forest.

Every text gets the statistics of plain quality rules. A forest of random splits
isolates rows with unusual statistics after few splits; short average paths mark
anomalies. The cut between usual and anomalous is calibrated on labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import by_block, read, stored

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30

TREES = 128
ROWS_PER_TREE = 256
BINS = 2000

STATISTICS = (
    "word_length", "symbol_rate", "dup_line_rate", "repeat_rate",
    "upper_rate", "mark_rate", "distinct_rate",
)

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_MARKS = np.isin(np.arange(256), list(b"!?;:=~^@_/\\+{}[]()\""))


def statistics(texts: list[bytes]) -> dict[str, object]:
    """Counts and rates of the rules for a list of texts."""
    block = tokens.Block(texts)
    n, hashes, text_of = block.n_words, block.word_hashes(), block.word_text()
    salt = tokens.mix(text_of.astype(np.uint64) + np.uint64(1))
    first = block.windows(REPEAT_WINDOW)
    window = tokens.span_hashes(hashes, first, first + REPEAT_WINDOW, tokens.WORD_BASE)
    again = first[tokens.repeated(window ^ salt[first])]
    in_repeat = tokens.covered(again, REPEAT_WINDOW, len(hashes))
    by_text = np.sort(hashes ^ salt)
    # Distinct words of a text: the first of each run of equal (text, word) keys.
    order = np.argsort(hashes ^ salt)
    new = np.ones(len(hashes), bool)
    new[1:] = by_text[1:] != by_text[:-1]
    distinct = np.bincount(text_of[order[new]], minlength=len(texts))

    data = block.data
    word_chars = block.per_text(~block.blank & tokens.STARTS_CHAR[data])
    symbols = block.per_text(_SYMBOLS[data])
    dup_lines, lines = _lines(texts)
    repeats = tokens.sums_between(in_repeat, block.first)
    some = np.maximum(n, 1)
    chars = np.maximum(word_chars, 1)
    return {
        "n_words": n.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeats,
        "word_length": word_chars / some,
        "symbol_rate": symbols / some,
        "dup_line_rate": dup_lines / np.maximum(lines, 1),
        "repeat_rate": repeats / some,
        "upper_rate": block.per_text(_UPPER[data]) / chars,
        "mark_rate": block.per_text(_MARKS[data]) / some,
        "distinct_rate": distinct / some ** 0.9,
    }


def _lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word that equal an earlier line of the text, and lines with a word."""
    dup, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        lines = [line for line in text.split(b"\n") if line.strip()]
        total[i], dup[i] = len(lines), len(lines) - len(set(lines))
    return dup, total


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the rates of :data:`STATISTICS`, one row per document."""
    rates = ", ".join(f"{name} double" for name in STATISTICS)
    return by_block(docs, statistics, f"{COUNTS}, {rates}")


@dataclass
class IsolationForest:
    """Trees as flat arrays: a split column (-1 in a leaf), its value, the left child,
    and in leaves the path length with the usual correction for their rows."""

    column: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row: near 1 for short paths, at or below 0.5 for usual ones."""
        total = np.zeros(len(rows))
        for t in range(len(self.column)):
            node = np.zeros(len(rows), np.int64)
            while True:
                split = self.column[t][node]
                inner = split >= 0
                if not inner.any():
                    break
                right = rows[np.arange(len(rows)), np.maximum(split, 0)] >= self.value[t][node]
                node = np.where(inner, self.left[t][node] + right, node)
            total += self.path[t][node]
        return 2.0 ** (-total / max(len(self.column), 1) / max(_mean_path(ROWS_PER_TREE), 1e-9))


def _mean_path(n: int) -> float:
    """Average path of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    return 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def fit_forest(sample: np.ndarray, trees: int = TREES, seed: int = 0) -> IsolationForest:
    """Forest over consecutive parts of a shuffled sample, one part per tree."""
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(ROWS_PER_TREE)))
    size = 2 ** (depth + 1)
    column = np.full((trees, size), -1, np.int64)
    value, path = np.zeros((trees, size)), np.zeros((trees, size))
    left = np.zeros((trees, size), np.int64)
    for t in range(trees):
        used, todo = 1, [(0, rng.choice(len(sample), min(ROWS_PER_TREE, len(sample)), False), 0)]
        while todo:
            node, members, level = todo.pop()
            rows = sample[members]
            low, high = rows.min(0), rows.max(0)
            open_columns = np.flatnonzero(high > low)
            if level >= depth or not len(open_columns):
                path[t, node] = level + _mean_path(len(members))
                continue
            pick = rng.choice(open_columns)
            cut = rng.uniform(low[pick], high[pick])
            right = rows[:, pick] >= cut
            column[t, node], value[t, node], left[t, node] = pick, cut, used
            todo += [(used, members[~right], level + 1), (used + 1, members[right], level + 1)]
            used += 2
    return IsolationForest(column, value, left, path)


def calibrated_cut(counts: list[tuple[int, int, int]]) -> float:
    """Score at which most labelled rows of quality 0 and 1 are judged rightly.

    ``counts`` has (bin, quality, rows). Without rows of both qualities there is nothing
    to calibrate on and nothing is rejected.
    """
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for place, quality, rows in counts:
        (good if quality else bad)[place] += rows
    if not good.sum() or not bad.sum():
        return 1.0
    right = np.cumsum(good) - good + bad.sum() - (np.cumsum(bad) - bad)
    best = np.flatnonzero(right == right.max())
    return float(best[len(best) // 2]) / BINS


def isolation_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rule counts, the anomaly ``score``, and ``kept`` for every document.

    A document is kept if it passes the base rules (20 words, at most 30 % of words
    in repeated 8-word windows) and its score is below the calibrated cut. The
    forest is fitted on about TREES * ROWS_PER_TREE documents, those whose hashed ids lie
    in the share of the hash range that holds so many;
    the cut is calibrated on all labelled documents that pass the base rules. A NULL or empty text has no
    words and fails; repeated rows are judged alike, each on its own; an empty table
    gives an empty result. Columns other than doc_id and text are ignored.
    """
    stats = stored(rule_statistics(docs), "rules")
    usable = stats.filter(F.col("n_words") >= MIN_WORDS)
    share = min(1.0, TREES * ROWS_PER_TREE / max(usable.count(), 1))
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30))
    sample = (
        usable.filter(place < int(share * (1 << 30)))
        .select(*STATISTICS)
        .toPandas()
        .sort_values(list(STATISTICS))
    )
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in stats.schema)}, score double"
    if len(sample):
        forest = fit_forest(sample[list(STATISTICS)].to_numpy(float))
    else:
        forest = IsolationForest(*(np.zeros((0, 1)) for _ in range(4)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy() for c in STATISTICS])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(forest.scores(rows))], names=[*batch.schema.names, "score"]
            )

    scored = stats.mapInArrow(score, schema)
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )
    counts = (
        scored.filter(~failed)
        .select("doc_id", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
        .join(known, "doc_id")
        .groupBy("bin", "quality")
        .count()
        .collect()
    )
    cut = calibrated_cut([tuple(r) for r in counts])
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("score") < cut)).alias("kept"),
        "score",
    )


def op1_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
