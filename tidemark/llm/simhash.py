"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. One
differing bit changes one count by one, so fingerprints within d bits are within
Manhattan distance d of each other in the embedding. A grid range-join finds pairs
within that distance: the segments are dealt into d + 3 parts, of which at most d can
differ, so the pair shares the cell of some three whole parts. Pairs in a cell are
bounded by the Manhattan distance first and then verified on the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import read, prepare, stored, texts_of
from .components import components

MAX_BITS = 3
SHINGLE = 3
SEED = 42
EQUAL_PARTS = 3
# Larger cells are compared block by block, each pair of blocks in its own group.
CELL_BLOCK = 2048

_LOW = 0x5555555555555555


def fingerprint(text: bytes) -> int:
    """SimHash of the 3-word shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = max(len(words) - SHINGLE + 1, 1)
    begins, stops = (ends - sizes)[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[b:e], SEED) for b, e in zip(begins, stops)], np.uint64)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def simhash(text: pa.Array) -> pa.Array:
    values = np.array([fingerprint(t) for t in texts_of_array(text)], np.uint64)
    return pa.array(values.view(np.int64))


def texts_of_array(values: pa.Array) -> list[bytes]:
    return texts_of(pa.RecordBatch.from_arrays([values], names=["text"]))


def part_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Masks of the segments of every choice of EQUAL_PARTS parts out of all parts."""
    parts = np.array_split(np.arange(32), max_bits + EQUAL_PARTS)
    masks = [sum(3 << (2 * int(segment)) for segment in part) for part in parts]
    return [sum(chosen) for chosen in combinations(masks, EQUAL_PARTS)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def embedding(fp: Column) -> Column:
    """The 32 segment counts (0 to 2) of a fingerprint, two bits each."""
    first = fp.bitwiseAND(F.lit(_LOW))
    second = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(_LOW))
    return first.bitwiseXOR(second).bitwiseOR(F.shiftleft(first.bitwiseAND(second), 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed embeddings.

    Of two counts, the low bits differ alone for a step of one, the high bits alone
    for 0 against 2, and both for 1 against 2.
    """
    apart = a.bitwiseXOR(b)
    one = apart.bitwiseAND(F.lit(_LOW))
    two = F.shiftrightunsigned(apart, 1).bitwiseAND(F.lit(_LOW))
    return F.bit_count(one) + 2 * F.bit_count(two) - 2 * F.bit_count(one.bitwiseAND(two))


def grid_cells(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(grid, cell, fp): each fingerprint in its cell of every grid."""
    place = embedding(F.col("fp"))
    cells = [
        F.struct(F.lit(g).alias("grid"), place.bitwiseAND(F.lit(_signed(m))).alias("cell"))
        for g, m in enumerate(part_masks(max_bits))
    ]
    return classes.select("fp", F.inline(F.array(*cells)))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links between distinct fingerprints that join what is within ``max_bits``.

    Every linked pair is within the bound, and every pair within it is connected by
    links. Cells of two give their pair straight from the counting; in larger cells a
    spanning forest of the close pairs is enough, so a dense cell of n fingerprints
    gives fewer than n links instead of all pairs.
    """
    cells = grid_cells(fps, max_bits)
    counted = stored(
        cells.groupBy("grid", "cell")
        .agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
        .filter("n > 1"),
        "simhash-cells",
    )
    low, high = F.col("low"), F.col("high")
    two = counted.filter(
        (F.col("n") == 2)
        & (manhattan(embedding(low), embedding(high)) <= max_bits)
        & (F.bit_count(low.bitwiseXOR(high)) <= max_bits)
    ).select(low.alias("a"), high.alias("b"))
    blocks = F.ceil(F.col("n") / CELL_BLOCK).cast("int")
    large = counted.filter("n > 2").select("grid", "cell", blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("fp", "grid"), F.col("blocks")).cast("int")
    dealt = (
        cells.join(large, ["grid", "cell"])
        .select("grid", "cell", "fp", "blocks", block.alias("block"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "grid", "cell", F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"), "block", "fp",
        )
    )
    keys = ["grid", "cell", "i", "j"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy() for c in (*keys, "block", "fp")])
            if rest is not None:
                rows = np.concatenate((rest, rows))
            new = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            last = int(new[-1]) if len(new) else 0
            yield from _forests(rows[:last], new[:-1] if len(new) else new, max_bits)
            rest = rows[last:]
        if rest is not None and len(rest):
            yield from _forests(rest, np.array([], np.int64), max_bits)

    in_cells = (
        dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long")
    )
    return two.unionByName(in_cells).distinct()


def _forests(rows: np.ndarray, cuts: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    found = [spanning_links(g[:, 4] == g[:, 3], g[:, 4] == g[:, 2], g[:, 5], max_bits)
             for g in np.split(rows, cuts)]
    pairs = np.concatenate(found)
    yield pa.RecordBatch.from_arrays(
        [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"]
    )


def spanning_links(
    right: np.ndarray, left: np.ndarray, fps: np.ndarray, max_bits: int
) -> np.ndarray:
    """Links among the close pairs between the left and the right rows of a group,
    enough to connect them: a breadth-first search over rows not reached yet."""
    codes = fps.view(np.uint64)
    low = np.uint64(_LOW)
    places = (codes & low) + ((codes >> np.uint64(1)) & low)
    waiting = np.ones(len(codes), bool)
    out = []
    for seed in range(len(codes)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        todo = [seed]
        while todo:
            at = todo.pop()
            open_rows = np.flatnonzero(waiting)
            if not len(open_rows):
                break
            # Both sides of one block compare freely, two blocks only across.
            across = (left[at] & right[open_rows]) | (right[at] & left[open_rows])
            open_rows = open_rows[across]
            apart = places[open_rows] ^ places[at]
            one, two = apart & low, (apart >> np.uint64(1)) & low
            bound = (
                np.bitwise_count(one).astype(int)
                + 2 * np.bitwise_count(two)
                - 2 * np.bitwise_count(one & two).astype(int)
            )
            near = open_rows[bound <= max_bits]
            near = near[np.bitwise_count(codes[near] ^ codes[at]) <= max_bits]
            waiting[near] = False
            todo += near.tolist()
            out.append(np.column_stack([np.full(len(near), fps[at]), fps[near]]))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed) and component_id, the smallest doc_id reachable over links of
    at most ``max_bits`` differing bits.

    A NULL text or one without words has fingerprint 0 and is linked like any other.
    Equal fingerprints are one class from the start, so copies cost no pairs. Rows
    without doc_id take part, but name a component only if all its rows lack one (its id
    is then NULL). Repeated rows each get a row; an empty table gives none; columns
    other than doc_id and text are ignored. Texts of any length are hashed whole.
    """
    prepare(docs.sparkSession)
    marked = stored(docs.select("doc_id", simhash("text").alias("fp")), "simhash-prints")
    return marked.join(classes(marked, max_bits), "fp").select("doc_id", "fp", "component_id")


def classes(marked: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id), one row per distinct fingerprint of ``marked``."""
    distinct = stored(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct"
    )
    roots = components(stored(links(distinct.select("fp"), max_bits), "simhash-links"))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = (
        rooted.filter(F.col("root").isNotNull()).groupBy("root")
        .agg(F.min("first_id").alias("component_id"))
    )
    return rooted.join(least, "root").select("fp", "root", "component_id")


def keep_representatives(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row, with all columns, of each group of near-duplicates: that with the
    smallest doc_id, and of several such rows the one with the smallest digest. Of
    rows that agree in id and text one stays. A group without any doc_id keeps the row
    with the smallest digest.

    The fingerprint of a row is computed once; a row is found again by a digest of its id
    and text. Names of added columns are made up, so that none can clash.
    """
    prepare(docs.sparkSession)
    digest = F.sha2(F.to_json(F.struct("doc_id", "text")), 256)
    prints = docs.select("doc_id", digest.alias("digest"), simhash("text").alias("fp"))
    marked = stored(prints, "simhash-prints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest"))
    own = f"_digest_{uuid4().hex}"
    chosen = (
        marked.join(classes(marked, max_bits), "fp").groupBy("root").agg(first.alias("row"))
        .select(F.col("row.digest").alias(own))
    )
    # Rows that agree in id and text meet in the join, so the last step shuffles nothing.
    return docs.withColumn(own, digest).join(chosen, own).dropDuplicates([own]).drop(own)


def op6_simhash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
