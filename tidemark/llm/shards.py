"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Documents with equal texts form a group. Groups are placed one after another, the
largest first, each into the shard where the dot product of its size vector with the
residual capacity is highest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, stored

SHARDS = 8
# Groups below 1 / BUNDLES of every total are placed in bundles, by a hash of their
# text: at most BUNDLES bundles and 3 * BUNDLES larger groups reach the driver.
BUNDLES = 4096
# Groups above a shard's share of a total are placed in slices of 1 / SLICES of it.
SLICES = 64
ROWS_PER_RANK = 20_000

DIMENSIONS = ("size", "tokens", "rows")


def sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.lit(1).cast("long").alias("rows"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.md5(F.encode(text, "UTF-8")).alias("group"),
    )


@dataclass
class Packing:
    """Residual capacities of the shards, as shares of an even share."""

    shards: int

    def __post_init__(self) -> None:
        self.residual = np.ones((self.shards, len(DIMENSIONS)))

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Shard of each vector (shares of an even share), the largest placed first."""
        chosen = np.zeros(len(vectors), np.int64)
        for i in np.lexsort((np.arange(len(vectors)), -vectors.sum(1))):
            shard = int(np.argmax(self.residual @ vectors[i]))
            self.residual[shard] -= vectors[i]
            chosen[i] = shard
        return chosen


def pack(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document with its size, shard and slot in the shard.

    Equal texts share a shard unless they exceed a shard's share of a total, as such a
    group would upset the balance; then its rows are dealt in slices. Slots count from 0
    without a gap, in two steps: ranks in parts of a shard, then the parts' offsets. Both
    deal by a stored row number, so rows without doc_id or with one that others have too
    are spread like any other. A NULL text has size 1, no tokens, and is grouped with the
    empty text; repeated rows get a slot each; an empty table gives no rows; other columns
    are ignored. Of a text of any length only its sizes and digests are kept.
    """
    spark = docs.sparkSession
    rows = stored(sized(docs), "shards-sized")
    total = rows.agg(*(F.sum(d).alias(d) for d in DIMENSIONS)).first()
    totals = [max(total[d] or 0, 1) for d in DIMENSIONS]
    groups = rows.groupBy("group").agg(*(F.sum(d).alias(d) for d in DIMENSIONS))
    share = F.greatest(*(F.col(d) / t for d, t in zip(DIMENSIONS, totals)))
    large = stored(
        groups.withColumn("share", share).filter(F.col("share") * BUNDLES > 1), "shards-large"
    )
    slices = F.when(
        F.col("share") * shards > 1, F.ceil(F.col("share") * SLICES).cast("int")
    ).otherwise(1)
    bundle = F.pmod(F.xxhash64("group"), F.lit(BUNDLES))
    small = groups.withColumn("share", share).filter(F.col("share") * BUNDLES <= 1)
    bundles = small.groupBy(bundle.alias("bundle")).agg(*(F.sum(d).alias(d) for d in DIMENSIONS))
    units = [
        (f"b{r['bundle']}", 0, *(r[d] / t for d, t in zip(DIMENSIONS, totals)))
        for r in bundles.orderBy("bundle").collect()
    ]
    for r in large.withColumn("slices", slices).orderBy("group").collect():
        part = [r[d] / t / r["slices"] for d, t in zip(DIMENSIONS, totals)]
        units += [(r["group"], k, *part) for k in range(r["slices"])]
    vectors = np.array([u[2:] for u in units], float).reshape(-1, len(DIMENSIONS)) * shards
    placed = Packing(shards).place(vectors)
    where = spark.createDataFrame(
        [(u[0], u[1], int(s)) for u, s in zip(units, placed)], "unit string, slice int, shard int"
    )
    # Both tables are bounded by BUNDLES and SLICES, whatever the input.
    cut = large.select("group", slices.alias("slices"))
    dealt = (
        rows.join(F.broadcast(cut), "group", "left")
        .select(
            "row", "doc_id", "size", "text_crc32",
            F.when(F.col("slices").isNull(), F.concat(F.lit("b"), bundle.cast("string")))
            .otherwise(F.col("group")).alias("unit"),
            F.coalesce(F.pmod(F.xxhash64("row", F.lit(5)), F.col("slices")), F.lit(0))
            .cast("int").alias("slice"),
        )
        .join(F.broadcast(where), ["unit", "slice"])
        .select("row", "doc_id", "size", "text_crc32", "shard")
    )
    return with_slots(stored(dealt, "shards-dealt"), total["rows"] or 0)


def with_slots(dealt: DataFrame, rows: int) -> DataFrame:
    parts = max(16, -(-rows // ROWS_PER_RANK))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row", F.lit(9)), F.lit(parts)))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("shard", "part").orderBy("row")
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") + F.col("offset")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
