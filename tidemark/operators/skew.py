"""A chain of joins on one key that stays balanced whatever a key's share of the rows.

Adaptive execution splits an oversized partition of a sort-merge join, but not the right
side of a left outer join, and not inside a chain of joins that share one shuffle. Here
every key whose joined rows exceed what a task should make is laid out as a grid of cells:
each input deals its rows of the key along its own dimension and repeats them along the
others, so every combination of rows meets in exactly one cell. Other keys have cell 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir

# Joined rows of one key that a single task can make comfortably.
ROWS_PER_TASK = 1_000_000

CELL = "_cell"


@dataclass(frozen=True)
class Side:
    """An input of the chain: its key, and columns that tell rows of one key apart.

    A side that is unique by its key need not be counted.
    """

    rows: DataFrame
    key: str
    apart: tuple[str, ...]
    unique: bool = False


def heavy_keys(sides: Sequence[Side], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys whose joined rows exceed ``rows_per_task``, with the cuts of every side.

    One count over the key columns of all sides, folded before its only shuffle; the
    product of a key's rows decides. The result (key, n_0, cuts_0, n_1, cuts_1, ...) is
    stored and joined, never collected, so there is no limit to the number of keys.
    """
    counted = reduce(
        DataFrame.unionByName,
        (
            side.rows.filter(F.col(side.key).isNotNull()).select(
                F.col(side.key).alias("key"),
                *(F.lit(int(i == j)).cast("long").alias(f"n_{j}") for j in range(len(sides))),
            )
            for i, side in enumerate(sides)
            if not side.unique
        ),
    )
    names = [f"n_{i}" for i in range(len(sides))]
    sums = counted.groupBy("key").agg(*(F.sum(n).alias(n) for n in names))
    rows = reduce(Column.__mul__, (F.greatest(F.col(n), F.lit(1)).cast("double") for n in names))
    found = sums.withColumn("_left", rows / rows_per_task).filter("n_0 > 0 AND _left > 1")
    for name in names:
        # Cut a side no finer than its rows, and leave the rest to the next one.
        cuts = F.least(F.ceil("_left"), F.greatest(F.col(name), F.lit(1)))
        found = found.withColumn(f"cuts_{name[2:]}", cuts).withColumn("_left", F.col("_left") / cuts)
    path = shared_dir(found.sparkSession, "heavy-keys", uuid4().hex)
    found.drop("_left").write.parquet(path)
    return found.sparkSession.read.parquet(path)


def in_cells(sides: Sequence[Side], heavy: DataFrame) -> list[DataFrame]:
    """The rows of each side with their cell, and the rows per side of a heavy key as
    ``_n_<side>`` on the first one (NULL for other keys).

    The cells are spread on the small side: a row of a heavy key is joined with the cells
    along its own dimension, and any other row passes the join as it is, in cell 0.
    """
    numbers = range(len(sides))
    grid, cell = heavy, F.lit(0).cast("long")
    for j in numbers:
        cuts = F.col(f"cuts_{j}")
        grid = grid.withColumn(f"at_{j}", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)))
        cell = cell * cuts + F.col(f"at_{j}")
    placed = []
    for i, side in enumerate(sides):
        own = grid.select(
            F.col("key").alias("_key"), F.col(f"cuts_{i}").alias("_cuts"),
            F.col(f"at_{i}").alias("_at"), cell.alias("_place"),
            *((F.col(f"n_{j}").alias(f"_n_{j}") for j in numbers) if i == 0 else ()),
        )
        mine = F.pmod(F.xxhash64(*side.apart), F.col("_cuts")) == F.col("_at")
        rows = side.rows.join(own, (F.col(side.key) == F.col("_key")) & mine, "left")
        name = CELL if i == 0 else f"{CELL}_{i}"
        rows = rows.withColumn(name, F.coalesce("_place", F.lit(0).cast("long")))
        placed.append(rows.drop("_key", "_cuts", "_at", "_place"))
    return placed


def join_all(
    sides: Sequence[Side], how: Sequence[str], heavy: DataFrame
) -> DataFrame:
    """The first side joined with each other one on its key, ``how`` inner or left.

    All joins have the same keys, so each side is shuffled once. A copy of a row that
    met nobody in its own cell is no unmatched row if its key has partners elsewhere.
    """
    first, *others = in_cells(sides, heavy)
    joined = first
    for i, (side, rows, kind) in enumerate(zip(sides[1:], others, how), start=1):
        rows = rows.withColumn(f"_hit_{i}", F.lit(True))
        on = (F.col(sides[0].key) == F.col(side.key)) & (F.col(CELL) == F.col(f"{CELL}_{i}"))
        joined = joined.join(rows, on, kind)
        if kind == "left":
            elsewhere = F.coalesce(F.col(f"_n_{i}") > 0, F.lit(False))
            joined = joined.filter(F.col(f"_hit_{i}").isNotNull() | ~elsewhere)
    names = [n for side in sides for n in side.rows.columns]
    return joined.select(*names)
