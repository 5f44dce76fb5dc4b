"""Every micro-batch merged into a stored state."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.latest import keep_latest
from ..operators.quality import has_values
from ..schemas import CORRUPT
from ..session import shared_dir
from ..sources.versions import (
    PART_BYTES,
    drop_old_states,
    load_state,
    merge_parts,
    read_parts,
    remove_folder,
)
from .drops import finish

# merge(state, batch)
Merge = Callable[[DataFrame, DataFrame], DataFrame]

# Earlier states that stay after a micro-batch, for readers that still use them.
STATES_KEPT = 2


def read_stream_state(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The state as the last finished micro-batch left it."""
    return read_parts(spark, root, load_state(spark, root), schema)


def upsert_stream(
    stream: DataFrame,
    state_root: str,
    schema: T.StructType,
    merge: Merge,
    *,
    key: str,
    version: str,
    ties: Sequence[str] = (),
    checkpoint: str,
    timeout: float | None = None,
    quarantine: str | None = None,
    part_bytes: int = PART_BYTES,
) -> None:
    """Merge all data available now into the state under ``state_root`` and stop.

    ``merge(state, batch)`` is one of the batch upserts; it gets the newest row per key
    of the micro-batch, and the parts of the state with those keys, which alone are
    rewritten. Micro-batch *n* starts from the newest state before *n* and writes state
    *n*, so a repeated one gives the same state again; old states are dropped.

    Damaged records and rows without a key are not merged; the damaged ones go to
    ``quarantine`` (a folder per micro-batch) if that is given.
    """

    staging = f"upserts-{sha256(state_root.encode()).hexdigest()}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def staged(df: DataFrame, name: str) -> DataFrame:
            path = shared_dir(spark, staging, str(batch_id), name)
            df.write.mode("overwrite").parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        rows = staged(batch, "rows")
        if CORRUPT in rows.columns:
            damaged = F.col(CORRUPT).isNotNull()
            if quarantine:
                rejected = rows.filter(damaged).select(CORRUPT)
                rejected.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id:012d}")
            rows = rows.filter(~damaged).drop(CORRUPT)
        newest = staged(keep_latest(has_values(rows, key), key, version, ties), "newest")
        base = load_state(spark, state_root, lambda number: number < batch_id)
        merge_parts(spark, state_root, batch_id, newest, key, merge, base, schema, part_bytes)
        drop_old_states(spark, state_root, STATES_KEPT)
        remove_folder(spark, shared_dir(spark, staging, str(batch_id)))

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)
