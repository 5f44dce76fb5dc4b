"""Files dropped into a folder, each taken exactly once."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import CORRUPT, with_corrupt
from ..session import shared_dir
from ..sources.files import CSV_DIALECT, MOMENTS, check_whole_record
from ..sources.versions import count_files, remove_folder


def files_per_batch(
    spark: SparkSession, folder: str, least: int, batches: int, only: str = "*.csv"
) -> int:
    """Files per micro-batch for what waits in a folder now: ``least``, or as many more as
    take it all in ``batches`` micro-batches.

    A micro-batch has a price of its own, and an upsert may rewrite the whole state, so
    with a fixed number of files the price of catching up grows with the square of the
    files. The files are listed, not opened.
    """
    return max(least, -(-count_files(spark, f"{folder}/{only}") // batches))


def drop_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    *,
    only: str = "*.csv",
    files_per_batch: int | None = None,
    header: bool = True,
) -> DataFrame:
    """Rows of the CSV files that appear in a folder. A header alone adds nothing.

    The corrupt-record column holds a record with too few or too many fields, or with a
    field that does not fit its type; it is NULL for a sound record.
    """
    reader = (
        spark.readStream.schema(with_corrupt(schema))
        .options(**CSV_DIALECT)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", only)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return check_whole_record(reader.csv(folder))


def land_drops(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    fmt: str = "csv",
    timeout: float | None = None,
    quarantine: str | None = None,
) -> None:
    """Append everything that is there now to ``target`` and stop.

    The checkpoint remembers the files taken, so the next call reads only newer
    ones, also after a failure in between. Damaged records go to the parquet folder
    ``quarantine`` instead; without one, the first of them ends the run with an error.
    With ``timeout`` (seconds) a run that takes longer is stopped and raises.

    With a quarantine a micro-batch is parsed once, into a staged copy that both folders
    are written from. Each has a folder per micro-batch (``batch=<n>``), which a repeated
    one replaces: it adds nothing twice, wherever the first attempt ended.
    """
    damaged = F.col(CORRUPT).isNotNull()
    if quarantine is None:
        sound = F.assert_true(~damaged, F.concat(F.lit("damaged record: "), F.col(CORRUPT)))
        good = stream.filter(sound.isNull()).drop(CORRUPT)
        writer = good.writeStream.outputMode("append").format(fmt).options(**_options(fmt))
        writer = writer.option("path", target)
    else:
        writer = stream.writeStream.foreachBatch(
            lambda batch, number: _land(batch, number, target, quarantine, fmt)
        )
    query = (
        writer.option("checkpointLocation", f"{checkpoint}/landed")
        .trigger(availableNow=True)
        .start()
    )
    finish(query, timeout)


def _options(fmt: str) -> dict[str, str]:
    return {**CSV_DIALECT, **MOMENTS, "quoteAll": "true"} if fmt == "csv" else {}


def _land(batch: DataFrame, number: int, target: str, quarantine: str, fmt: str) -> None:
    """Write the sound and the damaged records of one micro-batch, from one parse."""
    spark = batch.sparkSession
    staging = shared_dir(spark, f"drops-{sha256(target.encode()).hexdigest()}", str(number))
    batch.write.mode("overwrite").parquet(staging)
    rows = spark.read.schema(batch.schema).parquet(staging)
    damaged = F.col(CORRUPT).isNotNull()
    folder = f"batch={number:012d}"
    rejected = rows.filter(damaged).select(CORRUPT)
    rejected.write.mode("overwrite").parquet(f"{quarantine}/{folder}")
    good = rows.filter(~damaged).drop(CORRUPT).write.mode("overwrite")
    good.format(fmt).options(**_options(fmt)).save(f"{target}/{folder}")
    remove_folder(spark, staging)


def finish(query: StreamingQuery, timeout: float | None) -> None:
    """Wait for the end of a query; stop it and raise when that takes too long."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.id} was stopped after {timeout} s")
