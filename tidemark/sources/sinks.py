"""Writers: text files for the raw layer, tables for the others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import code_breaks
from .files import CSV_DIALECT, MOMENTS, text_columns

# Records of a compressed text file, which one task reads whole.
RECORDS_PER_FILE = 1_000_000


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    rows_per_file: int = 0,
    coded_breaks: bool = False,
    compressed: bool = False,
) -> int:
    """CSV folder with a header per file and all text quoted; the number of rows in it.

    ``rows_per_file`` starts a new file after that many rows (0: never). With
    ``coded_breaks`` a record never spans lines, whatever its texts hold, so that big
    files can be split; ``read_csv`` with the same option restores them. A ``compressed``
    file cannot be split, so it ends after RECORDS_PER_FILE rows if not before.
    """
    if coded_breaks:
        df = df.withColumns({n: code_breaks(n) for n in text_columns(df)})
    rows, written = _counted(df)
    if compressed:
        rows_per_file = min(rows_per_file or RECORDS_PER_FILE, RECORDS_PER_FILE)
    writer = rows.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    writer = writer.options(**CSV_DIALECT, **MOMENTS).option("quoteAll", True)
    writer.csv(path, compression="gzip" if compressed else "none")
    return written.get["rows"]


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """One JSON record per line, NULL fields left out; the number of records.

    The files are compressed, as the names of the fields come with every record, and end
    after RECORDS_PER_FILE records.
    """
    rows, written = _counted(df)
    writer = rows.write.mode(mode).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.options(**MOMENTS).json(path, compression="gzip")
    return written.get["rows"]


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a count of the rows as the writer takes them, the last step before it.
    A committed write has them all, so nothing need be read back to count it."""
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")), written


def overwrite_table(
    df: DataFrame,
    name: str,
    *,
    partition_by: Sequence[str] = (),
    bucket_by: str | None = None,
    buckets: int = 0,
) -> None:
    """Replace a table, schema included.

    Bucketing by a unique key lets later merges on it read the stored side in
    place. Do not bucket by a key that one value can dominate: a bucket is
    always one task.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def quarantine(bad: DataFrame, path: str) -> None:
    """Append rejected records (key, record, time) to their parquet folder."""
    bad.write.mode("append").parquet(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Create an empty parquet table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
