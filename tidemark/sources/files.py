"""CSV and JSON files, single and by folder, and drop-folder inspection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import decode_breaks
from ..schemas import CORRUPT, with_corrupt

# The dialect of the landed text files.
CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "escape": "\\"}
# Written with microseconds: the default keeps milliseconds only, and a mark
# taken from the source would then lie above the rows copied.
MOMENTS = {
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    only: str | None = None,
    multi_line: bool = False,
    coded_breaks: bool = False,
) -> DataFrame:
    """CSV files with a declared schema; unparsable records stay as text.

    Columns bind by position. ``path`` may hold wildcards; ``only`` restricts
    the scan to matching file names. ``multi_line`` is for line breaks inside
    quoted text; each file is then read by one task. ``coded_breaks`` is for
    files written by ``write_csv`` with that option.
    """
    reader = _permissive(spark, schema).options(**CSV_DIALECT).option("multiLine", multi_line)
    if only:
        reader = reader.option("pathGlobFilter", only)
    rows = check_whole_record(reader.csv(path))
    if coded_breaks:
        rows = rows.withColumns(
            {n: decode_breaks(n) for n in text_columns(rows) if n != CORRUPT}
        )
    return rows


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, multi_line: bool = False
) -> DataFrame:
    """JSON files with a declared schema; unparsable records stay as text.

    One record per line splits across tasks. ``multi_line`` is for documents
    that spread over lines; each file is then read by one task.
    """
    return check_whole_record(
        _permissive(spark, schema).option("multiLine", multi_line).json(path)
    )


def _permissive(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    return (
        spark.read.schema(with_corrupt(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def check_whole_record(df: DataFrame) -> DataFrame:
    """The same rows, parsed in full whatever columns a query goes on to use.

    Text readers convert, and so check, only the columns a query needs: a record
    with a bad price would count as corrupt in a query that reads the price and
    as sound in one that does not. This always-true condition needs them all.
    """
    smallest = F.lit(-(2**63)).cast("long")
    return df.filter(F.xxhash64(*df.columns) >= smallest)


def list_files(spark: SparkSession, folder: str, only: str = "*") -> DataFrame:
    """Files of a folder (path, name, length, modified) without opening them."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", only)
        .load(folder)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.substring_index("path", "/", -1).alias("name"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def file_row_counts(
    spark: SparkSession, folder: str, schema: T.StructType, only: str = "*.csv"
) -> DataFrame:
    """Listing of a drop folder with the data rows of each file; a header alone is 0."""
    # Counting needs no field of a record, so none is converted here.
    rows = (
        spark.read.schema(schema)
        .options(**CSV_DIALECT)
        .option("pathGlobFilter", only)
        .csv(folder)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return list_files(spark, folder, only).join(rows, "path", "left").fillna(0, ["n_rows"])


class Drops(NamedTuple):
    to_load: DataFrame
    empty: DataFrame


def split_drops(counts: DataFrame) -> Drops:
    """Files worth loading and files without rows. Nothing is deleted."""
    return Drops(counts.filter(F.col("n_rows") > 0), counts.filter(F.col("n_rows") == 0))
