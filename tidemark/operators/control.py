"""Control table of marks and the copy log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import log_time
from ..schemas import COPY_LOG, WATERMARK

# The relational tables under control and their first mark.
CONTROLLED = ("Customers", "Products", "Stores", "Orders", "OrderDetails")
SCHEMA_NAME = "sales"
DELTA_COLUMN = "ModifiedDate"
FIRST_MARK = datetime(1900, 1, 1)

# Fixed value: text reported for a failure without a recorded message.
NO_MESSAGE = "No error message available"


def watermark_seed(spark: SparkSession) -> DataFrame:
    """Control table as first created: one row per table, all at the first mark."""
    rows = [
        (i, name, SCHEMA_NAME, name.lower(), f"{name.lower()}.csv", DELTA_COLUMN, FIRST_MARK)
        for i, name in enumerate(CONTROLLED, start=1)
    ]
    return spark.createDataFrame(rows, WATERMARK)


def advance_watermarks(control: DataFrame, marks: DataFrame) -> DataFrame:
    """Control table with the marks of ``marks`` (TABLENAME, max) taken over.

    A table without a new mark, or with a NULL one, keeps its old mark.
    """
    return (
        control.alias("c")
        .join(marks.alias("m"), F.col("c.TABLENAME") == F.col("m.TABLENAME"), "left")
        .select(
            *(F.col(f"c.{n}") for n in control.columns if n != "LASTPROCESSEDVALUE"),
            F.coalesce("m.max", "c.LASTPROCESSEDVALUE").alias("LASTPROCESSEDVALUE"),
        )
    )


@dataclass(frozen=True)
class Copy:
    """Outcome of one copy. A failed one has an error and no counts."""

    table: str
    schema_name: str | None = None
    rows_read: int | None = None
    rows_copied: int | None = None
    error: str | None = None
    seconds: int | None = None
    at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


def copy_log(
    spark: SparkSession, copies: Sequence[Copy], schema: T.StructType = COPY_LOG, next_id: int = 1
) -> DataFrame:
    """Log rows, one per copy and numbered from ``next_id``.

    ``FEED_COPY_LOG`` leaves the schema name out. ``at`` is UTC; the log time is
    wall-clock time of the log zone.
    """
    rows = []
    for log_id, copy in enumerate(copies, start=next_id):
        row = {
            "ID": log_id,
            "TABLENAME": copy.table,
            "SCHEMANAME": copy.schema_name,
            "ROWREAD": copy.rows_read,
            "ROWCOPIED": copy.rows_copied,
            "ERRORMESSAGE": copy.error,
            "COPYDURATION": copy.seconds,
            "LOGTIME": copy.at,
        }
        rows.append(tuple(row[name] for name in schema.names))
    return spark.createDataFrame(rows, schema).withColumn("LOGTIME", log_time(F.col("LOGTIME")))


def failure_messages(log: DataFrame) -> DataFrame:
    """Table and message per log row, with a default where none was recorded."""
    return log.select(
        "TABLENAME", F.coalesce("ERRORMESSAGE", F.lit(NO_MESSAGE)).alias("ERRORMESSAGE")
    )
