"""Incremental pull of relational tables and full pull of feeds into raw files."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from functools import partial
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.control import Copy, advance_watermarks, copy_log
from ..operators.increment import pull_increment
from ..schemas import COPY_LOG, FEED_COPY_LOG
from ..session import run_together
from ..sources.sinks import write_csv, write_json
from ..sources.versions import remove_folder

# The feeds.
FEEDS = ("inventory", "payment", "shipping")


class IngestResult(NamedTuple):
    paths: dict[str, str]
    audit: DataFrame
    control: DataFrame | None


def batch_folder(root: str, folder: str, batch: int) -> str:
    return f"{root}/{folder}/batch={batch:012d}"


def ingest_increments(
    spark: SparkSession,
    control: DataFrame,
    read: Callable[[str, str], DataFrame],
    raw_root: str,
    batch: int,
    next_log_id: int = 1,
) -> IngestResult:
    """Copy what is new in every controlled table to CSV and move its mark.

    ``read(schema, table)`` opens a source, which is scanned once: the new mark is the
    highest value among the rows as they are copied, so it never lies above a row that was
    not. A failed table is logged, keeps its mark, and does not stop the others. Only the
    control table (one row per source) reaches the driver; all rows move in Spark jobs.
    Running a batch again replaces its files. The files are compressed and have coded line
    breaks (see ``write_csv``).
    """

    def copy(row: Row) -> tuple[Copy, object, str]:
        column, last = row.DELTACOL, row.LASTPROCESSEDVALUE
        path = batch_folder(raw_root, row.FOLDERNAME, batch)
        started = time.monotonic()
        mark = None
        try:
            news = pull_increment(read(row.SCHEMANAME, row.TABLENAME), column, last)
            outcome, mark = _copy(news, path, write_coded_csv, F.max(column))
            if mark is None:
                remove_folder(spark, path)  # nothing is new
        except Exception as error:  # any source or sink failure belongs in the log
            outcome = {"error": str(error)}
        seconds = int(time.monotonic() - started)
        return Copy(row.TABLENAME, row.SCHEMANAME, seconds=seconds, **outcome), mark, path

    done = run_together(spark, (partial(copy, row) for row in control.collect()))
    moved = [(entry.table, mark) for entry, mark, _ in done if mark is not None]
    mark_type = control.schema["LASTPROCESSEDVALUE"].dataType.simpleString()
    marks = spark.createDataFrame(moved, f"TABLENAME string, max {mark_type}")
    return IngestResult(
        {entry.table: path for entry, mark, path in done if mark is not None},
        copy_log(spark, [entry for entry, _, _ in done], COPY_LOG, next_log_id),
        advance_watermarks(control, marks),
    )


def ingest_feeds(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    raw_root: str,
    batch: int,
    feeds: Iterable[str] = FEEDS,
    next_log_id: int = 1,
) -> IngestResult:
    """Copy every feed in full to JSON lines; failures are logged per feed."""

    def copy(name: str) -> tuple[Copy, str]:
        started = time.monotonic()
        path = batch_folder(raw_root, name, batch)
        try:
            outcome, _ = _copy(read(name), path, write_json)
        except Exception as error:  # as above
            outcome = {"error": str(error)}
        return Copy(name, seconds=int(time.monotonic() - started), **outcome), path

    done = run_together(spark, (partial(copy, name) for name in feeds))
    return IngestResult(
        {entry.table: path for entry, path in done if entry.error is None},
        copy_log(spark, [entry for entry, _ in done], FEED_COPY_LOG, next_log_id),
        None,
    )


def _copy(
    df: DataFrame,
    path: str,
    write: Callable[[DataFrame, str], int],
    mark: Column | None = None,
) -> tuple[dict[str, int], object]:
    """Rows that left the source and rows that reached the writer, and the ``mark`` over
    the former; all counted while they are copied."""
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("rows")]
    if mark is not None:
        wanted.append(mark.alias("mark"))
    copied = write(df.observe(seen, *wanted), path)
    return {"rows_read": seen.get["rows"], "rows_copied": copied}, seen.get.get("mark")


def write_coded_csv(df: DataFrame, path: str) -> int:
    return write_csv(df, path, coded_breaks=True, compressed=True)


class IngestFailed(RuntimeError):
    """Raised after logging when a table or feed could not be copied."""


def require_success(*audits: DataFrame) -> None:
    failed = [
        f"{row.TABLENAME}: {row.ERRORMESSAGE}"
        for audit in audits
        for row in audit.filter("ERRORMESSAGE IS NOT NULL").collect()
    ]
    if failed:
        raise IngestFailed("; ".join(failed))
