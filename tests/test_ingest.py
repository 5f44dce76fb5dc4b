from __future__ import annotations

import datetime as dt
from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import (
    Copy,
    advance_watermarks,
    copy_log,
    failure_messages,
    high_water_mark,
    pull_increment,
    watermark_seed,
)
from tidemark.plans import ingest_feeds, ingest_increments
from tidemark.sources import read_csv, read_json, sinks

UTC = dt.timezone.utc
SOURCE = schemas._schema("ProductID long, ProductName string, Category string, Price double, "
                         "ModifiedDate timestamp")  # fmt: skip


def day(n):
    return dt.datetime(2026, 1, n, tzinfo=UTC)


def source(spark, *keyed_days):
    return spark.createDataFrame([(k, "n", "c", 1.0, day(d)) for k, d in keyed_days], SOURCE)


def test_seed(spark):
    seed = watermark_seed(spark)
    assert seed.schema == schemas.WATERMARK
    assert rows(seed, "ID", "TABLENAME", "FOLDERNAME", "FILENAME") == [
        (1, "Customers", "customers", "customers.csv"),
        (2, "Products", "products", "products.csv"),
        (3, "Stores", "stores", "stores.csv"),
        (4, "Orders", "orders", "orders.csv"),
        (5, "OrderDetails", "orderdetails", "orderdetails.csv"),
    ]
    marks = seed.select(F.col("LASTPROCESSEDVALUE").cast("string")).distinct()
    assert rows(marks) == [("1900-01-01 00:00:00",)]


def test_pull_is_above_the_old_and_up_to_the_new_mark(spark):
    df = source(spark, (1, 1), (2, 2), (3, 3), (4, 4))
    assert high_water_mark(df, "ModifiedDate").columns == ["max"]
    assert rows(pull_increment(df, "ModifiedDate", day(2)), "ProductID") == [(3,), (4,)]
    assert rows(pull_increment(df, "ModifiedDate", day(2), day(3)), "ProductID") == [(3,)]


def test_pull_reaches_the_scan(spark, tmp_path):
    source(spark, (1, 1)).write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    plan = pull_increment(df, "ModifiedDate", day(1), day(2))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ModifiedDate), GreaterThan(ModifiedDate" in plan


def test_marks_only_move_forward_on_news(spark):
    control = watermark_seed(spark)
    marks = spark.createDataFrame(
        [("Orders", day(5)), ("Stores", None)], "TABLENAME string, max timestamp"
    )
    moved = advance_watermarks(control, marks)
    assert moved.schema.names == control.schema.names
    changed = moved.filter("LASTPROCESSEDVALUE > '1950-01-01'")
    assert rows(changed, "TABLENAME", F.dayofmonth("LASTPROCESSEDVALUE")) == [("Orders", 5)]
    assert moved.count() == 5


def test_copy_log(spark):
    at = dt.datetime(2026, 7, 1, 12, tzinfo=UTC)
    log = copy_log(
        spark,
        [Copy("Orders", "sales", 3, 3, seconds=1, at=at), Copy("Stores", "sales", error="x" * 600,
                                                               at=at)],
        next_id=8,
    )
    assert log.schema.names == schemas.COPY_LOG.names
    assert rows(log, "ID", "TABLENAME", "ROWREAD", "ROWCOPIED", F.length("ERRORMESSAGE"),
                F.hour("LOGTIME")) == [
        (8, "Orders", 3, 3, None, 8), (9, "Stores", None, None, 600, 8),
    ]
    feed = copy_log(spark, [Copy("payment", at=at)], schemas.FEED_COPY_LOG)
    assert feed.schema.names == schemas.FEED_COPY_LOG.names
    assert rows(failure_messages(feed)) == [("payment", "No error message available")]


def test_increments_over_several_runs(spark, tmp_path):
    control = watermark_seed(spark).filter("TABLENAME in ('Products', 'Stores')")
    tables = {"Products": source(spark, (1, 1), (2, 2))}

    def read(schema, name):
        assert schema == "sales"
        return tables[name]

    first = ingest_increments(spark, control, read, str(tmp_path), 1)
    assert rows(first.audit, "ID", "TABLENAME", "ROWREAD", "ROWCOPIED") == [
        (1, "Products", 2, 2), (2, "Stores", None, None),
    ]
    assert "Stores" in first.audit.filter("ID = 2").first()["ERRORMESSAGE"]
    assert rows(first.control, "TABLENAME", F.year("LASTPROCESSEDVALUE")) == [
        ("Products", 2026), ("Stores", 1900),
    ]

    # Nothing new: nothing landed, the mark stays.
    idle = ingest_increments(spark, first.control, read, str(tmp_path), 2)
    assert idle.paths == {}
    assert rows(idle.audit.filter("TABLENAME = 'Products'"), "ROWCOPIED") == [(0,)]
    assert rows(idle.control) == rows(first.control)

    tables["Products"] = source(spark, (1, 1), (2, 2), (2, 5), (3, 3))
    tables["Stores"] = source(spark)
    second = ingest_increments(spark, first.control, read, str(tmp_path), 3, next_log_id=5)
    assert rows(second.audit, "ID", "TABLENAME", "ROWCOPIED") == [
        (5, "Products", 2), (6, "Stores", 0),
    ]
    landed = read_csv(spark, second.paths["Products"], SOURCE)
    assert rows(landed, "ProductID") == [(2,), (3,)]
    # A repeated run lands the same files once.
    again = ingest_increments(spark, first.control, read, str(tmp_path), 3)
    assert rows(read_csv(spark, again.paths["Products"], SOURCE), "ProductID") == [(2,), (3,)]


def test_feeds(spark, tmp_path):
    records = spark.createDataFrame([(1, 2.0)], "payment_id long, amount double")

    def read(name):
        if name == "shipping":
            raise OSError("feed is down")
        return records

    result = ingest_feeds(spark, read, str(tmp_path), 1)
    assert rows(result.audit, "TABLENAME", "ROWREAD", "ROWCOPIED", "ERRORMESSAGE") == [
        ("inventory", 1, 1, None), ("payment", 1, 1, None), ("shipping", None, None, "feed is down"),
    ]
    landed = read_json(spark, result.paths["payment"], schemas.PAYMENT)
    assert rows(landed, "payment_id", "amount") == [(1, 2.0)]


def test_a_source_is_scanned_once_and_files_are_not_read_back(spark, tmp_path):
    """Rows that leave the source are counted where they leave it."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    table = source(spark, (1, 1), (2, 2), (3, 3)).withColumn(
        "ModifiedDate", F.col("ModifiedDate") + F.expr("INTERVAL 123456 MICROSECONDS")
    )
    control = watermark_seed(spark).filter("TABLENAME = 'Products'")
    done = ingest_increments(
        spark, control, lambda *_: table.mapInArrow(pass_on, table.schema), str(tmp_path), 1
    )
    assert seen.value == 3
    assert rows(done.audit, "ROWREAD", "ROWCOPIED") == [(3, 3)]
    mark = F.date_format("LASTPROCESSEDVALUE", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert rows(done.control, mark) == [("2026-01-03 00:00:00.123456",)]
    again = ingest_increments(spark, done.control, lambda *_: table, str(tmp_path), 2)
    assert rows(again.audit, "ROWREAD", "ROWCOPIED") == [(0, 0)] and not again.paths
    assert [p.name for p in (tmp_path / "products").iterdir()] == ["batch=000000000001"]


def test_raw_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    """A compressed file is read by one task, so it may hold a bounded number of records."""
    monkeypatch.setattr(sinks, "RECORDS_PER_FILE", 100)
    records = spark.range(1, 1001, 1, 1).select(
        F.col("id").alias("payment_id"), F.lit(2.0).alias("amount")
    )
    feeds = ingest_feeds(spark, lambda _: records, str(tmp_path / "feeds"), 1, ["payment"])
    landed = read_json(spark, feeds.paths["payment"], schemas.PAYMENT)
    assert rows(landed, F.count("payment_id"), F.sum("payment_id")) == [(1000, 500500)]
    table = source(spark, *((i, 1 + i % 9) for i in range(1, 1001))).coalesce(1)
    control = watermark_seed(spark).filter("TABLENAME = 'Products'")
    tables = ingest_increments(spark, control, lambda *_: table, str(tmp_path / "raw"), 1)
    read_back = read_csv(spark, tables.paths["Products"], SOURCE, coded_breaks=True)
    assert rows(read_back, F.count("*"), F.sum("ProductID")) == [(1000, 500500)]
    for folder in (feeds.paths["payment"], tables.paths["Products"]):
        files = list(Path(folder).glob("part-*"))
        assert len(files) == 10 and all(f.suffix == ".gz" for f in files)
