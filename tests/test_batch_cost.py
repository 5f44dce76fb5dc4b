"""What a batch costs: shuffles of a merge and of the rebuilt fact, reads of earlier rows."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F
from test_lakehouse import AFTER_SECOND, FIRST, SECOND, lake, sources, state

from tidemark.operators import keep_latest, merge_latest, merge_versions
from tidemark.plans import Lakehouse, gold
from tidemark.session import LISTING_TASKS
from tidemark.sources.versions import read_parts, with_part, write_parts


def shuffles(df):
    """Of a plan that did not run yet."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_all_versions_are_merged_in_one_shuffle(spark):
    """As keep-latest and a merge one after the other, NULL versions and ties included."""
    kind = "k long, v int, a int, loaded string"
    stored = spark.createDataFrame(
        [(1, 5, 1, "old"), (2, 5, None, "old"), (3, None, 3, "old"), (4, 5, 1, "old"),
         (5, 5, 2, "old"), (9, 1, 1, "old")], kind,
    )
    batch = spark.createDataFrame(
        [(1, 5, 1, "new"), (1, 4, 9, "new"), (2, 5, 0, "new"), (3, None, 3, "new"),
         (4, None, 9, "new"), (4, 6, 0, "new"), (4, 7, 0, "new"), (5, 5, 1, "new"),
         (6, None, None, "new"), (6, None, 1, "new"), (7, 1, 1, "new")], kind,
    )
    merged = merge_versions(stored, batch, "k", "v", ["a"])
    assert shuffles(merged) == 1
    assert rows(merged) == rows(
        merge_latest(stored, keep_latest(batch, "k", "v", ["a"]), "k", "v", ["a"])
    )
    assert [r for r in rows(merged) if r[3] == "new"] == [
        (2, 5, 0, "new"), (4, 7, 0, "new"), (6, None, 1, "new"), (7, 1, 1, "new"),
    ]


def test_the_rows_of_many_touched_orders_are_shuffled_once(spark):
    days = [dt.date(2026, 1, 1 + i % 20) for i in range(40)]
    lines = spark.createDataFrame(
        [(i * 8 + j, i, 1, 1, 2.0) for i in range(42) for j in range(2)],
        "OrderDetailID long, OrderID long, ProductID long, Quantity int, TotalAmount double",
    )
    orders = spark.createDataFrame(
        [(i, 1, 1, day) for i, day in enumerate(days)],
        "OrderID long, CustomerID long, StoreID long, OrderDate date",
    )
    payment = spark.createDataFrame(
        [(i, 1.0, 1, i) for i in range(0, 40, 2)],
        "order_id long, amount double, is_success int, payment_id long",
    )
    shipping = spark.createDataFrame(
        [(i, 1, i, 2) for i in range(0, 40, 3)],
        "order_id long, is_delivered int, shipment_id long, delivery_days int",
    )
    inputs = (lines, orders, payment, shipping)
    touched = spark.createDataFrame([(i,) for i in (3, 4, 6, 41)], "OrderID long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = gold.fact_sales(*inputs, as_of="2026-01-01", only_orders=touched)
        many = gold.fact_sales(
            *inputs, as_of="2026-01-01", only_orders=touched, many_orders=True
        )
        assert shuffles(many) <= shuffles(few) - 3
        assert rows(few) == rows(many) and many.count() == 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_batch_reads_earlier_rows_once(spark, tmp_path, monkeypatch):
    """The touched orders come from the rows that the copies by order were made from."""
    read, listing, before = [], set(), Lakehouse.before
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

    def seen(self, name):
        read.append(name)
        listing.add(spark.conf.get(setting))
        return before(self, name)

    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    monkeypatch.setattr(Lakehouse, "before", seen)
    lake(spark, tmp_path, 2).run(2, *sources(spark, SECOND))
    assert sorted(read) == ["orderdetails", "orders", "orders", "payment", "shipping"]
    # Folders are listed by a few tasks, in the run alone.
    assert listing == {str(LISTING_TASKS)} and spark.conf.get(setting, "none") not in listing
    assert state(lake(spark, tmp_path)) == AFTER_SECOND


def test_a_list_of_many_parts_needs_no_python_worker(spark):
    parts = [f"p{i:03b}" for i in range(7)] + ["p1110", "p1111"]
    placed = with_part(spark.range(500).withColumnRenamed("id", "k"), "k", parts)
    assert "ExistingRDD" not in placed._jdf.queryExecution().executedPlan().toString()
    assert placed.select("state_part").distinct().count() == 9 and placed.count() == 500


def test_a_later_batch_writes_few_large_parts_where_they_were_merged(
    spark, tmp_path, monkeypatch
):
    """Small ones are gathered by a shuffle, into one file."""
    first = spark.range(0, 4000, 1, 4).select(F.col("id").alias("k"))
    cover = ["p0", "p1"]
    base = write_parts(with_part(first, "k", cover), f"{tmp_path}/s", 1, None, cover=cover)
    later = with_part(first, "k", cover)

    def files(version):
        write_parts(later, f"{tmp_path}/s", version, None, base, cover, cover)
        return len(list((tmp_path / "s" / f"version={version:012d}").rglob("*.parquet")))

    assert files(2) == 2
    monkeypatch.setattr("tidemark.sources.versions.SMALL_BYTES", 100)
    assert files(3) == 8
    assert read_parts(spark, f"{tmp_path}/s", base).count() == 4000
