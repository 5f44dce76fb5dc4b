from __future__ import annotations

import datetime as dt

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import Side, heavy_keys, join_all
from tidemark.plans import fact_sales

LINES = "OrderDetailID long, OrderID long, ProductID long, Quantity int, TotalAmount double"
ORDERS = "OrderID long, CustomerID long, StoreID long, OrderDate date"
PAYMENT = "order_id long, amount double, is_success int, payment_id long"
SHIPPING = "order_id long, is_delivered int, shipment_id long, delivery_days int"
DAY = dt.date(2026, 1, 5)


def frames(spark, lines, orders, payment, shipping):
    """Frames from plain keys: lines (id, order), orders (key), payments and shipments (id, order)."""
    return (
        spark.createDataFrame([(i, o, i, 1, 2.0) for i, o in lines], LINES),
        spark.createDataFrame([(o, o, o, DAY) for o in orders], ORDERS),
        spark.createDataFrame([(o, 1.0, 1, i) for i, o in payment], PAYMENT),
        spark.createDataFrame([(o, 1, i, 3) for i, o in shipping], SHIPPING),
    )


def keys(fact):
    return rows(fact, "OrderDetailID", "OrderID", "payment_id", "shipment_id")


def expected(lines, orders, payment, shipping):
    found = []
    for i, o in lines:
        if o in orders:
            for p in [p for p, q in payment if q == o] or [None]:
                found += [(i, o, p, s) for s in [s for s, q in shipping if q == o] or [None]]
    return sorted(found, key=lambda t: [(v is None, v) for v in t])


def test_fan_out_and_orphans(spark):
    data = ([(10, 1), (20, 2), (30, 9)], [1, 2], [(1, 1), (2, 1)], [(7, 2)])
    fact = fact_sales(*frames(spark, *data), as_of="2026-01-01 00:00:00")
    assert keys(fact) == expected(*data) == [(10, 1, 1, None), (10, 1, 2, None), (20, 2, None, 7)]
    assert fact.columns == [
        "OrderDetailID", "OrderID", "ProductID", "CustomerID", "StoreID", "OrderDate",
        "Quantity", "SalesAmount", "PaymentAmount", "is_success", "payment_id", "is_delivered",
        "shipment_id", "delivery_days", "created_at",
    ]


def _moved(plan):
    """Exchanges that deal rows by order and cell."""
    return sum("Exchange hashpartitioning" in line and "_cell" in line for line in plan.splitlines())


def test_one_shuffle_per_input(spark, tmp_path):
    data = ([(10, 1)], [1], [(1, 1)], [(7, 1)])
    stored = []
    for i, frame in enumerate(frames(spark, *data)):
        frame.write.parquet(str(tmp_path / str(i)))
        stored.append(spark.read.parquet(str(tmp_path / str(i))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fact_sales(*stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _moved(plan) == 4 and "Cartesian" not in plan
    assert "Python" not in plan


def test_heavy_keys_without_a_limit_to_their_number(spark):
    left = spark.range(9000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("l"))
    right = spark.range(6000).select((F.col("id") % 3000).alias("r"), F.col("id").alias("x"))
    sides = [Side(left, "k", ("l",)), Side(right, "r", ("x",))]
    assert heavy_keys(sides, 6).count() == 0
    # No side of a key is large, but the product of its rows is.
    assert heavy_keys(sides, 5).count() == 3000
    joined = join_all(sides, ["inner"], heavy_keys(sides, 2))
    assert joined.count() == joined.distinct().count() == 3000 * 3 * 2


def test_two_medium_sides_with_a_large_product(spark):
    left = spark.range(900).select(F.lit(1).cast("long").alias("k"), F.col("id").alias("l"))
    right = spark.range(800).select(F.lit(1).cast("long").alias("r"), F.col("id").alias("x"))
    sides = [Side(left, "k", ("l",)), Side(right, "r", ("x",))]
    heavy = heavy_keys(sides, 1000)
    assert rows(heavy, "key", "cuts_0", "cuts_1") == [(1, 720, 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = (
            join_all(sides, ["left"], heavy).groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in per_task) == 900 * 800
    assert len(per_task) == 4 and max(r["count"] for r in per_task) < 300_000


pairs = st.lists(st.integers(1, 4), max_size=14)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, st.sets(st.integers(1, 4)), st.one_of(st.just([1, 3]), pairs), pairs)
def test_spread_fact_equals_brute_force(spark, lines, orders, payment, shipping):
    """With a limit of two joined rows per task nearly every order counts as heavy."""
    data = (
        list(enumerate(lines, 1)), sorted(orders), list(enumerate(payment, 100)),
        list(enumerate(shipping, 200)),
    )
    fact = fact_sales(*frames(spark, *data), rows_per_task=2)
    assert keys(fact) == expected(*data)


def test_heavy_lines_alone_keep_one_shuffle_per_input(spark, tmp_path):
    data = ([(i, 1) for i in range(1, 9)], [1, 2], [(1, 1)], [(7, 2)])
    stored = []
    for i, frame in enumerate(frames(spark, *data)):
        frame.write.parquet(str(tmp_path / str(i)))
        stored.append(spark.read.parquet(str(tmp_path / str(i))))
    fact = fact_sales(*stored, rows_per_task=4)
    assert keys(fact) == expected(*data)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fact_sales(*stored, rows_per_task=4)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _moved(plan.toString()) == 4


def test_left_rows_without_key_survive(spark):
    left = spark.createDataFrame([(None, 1), (1, 2), (2, 3)], "lk long, l int")
    right = spark.createDataFrame([(1, i) for i in range(9)], "rk long, r int")
    sides = [Side(left, "lk", ("l",)), Side(right, "rk", ("r",))]
    joined = join_all(sides, ["left"], heavy_keys(sides, 2))
    assert joined.count() == 11
    assert rows(joined.filter("r is null"), "lk", "l") == [(2, 3), (None, 1)]


def test_inputs_are_reduced_to_the_touched_orders_before_they_move(spark, tmp_path):
    data = ([(10, 1), (20, 2)], [1, 2], [(1, 1)], [(7, 2)])
    stored = []
    for i, frame in enumerate(frames(spark, *data)):
        frame.write.parquet(str(tmp_path / str(i)))
        stored.append(spark.read.parquet(str(tmp_path / str(i))))
    spark.createDataFrame([(2,)], "OrderID long").write.parquet(str(tmp_path / "touched"))
    touched = spark.read.parquet(str(tmp_path / "touched"))
    fact = fact_sales(*stored, only_orders=touched)
    assert keys(fact) == [(20, 2, None, 7)]
    plan = fact._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # Below each of the four inputs' own joins there is nothing but the semi-join and a scan.
    assert sum("Join LeftSemi" in line for line in plan) == 4
    for name in ("OrderDetailID", "o_id", "p_order", "s_order"):
        assert any(name in line for line in plan)
