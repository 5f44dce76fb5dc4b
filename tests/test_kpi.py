from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from tidemark.plans import kpi

FACT = (
    "OrderID long, ProductID long, CustomerID long, StoreID long, OrderDate date, Quantity int, "
    "SalesAmount double, is_success int, is_delivered int, delivery_days int"
)
D1, D2 = dt.date(2026, 1, 5), dt.date(2026, 2, 5)


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1, 1, D1, 2, 10.0, 1, 1, 4),
            (1, 2, 1, 1, D1, 1, 20.0, 0, 0, None),
            (2, 1, 2, 2, D1, 1, 5.5, None, None, None),
            (3, 3, 1, 1, D2, 4, 1.0, 1, None, 2),
        ],
        FACT,
    )


def test_daily(fact):
    assert rows(kpi.daily_sales(fact)) == [
        (D1, 35.5, 2, 4, 35.5 / 3),
        (D2, 1.0, 1, 4, 1.0),
    ]


def test_products(spark, fact):
    dim = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "c", "y")],
        "ProductID long, ProductName string, Category string",
    )
    ordered = [tuple(r) for r in kpi.product_performance(fact, dim).collect()]
    assert ordered == [("a", "x", 35.5, 4), ("b", "x", 1.0, 4)]


def test_customers(spark, fact):
    dim = spark.createDataFrame(
        [(1, "Ann", 0), (1, "Ann", 1), (1, "Anna", 0), (2, "Bob", 1), (9, "Nobody", 1)],
        "CustomerID long, FullName string, IS_ACTIVE int",
    )
    ordered = [tuple(r) for r in kpi.customer_kpi(fact, dim).collect()]
    assert ordered == [
        ("Ann", 2, 62.0, 62.0 / 6),
        ("Anna", 2, 31.0, 31.0 / 3),
        ("Bob", 1, 5.5, 5.5),
    ]
    active = [tuple(r) for r in kpi.customer_kpi(fact, dim, active_only=True).collect()]
    assert active == [("Ann", 2, 31.0, 31.0 / 3), ("Bob", 1, 5.5, 5.5)]


def test_one_name_for_two_customers(spark, fact):
    dim = spark.createDataFrame([(1, "Ann"), (2, "Ann")], "CustomerID long, FullName string")
    assert rows(kpi.customer_kpi(fact, dim)) == [("Ann", 3, 36.5, 36.5 / 4)]


def test_stores(spark, fact):
    dim = spark.createDataFrame(
        [(1, "s", "X"), (2, "s", "X")], "StoreID long, StoreName string, City string"
    )
    assert rows(kpi.store_performance(fact, dim)) == [("s", "X", 36.5, 3)]
    twice = kpi.store_performance(fact, dim.union(dim))
    assert rows(twice) == [("s", "X", 73.0, 3)]


def test_delivery_payment_monthly(fact):
    assert rows(kpi.delivery_performance(fact)) == [(3.0, 1, 1)]
    assert rows(kpi.payment_success_rate(fact)) == [(50.0,)]
    ordered = [tuple(r) for r in kpi.monthly_sales(fact).collect()]
    assert ordered == [(2026, 1, 35.5), (2026, 2, 1.0)]


def test_empty_fact(fact):
    empty = fact.filter("OrderID < 0")
    assert rows(kpi.payment_success_rate(empty)) == [(None,)]
    assert rows(kpi.delivery_performance(empty)) == [(None, None, None)]
    assert rows(kpi.daily_sales(empty)) == []


def test_only_needed_columns_are_read(spark, fact, tmp_path):
    fact.write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    plan = kpi.monthly_sales(stored)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<OrderDate:date,SalesAmount:double>" in plan


def test_sales_are_folded_before_the_dimension_join(spark, fact, tmp_path):
    dim = spark.createDataFrame([(1, "a", "x")], "ProductID long, ProductName string, Category string")
    plan = kpi.product_performance(fact, dim)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert plan.index("Aggregate [ProductID") > join
