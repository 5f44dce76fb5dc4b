from __future__ import annotations

import datetime as dt

from conftest import rows

from tidemark.plans.silver import SILVER, refine
from tidemark.schemas import with_corrupt

UTC = dt.timezone.utc
AS_OF = "2026-03-01 00:00:00"


def at(day):
    return dt.datetime(2026, 1, day, tzinfo=UTC)


def good(spark, name, *data):
    spec = SILVER[name]
    raw = spark.createDataFrame([(*row, None) for row in data], with_corrupt(spec.schema))
    return refine(spec, raw, AS_OF).good


def test_an_older_valid_version_replaces_an_invalid_newest(spark):
    got = good(spark, "products", (1, "a", "b", 300.0, at(1)), (1, "a", "b", -1.0, at(2)))
    assert rows(got, "ProductID", "Price", "price_category") == [(1, 300.0, "MEDIUM")]


def test_null_price_is_dropped(spark):
    assert good(spark, "products", (7, "a", "b", None, at(1))).count() == 0


def test_customer(spark):
    got = good(spark, "customer", (1, " ann ", None, "x", None, at(1)))
    assert got.columns == [
        "CustomerID", "City", "Email", "ModifiedDate", "FullName", "ingestion_timestamp",
    ]
    assert rows(got, "City", "FullName") == [("x", " ann ")]


def test_orders(spark):
    got = good(
        spark, "orders",
        (1, 1, 1, at(5), at(5)), (2, None, 1, at(5), at(5)), (3, 1, None, at(5), at(5)),
        (0, 1, 1, at(5), at(5)),
    )
    assert rows(got, "OrderID", "OrderDate", "OrderYear", "OrderMonth") == [
        (1, dt.date(2026, 1, 5), 2026, 1)
    ]


def test_order_details(spark):
    got = good(
        spark, "orderdetails",
        (1, 1, 1, 4, 10.0, at(1)), (2, 1, 1, 0, 10.0, at(1)), (3, 1, 1, 1, -1.0, at(1)),
        (4, 1, 1, None, 1.0, at(1)), (5, None, None, 1, 0.0, at(1)),
    )
    assert rows(got, "OrderDetailID", "UnitPrice") == [(1, 2.5), (5, 0.0)]


def test_stores(spark):
    got = good(spark, "stores", (1, " main ST ", "toronto", " qc", at(1)),
               (2, "b", "c", None, at(1)))
    assert rows(got, "StoreID", "StoreName", "City", "Province", "region") == [
        (1, "Main St", "Toronto", "QC", "EAST"), (2, "B", "C", None, "OTHER"),
    ]


def test_payment(spark):
    got = good(
        spark, "payment",
        (1, 5.0, at(1), 1, " credit CARD", " success ", at(1)),
        (2, 5.0, at(1), None, "x", "success", at(1)), (3, -5.0, at(1), 1, "x", "y", at(1)),
        (4, 0.0, at(1), 1, None, None, at(1)),
    )
    assert rows(got, "payment_id", "payment_method", "payment_status", "is_success") == [
        (1, "Credit Card", "SUCCESS", 1), (4, None, None, 0),
    ]


def test_shipping(spark):
    d = dt.date
    got = good(
        spark, "shipping",
        (1, "UPS x", d(2026, 1, 9), at(1), 1, d(2026, 1, 5), "delivered"),
        (2, "a", None, at(1), 1, d(2026, 1, 5), "lost"),
        (3, "a", d(2026, 1, 9), at(1), 1, None, " out_for_delivery"),
    )
    assert rows(got, "shipment_id", "carrier", "delivery_days", "is_delivered",
                "business_status") == [
        (1, "Ups X", 4, 1, "Order completed"), (2, "A", None, 0, None),
        (3, "A", None, 0, "Last mile"),
    ]


def test_inventory_and_load_time(spark):
    got = good(spark, "inventory", (1, 1, 1, 0, None, at(1)), (2, 1, 1, -1, None, at(1)))
    assert [str(r[0]) for r in got.select(got.ingestion_timestamp.cast("string")).collect()] == [
        AS_OF
    ]
