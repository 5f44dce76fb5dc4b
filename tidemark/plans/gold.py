"""Fact and dimensions of the star schema.

The column lists and the names of result columns are fixed values.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stamp
from ..operators.scd import scd1_upsert, scd2_upsert
from ..operators.skew import ROWS_PER_TASK, Side, heavy_keys, join_all

# What the fact takes from its inputs other than orders, by silver table.
FACT_COLUMNS = {
    "orderdetails": ("OrderDetailID", "OrderID", "ProductID", "Quantity", "TotalAmount"),
    "payment": ("order_id", "amount", "is_success", "payment_id"),
    "shipping": ("order_id", "is_delivered", "shipment_id", "delivery_days"),
}

# Month of orders without a date.
UNDATED = "undated"


def fact_sales(
    lines: DataFrame,
    orders: DataFrame,
    payment: DataFrame,
    shipping: DataFrame,
    as_of: object = None,
    rows_per_task: int = ROWS_PER_TASK,
    only_orders: DataFrame | None = None,
    many_orders: bool = False,
) -> DataFrame:
    """One row per order line, payment and shipment of its order.

    Lines without an order fall away; orders without payment or shipment keep their lines
    with NULLs. All joins are on the order, so each input is shuffled once; orders with
    more than ``rows_per_task`` joined rows are spread (see ``operators.skew``).
    ``only_orders`` (OrderID, distinct) limits the fact to these orders: every input is
    reduced to them before it is joined. If they are ``many_orders``, a list too long to be
    sent to all tasks, the orders alone are reduced, as the rows of other orders then fall
    away in the join that shuffles them anyway.
    """
    lines = lines.select(*FACT_COLUMNS["orderdetails"])
    orders = orders.select(F.col("OrderID").alias("o_id"), "CustomerID", "StoreID", "OrderDate")
    payment = payment.select(*FACT_COLUMNS["payment"]).withColumnRenamed("order_id", "p_order")
    shipping = shipping.select(*FACT_COLUMNS["shipping"]).withColumnRenamed("order_id", "s_order")
    sides = [
        Side(lines, "OrderID", ("OrderDetailID",)),
        Side(orders, "o_id", ("o_id",), unique=True),
        Side(payment, "p_order", ("payment_id",)),
        Side(shipping, "s_order", ("shipment_id",)),
    ]
    if only_orders is not None:
        wanted = only_orders.select(F.col("OrderID").alias("_wanted"))
        sides = [
            replace(s, rows=s.rows.join(wanted, F.col(s.key) == F.col("_wanted"), "left_semi"))
            if s.unique or not many_orders
            else s
            for s in sides
        ]
    joined = join_all(sides, ["inner", "left", "left"], heavy_keys(sides, rows_per_task))
    return joined.select(
        "OrderDetailID",
        "OrderID",
        "ProductID",
        "CustomerID",
        "StoreID",
        "OrderDate",
        "Quantity",
        F.col("TotalAmount").alias("SalesAmount"),
        F.col("amount").alias("PaymentAmount"),
        "is_success",
        "payment_id",
        "is_delivered",
        "shipment_id",
        "delivery_days",
        stamp(as_of).alias("created_at"),
    )


def order_month(name: str = "OrderDate") -> Column:
    """Month of an order (``yyyy-MM``), with a month of its own for orders without date."""
    return F.coalesce(F.date_format(name, "yyyy-MM"), F.lit(UNDATED))


def touched_orders(changed: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct OrderID over changed rows, given with the name of their order column."""
    ids = (rows.select(F.col(name).alias("OrderID")) for rows, name in changed)
    return reduce(DataFrame.union, ids).filter("OrderID IS NOT NULL").distinct()


def months_of(orders: Iterable[DataFrame], touched: DataFrame) -> list[str]:
    """Months in which the touched orders are, in any of the given states of the orders.

    The list is as long as the calendar, not the data.
    """
    months = (
        df.join(touched, "OrderID", "left_semi").select(order_month().alias("month"))
        for df in orders
    )
    found = reduce(DataFrame.union, months).distinct().collect()
    return sorted(row[0] for row in found)


def refreshed_months(stored: DataFrame, touched: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Stored rows of some months with the touched orders' rows exchanged."""
    kept = stored.join(touched, "OrderID", "left_anti")
    return kept.select(*rebuilt.columns).unionByName(rebuilt)


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select("StoreID", "StoreName", "City", "Province", "region")


def dim_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.select(
        "inventory_id", "product_id", "store_id", "stock_quantity", "last_restock_date"
    )


def dim_payment(payment: DataFrame) -> DataFrame:
    return payment.select(
        "payment_id", "payment_method", "payment_status", "payment_time", "is_success"
    )


def dim_shipment(shipping: DataFrame) -> DataFrame:
    return shipping.select(
        "shipment_id", "carrier", "delivery_date", "order_id", "shipment_date",
        "shipment_status", "delivery_days", "is_delivered", "business_status",
    )


PRODUCT_TRACKED = ("ProductName", "Category", "Price", "price_category", "ModifiedDate")
CUSTOMER_TRACKED = ("FullName", "City", "Email")


def dim_product(
    target: DataFrame,
    products: DataFrame,
    as_of: object = None,
    changed_by: str = "columns",
) -> DataFrame:
    """Current product dimension: changed products replace their stored row."""
    return scd1_upsert(target, products, "ProductID", PRODUCT_TRACKED, as_of, changed_by)


def dim_customer(
    target: DataFrame,
    customers: DataFrame,
    as_of: object = None,
    against: str = "active",
) -> DataFrame:
    """Customer dimension with history: a change closes the open version and adds one."""
    return scd2_upsert(target, customers, "CustomerID", CUSTOMER_TRACKED, as_of, against)
