"""The seven retail KPIs over the sales fact.

Where a KPI joins a dimension, the fact is first reduced to one row per join
key. The join then moves a row per key instead of a row per sale, and a key with
a third of all sales is folded before it is shuffled. These sums may be given for
parts of the fact that share no order, such as its months: the totals add them up, so
a batch needs the sums of the months it touched only. Names of result columns are fixed
values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import amount_sums, amount_total, exact_avg, exact_sum, percent_of


def daily_sales(fact: DataFrame) -> DataFrame:
    """Revenue, orders, quantity and mean line amount per day."""
    return fact.groupBy("OrderDate").agg(
        exact_sum("SalesAmount").alias("total_revenue"),
        F.count_distinct("OrderID").alias("total_orders"),
        F.sum("Quantity").alias("total_quantity"),
        exact_avg("SalesAmount").alias("avg_order_value"),
    )


def product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales and quantity per product name and category, best first."""
    return product_totals(product_sums(fact), products)


def product_sums(fact: DataFrame, *by: Column) -> DataFrame:
    """Amount and quantity per product, and per ``by``."""
    return fact.groupBy("ProductID", *by).agg(
        *amount_sums("SalesAmount", "amount"), F.sum("Quantity").alias("quantity")
    )


def product_totals(sums: DataFrame, products: DataFrame) -> DataFrame:
    """:func:`product_performance` from :func:`product_sums`."""
    return (
        sums.join(products.select("ProductID", "ProductName", "Category"), "ProductID")
        .groupBy("ProductName", "Category")
        .agg(
            amount_total("amount").alias("total_sales"),
            F.sum("quantity").alias("total_quantity"),
        )
        .orderBy(F.col("total_sales").desc())
    )


def customer_kpi(fact: DataFrame, customers: DataFrame, active_only: bool = False) -> DataFrame:
    """Orders, spending and mean line amount per customer name, best first.

    ``customers`` may hold several versions per customer; each version counts
    the sales again under its name unless ``active_only`` is set.
    """
    return customer_totals(order_sums(fact, "CustomerID"), customers, active_only)


def customer_totals(sums: DataFrame, customers: DataFrame, active_only: bool = False) -> DataFrame:
    """:func:`customer_kpi` from :func:`order_sums` per CustomerID."""
    if active_only:
        customers = customers.filter(F.col("IS_ACTIVE") == 1)
    # Versions of a customer under one name repeat its sales but not its orders.
    names = customers.groupBy("CustomerID", "FullName").agg(F.count(F.lit(1)).alias("versions"))
    return (
        sums.join(names, "CustomerID")
        .groupBy("FullName")
        .agg(
            F.sum("orders").alias("total_orders"),
            amount_total("amount", "versions").alias("total_spent"),
            F.try_divide(
                amount_total("amount", "versions"),
                F.sum(F.col("lines") * F.col("versions")),
            ).alias("avg_order_value"),
        )
        .orderBy(F.col("total_spent").desc())
    )


def store_performance(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Sales and orders per store name and city."""
    return store_totals(order_sums(fact, "StoreID"), stores)


def store_totals(sums: DataFrame, stores: DataFrame) -> DataFrame:
    """:func:`store_performance` from :func:`order_sums` per StoreID."""
    places = stores.groupBy("StoreID", "StoreName", "City").agg(
        F.count(F.lit(1)).alias("copies")
    )
    return (
        sums.join(places, "StoreID")
        .groupBy("StoreName", "City")
        .agg(
            amount_total("amount", "copies").alias("total_sales"),
            F.sum("orders").alias("total_orders"),
        )
    )


def order_sums(fact: DataFrame, key: str, *by: Column) -> DataFrame:
    """Amount, lines and distinct orders per customer or store, and per ``by``.

    An order has one customer, one store and one date (the fact joins orders that are
    unique by key), so the orders of different keys or months never overlap and their
    counts may be added up. Only this step shuffles at the size of the orders.
    """
    return fact.groupBy(key, *by).agg(
        *amount_sums("SalesAmount", "amount"),
        F.count("SalesAmount").alias("lines"),
        F.count_distinct("OrderID").alias("orders"),
    )


def delivery_performance(fact: DataFrame) -> DataFrame:
    """Mean delivery days, delivered and pending lines; lines without shipment in neither."""
    return fact.agg(
        F.try_divide(
            F.sum("delivery_days").cast("double"), F.count("delivery_days")
        ).alias("avg_delivery_time"),
        _lines_with("is_delivered", 1).alias("delivered_orders"),
        _lines_with("is_delivered", 0).alias("pending_orders"),
    )


def payment_success_rate(fact: DataFrame) -> DataFrame:
    """Share of lines with a successful payment, in percent; NULL for an empty fact."""
    return fact.agg(
        percent_of(_lines_with("is_success", 1), F.count(F.lit(1))).alias("success_rate")
    )


def monthly_sales(fact: DataFrame) -> DataFrame:
    """Revenue per calendar month, in order."""
    return (
        fact.groupBy(F.year("OrderDate").alias("year"), F.month("OrderDate").alias("month"))
        .agg(exact_sum("SalesAmount").alias("revenue"))
        .orderBy("year", "month")
    )


def _lines_with(name: str, value: int) -> Column:
    return F.sum(F.when(F.col(name) == value, 1).otherwise(0))
