"""The retail source tables, derived from the given parquet tables.

Each raw table carries what the cleaning steps are for: keys that are zero,
missing references, values against the rules, untidy text, and outdated copies
of rows. ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _plus_days(moment: Column, days: Column | int) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return moment + F.make_dt_interval(days.cast("int"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    current = part.select(
        key.alias("ProductID"),
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("ProductName"),
        F.col("p_type").alias("Category"),
        F.when(key % 53 == 0, -1.0)
        .when(key % 59 == 0, F.lit(None))
        .otherwise(size * 15.25)
        .alias("Price"),
        _plus_days(_ts("1998-01-01"), size).alias("ModifiedDate"),
    )
    outdated = part.filter(key % 7 == 0).select(
        key.alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        F.col("p_type").alias("Category"),
        (size * 15.25 + 100).alias("Price"),
        _ts("1997-01-01").alias("ModifiedDate"),
    )
    return current.unionByName(outdated)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    people = given(spark, sf_dir, "customer").join(
        given(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    current = people.select(
        key.alias("CustomerID"),
        F.when(key % 17 != 0, F.col("c_mktsegment")).alias("FirstName"),
        F.col("c_name").alias("LastName"),
        F.col("n_name").alias("City"),
        F.when(
            key % 11 != 0,
            F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.com")),
        ).alias("Email"),
        _plus_days(_ts("1998-01-01"), key % 300).alias("ModifiedDate"),
    )
    outdated = people.filter(key % 7 == 1).select(
        key.alias("CustomerID"),
        F.col("c_mktsegment").alias("FirstName"),
        F.col("c_name").alias("LastName"),
        F.lit("OLD TOWN").alias("City"),
        F.lit(None).cast("string").alias("Email"),
        _ts("1997-01-01").alias("ModifiedDate"),
    )
    return current.unionByName(outdated)


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, region = F.col("s_suppkey"), F.col("n_regionkey")
    shops = given(spark, sf_dir, "supplier").join(
        given(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return shops.select(
        key.alias("StoreID"),
        F.col("s_name").alias("StoreName"),
        F.col("n_name").alias("City"),
        F.when(key % 19 == 0, F.lit(None))
        .when(region == 0, " on ")
        .when(region == 1, "qc")
        .when(region == 2, "bc")
        .when(region == 3, " ab")
        .otherwise("ns")
        .alias("Province"),
        _plus_days(_ts("1998-01-01"), key % 300).alias("ModifiedDate"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A row count from the file footers; no data is read.
    n_stores = given(spark, sf_dir, "supplier").count()
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    source = given(spark, sf_dir, "orders")
    current = source.select(
        key.alias("OrderID"),
        F.when(key % 101 != 0, F.col("o_custkey")).alias("CustomerID"),
        (key % n_stores).alias("StoreID"),
        day.alias("OrderDate"),
        _plus_days(day, 1).alias("ModifiedDate"),
    )
    outdated = source.filter(key % 9 == 0).select(
        key.alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        ((key + 1) % n_stores).alias("StoreID"),
        _plus_days(day, -1).alias("OrderDate"),
        day.alias("ModifiedDate"),
    )
    return current.unionByName(outdated)


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines; the given table repeats many (order, line) pairs."""
    part = F.col("l_partkey")
    return given(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("OrderDetailID"),
        F.col("l_orderkey").alias("OrderID"),
        part.alias("ProductID"),
        F.when(part % 223 == 1, 0)
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("Quantity"),
        # Every third part is priced to a tenth of a cent.
        F.when(part % 211 == 0, -F.col("l_extendedprice"))
        .when(part % 3 == 1, (F.round(F.col("l_extendedprice") * 1000) + 4) / 1000)
        .otherwise(F.col("l_extendedprice"))
        .alias("TotalAmount"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ModifiedDate"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of nine orders in ten; every 13th order is paid in two parts."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp_ntz")
    source = given(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    paid = source.filter(key % 10 != 9).select(
        (key * 2 + 1).alias("payment_id"),
        F.when(key % 103 == 0, -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        _plus_days(day, 2).alias("modified_date"),
        F.when(key % 107 != 0, key).alias("order_id"),
        F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")).alias("payment_method"),
        F.when(status == "F", " success ")
        .when(status == "O", "pending")
        .otherwise("failed")
        .alias("payment_status"),
        (day + F.make_dt_interval(F.lit(0), F.lit(1))).alias("payment_time"),
    )
    second = source.filter(key % 13 == 0).select(
        (key * 2 + 2).alias("payment_id"),
        F.lit(10.0).alias("amount"),
        _plus_days(day, 4).alias("modified_date"),
        key.alias("order_id"),
        F.lit("voucher").alias("payment_method"),
        F.lit("Success").alias("payment_status"),
        _plus_days(day, 3).alias("payment_time"),
    )
    outdated = source.filter(key % 8 == 3).select(
        (key * 2 + 1).alias("payment_id"),
        F.lit(1.0).alias("amount"),
        _plus_days(day, 1).alias("modified_date"),
        key.alias("order_id"),
        F.lit("card").alias("payment_method"),
        F.lit("success").alias("payment_status"),
        day.alias("payment_time"),
    )
    return paid.unionByName(second).unionByName(outdated)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments of ten orders in eleven; every 29th order ships twice."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    source = given(spark, sf_dir, "orders")
    step, sent = key % 6, F.date_add(day, 2)
    first = source.filter(key % 11 != 10).select(
        (key * 2 + 1).alias("shipment_id"),
        F.when(key % 3 == 0, " fast freight")
        .when(key % 3 == 1, "blue LINE ")
        .otherwise("parcel co")
        .alias("carrier"),
        F.when(step < 2, F.date_add(sent, (key % 7 + 1).cast("int"))).alias("delivery_date"),
        _plus_days(F.col("o_orderdate").cast("timestamp_ntz"), 3).alias("modified_date"),
        F.when(key % 109 != 0, key).alias("order_id"),
        sent.alias("shipment_date"),
        F.when(step < 2, "delivered")
        .when(step == 2, " in_transit")
        .when(step == 3, "out_for_delivery")
        .when(step == 4, "pending ")
        .otherwise("lost")
        .alias("shipment_status"),
    )
    second = source.filter(key % 29 == 0).select(
        (key * 2 + 2).alias("shipment_id"),
        F.lit("parcel co").alias("carrier"),
        F.date_add(day, 9).alias("delivery_date"),
        _plus_days(F.col("o_orderdate").cast("timestamp_ntz"), 9).alias("modified_date"),
        key.alias("order_id"),
        F.date_add(day, 5).alias("shipment_date"),
        F.lit("delivered").alias("shipment_status"),
    )
    return first.unionByName(second)


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock per product and store, from the quantities sold."""
    return (
        given(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum("l_quantity").alias("sold"), F.max("l_shipdate").alias("last"))
        .select(
            (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("inventory_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("store_id"),
            (F.col("sold").cast("int") - 20).alias("stock_quantity"),
            F.col("last").cast("date").alias("last_restock_date"),
            F.col("last").cast("timestamp_ntz").alias("modified_date"),
        )
    )


RAW = {
    "products": products,
    "customer": customers,
    "orders": orders,
    "orderdetails": order_details,
    "stores": stores,
    "payment": payments,
    "shipping": shipments,
    "inventory": inventory,
}
