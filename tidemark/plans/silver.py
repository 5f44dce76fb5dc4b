"""Raw records to clean, current tables: one job, one spec per table.

The order of the steps shows in the result and is fixed: key check, reference
check, parse check, business rule, text columns, newest version, derived columns.
An invalid newest version is removed before the newest is chosen, so an older
valid one takes its place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import (
    band,
    day_diff,
    equals_flag,
    full_name,
    group_of,
    mapped,
    stamp,
    title_case,
    unit_price,
    upper_trim,
)
from ..operators.latest import keep_latest
from ..operators.quality import Split, has_values, split_corrupt, valid_key
from ..sources.files import read_csv, read_json

# Labels and lists of the derived columns.
PRICE_BANDS = {"HIGH": 500, "MEDIUM": 200}
LOWEST_BAND = "LOW"
REGIONS = {"EAST": ("ON", "QC"), "WEST": ("BC", "AB")}
OTHER_REGION = "OTHER"
PAID = "SUCCESS"
DELIVERED = "DELIVERED"
SHIPMENT_TEXTS = {
    "DELIVERED": "Order completed",
    "IN_TRANSIT": "Moving to destination",
    "OUT_FOR_DELIVERY": "Last mile",
    "PENDING": "Not shipped yet",
}


def _unchanged(df: DataFrame) -> DataFrame:
    return df


@dataclass(frozen=True)
class SilverSpec:
    """What distinguishes one silver table from the others.

    ``tidy`` makes the columns as stored; ``derive`` adds columns that follow
    from them, which :func:`refine` computes for the surviving rows only and so
    neither sorts nor shuffles.
    """

    name: str
    schema: T.StructType
    format: str
    key: str
    version: str
    required: tuple[str, ...] = ()
    rule: Callable[[], Column] | None = None
    tidy: Callable[[DataFrame], DataFrame] = _unchanged
    derive: Callable[[DataFrame], DataFrame] = _unchanged
    ties: tuple[str, ...] = field(default=())

    def read(self, spark: SparkSession, path: str | list[str], **options: object) -> DataFrame:
        reader = read_csv if self.format == "csv" else read_json
        return reader(spark, path, self.schema, **options)


def _tidy_products(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"ProductName": title_case("ProductName"), "Category": title_case("Category")}
    )


def _grade_products(df: DataFrame) -> DataFrame:
    return df.withColumn("price_category", band("Price", PRICE_BANDS, LOWEST_BAND))


def _tidy_customers(df: DataFrame) -> DataFrame:
    named = df.withColumn("FullName", full_name("FirstName", "LastName"))
    return named.drop("FirstName", "LastName")


def _tidy_orders(df: DataFrame) -> DataFrame:
    return df.withColumn("OrderDate", F.to_date("OrderDate"))


def _date_orders(df: DataFrame) -> DataFrame:
    return df.withColumns({"OrderYear": F.year("OrderDate"), "OrderMonth": F.month("OrderDate")})


def _price_order_details(df: DataFrame) -> DataFrame:
    return df.withColumn("UnitPrice", unit_price("TotalAmount", "Quantity"))


def _tidy_stores(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "StoreName": title_case("StoreName"),
            "City": title_case("City"),
            "Province": upper_trim("Province"),
        }
    )


def _locate_stores(df: DataFrame) -> DataFrame:
    return df.withColumn("region", group_of("Province", REGIONS, OTHER_REGION))


def _tidy_payment(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "payment_status": upper_trim("payment_status"),
            "payment_method": title_case("payment_method"),
        }
    )


def _flag_payment(df: DataFrame) -> DataFrame:
    return df.withColumn("is_success", equals_flag("payment_status", PAID))


def _tidy_shipping(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"shipment_status": upper_trim("shipment_status"), "carrier": title_case("carrier")}
    )


def _flag_shipping(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "delivery_days": day_diff("delivery_date", "shipment_date"),
            "is_delivered": equals_flag("shipment_status", DELIVERED),
            "business_status": mapped("shipment_status", SHIPMENT_TEXTS),
        }
    )


def _line_rule() -> Column:
    return (F.col("Quantity") > 0) & (F.col("TotalAmount") >= 0)


def _specs() -> list[SilverSpec]:
    return [
        SilverSpec(
            "products", schemas.PRODUCTS, "csv", "ProductID", "ModifiedDate",
            rule=lambda: F.col("Price") >= 0, tidy=_tidy_products, derive=_grade_products,
            ties=("Price", "ProductName", "Category"),
        ),
        SilverSpec(
            "customer", schemas.CUSTOMERS, "csv", "CustomerID", "ModifiedDate",
            tidy=_tidy_customers, ties=("FullName", "City", "Email"),
        ),
        SilverSpec(
            "orders", schemas.ORDERS, "csv", "OrderID", "ModifiedDate",
            required=("CustomerID", "StoreID"), tidy=_tidy_orders, derive=_date_orders,
            ties=("OrderDate", "CustomerID", "StoreID"),
        ),
        SilverSpec(
            "orderdetails", schemas.ORDER_DETAILS, "csv", "OrderDetailID", "ModifiedDate",
            rule=_line_rule, derive=_price_order_details,
            ties=("TotalAmount", "Quantity", "ProductID", "OrderID"),
        ),
        SilverSpec(
            "stores", schemas.STORES, "csv", "StoreID", "ModifiedDate",
            tidy=_tidy_stores, derive=_locate_stores, ties=("StoreName", "City", "Province"),
        ),
        SilverSpec(
            "payment", schemas.PAYMENT, "json", "payment_id", "modified_date",
            required=("order_id",), rule=lambda: F.col("amount") >= 0, tidy=_tidy_payment,
            derive=_flag_payment,
            ties=("payment_time", "amount", "payment_status", "payment_method", "order_id"),
        ),
        SilverSpec(
            "shipping", schemas.SHIPPING, "json", "shipment_id", "modified_date",
            required=("order_id",), tidy=_tidy_shipping, derive=_flag_shipping,
            ties=("delivery_date", "shipment_date", "shipment_status", "carrier", "order_id"),
        ),
        SilverSpec(
            "inventory", schemas.INVENTORY, "json", "inventory_id", "modified_date",
            rule=lambda: F.col("stock_quantity") >= 0,
            ties=("last_restock_date", "stock_quantity", "product_id", "store_id"),
        ),
    ]


SILVER: dict[str, SilverSpec] = {spec.name: spec for spec in _specs()}


def refine(
    spec: SilverSpec, raw: DataFrame, as_of: object = None, quarantine_first: bool = True
) -> Split:
    """Silver rows and rejected records of one table.

    With ``quarantine_first`` every unparsable record is reported; without it
    those whose key or references could not be read are dropped unreported, as
    the key check comes first. The silver rows are the same either way.
    """
    raw = _with_corrupt(raw)
    bad = split_corrupt(raw if quarantine_first else _usable(spec, raw), spec.key, as_of).bad
    latest = keep_latest(spec.tidy(sound(spec, raw)), spec.key, spec.version, spec.ties)
    return Split(spec.derive(latest).withColumn("ingestion_timestamp", stamp(as_of)), bad)


def versions(spec: SilverSpec, raw: DataFrame, as_of: object = None) -> DataFrame:
    """The silver columns of every sound version, for a merge that finds the newest."""
    rows = spec.derive(spec.tidy(sound(spec, raw)))
    return rows.withColumn("ingestion_timestamp", stamp(as_of))


def rejected(spec: SilverSpec, raw: DataFrame, as_of: object = None) -> DataFrame:
    """Every unparsable record of one table."""
    return split_corrupt(_with_corrupt(raw), spec.key, as_of).bad


def sound(spec: SilverSpec, raw: DataFrame) -> DataFrame:
    """Raw rows, every version, that pass all checks of one table."""
    good = split_corrupt(_usable(spec, _with_corrupt(raw)), spec.key).good
    return good if spec.rule is None else good.filter(spec.rule())


def _usable(spec: SilverSpec, raw: DataFrame) -> DataFrame:
    return has_values(valid_key(raw, spec.key), *spec.required)


def _with_corrupt(raw: DataFrame) -> DataFrame:
    if schemas.CORRUPT in raw.columns:
        return raw
    return raw.withColumn(schemas.CORRUPT, F.lit(None).cast("string"))
