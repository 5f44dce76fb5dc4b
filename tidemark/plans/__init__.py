"""Composite jobs: silver tables, gold tables, KPIs, ingest and the full run."""

from .gold import (
    dim_customer,
    dim_inventory,
    dim_payment,
    dim_product,
    dim_shipment,
    dim_store,
    fact_sales,
    months_of,
    refreshed_months,
    touched_orders,
)
from .ingest import IngestFailed, IngestResult, ingest_feeds, ingest_increments
from .kpi import (
    customer_kpi,
    daily_sales,
    delivery_performance,
    monthly_sales,
    payment_success_rate,
    product_performance,
    store_performance,
)
from .lakehouse import Lakehouse
from .silver import SILVER, SilverSpec, refine

__all__ = [
    "SILVER",
    "IngestFailed",
    "IngestResult",
    "Lakehouse",
    "SilverSpec",
    "customer_kpi",
    "daily_sales",
    "delivery_performance",
    "dim_customer",
    "dim_inventory",
    "dim_payment",
    "dim_product",
    "dim_shipment",
    "dim_store",
    "fact_sales",
    "ingest_feeds",
    "ingest_increments",
    "monthly_sales",
    "months_of",
    "payment_success_rate",
    "product_performance",
    "refine",
    "refreshed_months",
    "store_performance",
    "touched_orders",
]
