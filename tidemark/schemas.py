"""Declared schemas: raw inputs, control tables and merge targets.

Keys are long everywhere, so that joins between relational tables and feeds
need no cast and can share one shuffle.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _schema(ddl: str) -> T.StructType:
    """StructType from ``name type, ...`` without needing a session."""
    types = {
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
    }
    fields = (item.split() for item in ddl.split(","))
    return T.StructType([T.StructField(name, types[kind], True) for name, kind in fields])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the trailing column that keeps unparsable records."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


PRODUCTS = _schema(
    "ProductID long, ProductName string, Category string, Price double, ModifiedDate timestamp"
)
CUSTOMERS = _schema(
    "CustomerID long, FirstName string, LastName string, City string, Email string, "
    "ModifiedDate timestamp"
)
ORDERS = _schema(
    "OrderID long, CustomerID long, StoreID long, OrderDate timestamp, ModifiedDate timestamp"
)
ORDER_DETAILS = _schema(
    "OrderDetailID long, OrderID long, ProductID long, Quantity int, TotalAmount double, "
    "ModifiedDate timestamp"
)
STORES = _schema(
    "StoreID long, StoreName string, City string, Province string, ModifiedDate timestamp"
)
PAYMENT = _schema(
    "payment_id long, amount double, modified_date timestamp, order_id long, "
    "payment_method string, payment_status string, payment_time timestamp"
)
SHIPPING = _schema(
    "shipment_id long, carrier string, delivery_date date, modified_date timestamp, "
    "order_id long, shipment_date date, shipment_status string"
)
INVENTORY = _schema(
    "inventory_id long, product_id long, store_id long, stock_quantity int, "
    "last_restock_date date, modified_date timestamp"
)
EMPLOYEE_EVENTS = _schema(
    "EmployeeID string, FirstName string, LastName string, Department string, "
    "Designation string, Salary string, HireDate string, ModifiedDate string"
)

WATERMARK = _schema(
    "ID int, TABLENAME string, SCHEMANAME string, FOLDERNAME string, FILENAME string, "
    "DELTACOL string, LASTPROCESSEDVALUE timestamp"
)
COPY_LOG = _schema(
    "ID int, TABLENAME string, SCHEMANAME string, ROWREAD long, ROWCOPIED long, "
    "ERRORMESSAGE string, COPYDURATION long, LOGTIME timestamp"
)
FEED_COPY_LOG = T.StructType([f for f in COPY_LOG.fields if f.name != "SCHEMANAME"])

DIM_PRODUCT = _schema(
    "ProductID long, ProductName string, Category string, Price double, price_category string, "
    "ModifiedDate timestamp, HASHVALUE long, CREATEDDATE timestamp, CREATEDBY string, "
    "UPDATEDDATE timestamp, UPDATEDBY string"
)
DIM_CUSTOMER = _schema(
    "CustomerID long, FullName string, City string, Email string, HASHVALUE long, "
    "CREATEDDATE timestamp, CREATEDBY string, UPDATEDDATE timestamp, UPDATEDBY string, "
    "IS_ACTIVE int"
)
