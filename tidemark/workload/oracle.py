"""The registered queries in SQL, for an independent engine to answer.

``RAW`` holds the derivations of ``retail.py``, ``SILVER`` the cleaning on top
of them; a query lists the fragments it stands on and ``_with`` writes them as
common table expressions.
"""

from __future__ import annotations

TITLE = (
    "array_to_string(list_transform(string_split(lower(trim({0})), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)


def title(column: str) -> str:
    return TITLE.format(column)


RAW = {
    "raw_products": """
        SELECT p_partkey AS ProductID, '  ' || upper(p_name) || ' ' AS ProductName,
               p_type AS Category,
               CASE WHEN p_partkey % 53 = 0 THEN -1.0::DOUBLE
                    WHEN p_partkey % 59 = 0 THEN NULL
                    ELSE p_size * 15.25::DOUBLE END AS Price,
               TIMESTAMP '1998-01-01' + to_days(p_size) AS ModifiedDate
        FROM part
        UNION ALL
        SELECT p_partkey, p_name, p_type, p_size * 15.25::DOUBLE + 100, TIMESTAMP '1997-01-01'
        FROM part WHERE p_partkey % 7 = 0""",
    "raw_customers": """
        SELECT c_custkey AS CustomerID,
               CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment END AS FirstName,
               c_name AS LastName, n_name AS City,
               CASE WHEN c_custkey % 11 <> 0
                    THEN lower(c_mktsegment) || c_custkey::VARCHAR || '@example.com' END AS Email,
               TIMESTAMP '1998-01-01' + to_days((c_custkey % 300)::INTEGER) AS ModifiedDate
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT c_custkey, c_mktsegment, c_name, 'OLD TOWN', NULL, TIMESTAMP '1997-01-01'
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 = 1""",
    "raw_stores": """
        SELECT s_suppkey AS StoreID, s_name AS StoreName, n_name AS City,
               CASE WHEN s_suppkey % 19 = 0 THEN NULL
                    WHEN n_regionkey = 0 THEN ' on ' WHEN n_regionkey = 1 THEN 'qc'
                    WHEN n_regionkey = 2 THEN 'bc' WHEN n_regionkey = 3 THEN ' ab'
                    ELSE 'ns' END AS Province,
               TIMESTAMP '1998-01-01' + to_days((s_suppkey % 300)::INTEGER) AS ModifiedDate
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_orders": """
        SELECT o_orderkey AS OrderID,
               CASE WHEN o_orderkey % 101 <> 0 THEN o_custkey END AS CustomerID,
               o_orderkey % (SELECT count(*) FROM supplier) AS StoreID,
               o_orderdate::TIMESTAMP AS OrderDate,
               o_orderdate::TIMESTAMP + to_days(1) AS ModifiedDate
        FROM orders
        UNION ALL
        SELECT o_orderkey, o_custkey, (o_orderkey + 1) % (SELECT count(*) FROM supplier),
               o_orderdate::TIMESTAMP - to_days(1), o_orderdate::TIMESTAMP
        FROM orders WHERE o_orderkey % 9 = 0""",
    "raw_lines": """
        SELECT l_orderkey * 8 + l_linenumber AS OrderDetailID, l_orderkey AS OrderID,
               l_partkey AS ProductID,
               CASE WHEN l_partkey % 223 = 1 THEN 0 ELSE l_quantity::INTEGER END AS Quantity,
               CASE WHEN l_partkey % 211 = 0 THEN -l_extendedprice
                    WHEN l_partkey % 3 = 1 THEN (round(l_extendedprice * 1000) + 4) / 1000
                    ELSE l_extendedprice END AS TotalAmount,
               l_shipdate::TIMESTAMP AS ModifiedDate
        FROM lineitem""",
    "raw_payment": """
        SELECT o_orderkey * 2 + 1 AS payment_id,
               CASE WHEN o_orderkey % 103 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
               o_orderdate::TIMESTAMP + to_days(2) AS modified_date,
               CASE WHEN o_orderkey % 107 <> 0 THEN o_orderkey END AS order_id,
               ' ' || lower(o_orderpriority) || ' ' AS payment_method,
               CASE o_orderstatus WHEN 'F' THEN ' success ' WHEN 'O' THEN 'pending'
                    ELSE 'failed' END AS payment_status,
               o_orderdate::TIMESTAMP + to_hours(1) AS payment_time
        FROM orders WHERE o_orderkey % 10 <> 9
        UNION ALL
        SELECT o_orderkey * 2 + 2, 10.0, o_orderdate::TIMESTAMP + to_days(4), o_orderkey,
               'voucher', 'Success', o_orderdate::TIMESTAMP + to_days(3)
        FROM orders WHERE o_orderkey % 13 = 0
        UNION ALL
        SELECT o_orderkey * 2 + 1, 1.0, o_orderdate::TIMESTAMP + to_days(1), o_orderkey,
               'card', 'success', o_orderdate::TIMESTAMP
        FROM orders WHERE o_orderkey % 8 = 3""",
    "raw_shipping": """
        SELECT o_orderkey * 2 + 1 AS shipment_id,
               CASE o_orderkey % 3 WHEN 0 THEN ' fast freight' WHEN 1 THEN 'blue LINE '
                    ELSE 'parcel co' END AS carrier,
               CASE WHEN o_orderkey % 6 < 2
                    THEN o_orderdate::DATE + 3 + (o_orderkey % 7)::INTEGER END AS delivery_date,
               o_orderdate::TIMESTAMP + to_days(3) AS modified_date,
               CASE WHEN o_orderkey % 109 <> 0 THEN o_orderkey END AS order_id,
               o_orderdate::DATE + 2 AS shipment_date,
               CASE o_orderkey % 6 WHEN 0 THEN 'delivered' WHEN 1 THEN 'delivered'
                    WHEN 2 THEN ' in_transit' WHEN 3 THEN 'out_for_delivery'
                    WHEN 4 THEN 'pending ' ELSE 'lost' END AS shipment_status
        FROM orders WHERE o_orderkey % 11 <> 10
        UNION ALL
        SELECT o_orderkey * 2 + 2, 'parcel co', o_orderdate::DATE + 9,
               o_orderdate::TIMESTAMP + to_days(9), o_orderkey, o_orderdate::DATE + 5, 'delivered'
        FROM orders WHERE o_orderkey % 29 = 0""",
    "raw_inventory": """
        SELECT l_partkey * 1000000 + l_suppkey AS inventory_id, l_partkey AS product_id,
               l_suppkey AS store_id, sum(l_quantity)::INTEGER - 20 AS stock_quantity,
               max(l_shipdate)::DATE AS last_restock_date,
               max(l_shipdate)::TIMESTAMP AS modified_date
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
}


def _latest(inner: str, key: str, version: str, ties: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [version, *ties])
    return (
        f"SELECT * FROM ({inner}) QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY {order}) = 1"
    )


SILVER = {
    "products": _latest(
        f"""SELECT ProductID, {title("ProductName")} AS ProductName,
                   {title("Category")} AS Category, Price, ModifiedDate,
                   CASE WHEN Price > 500 THEN 'HIGH' WHEN Price > 200 THEN 'MEDIUM'
                        ELSE 'LOW' END AS price_category
            FROM raw_products WHERE ProductID IS NOT NULL AND ProductID <> 0 AND Price >= 0""",
        "ProductID", "ModifiedDate", ["Price", "ProductName", "Category"],
    ),
    "customer": _latest(
        """SELECT CustomerID, City, Email, ModifiedDate,
                  concat_ws(' ', FirstName, LastName) AS FullName
           FROM raw_customers WHERE CustomerID IS NOT NULL AND CustomerID <> 0""",
        "CustomerID", "ModifiedDate", ["FullName", "City", "Email"],
    ),
    "orders": _latest(
        """SELECT OrderID, CustomerID, StoreID, OrderDate::DATE AS OrderDate, ModifiedDate,
                  year(OrderDate)::INTEGER AS OrderYear, month(OrderDate)::INTEGER AS OrderMonth
           FROM raw_orders WHERE OrderID IS NOT NULL AND OrderID <> 0
             AND CustomerID IS NOT NULL AND StoreID IS NOT NULL""",
        "OrderID", "ModifiedDate", ["OrderDate", "CustomerID", "StoreID"],
    ),
    "lines": _latest(
        """SELECT *, TotalAmount / Quantity AS UnitPrice
           FROM raw_lines WHERE OrderDetailID IS NOT NULL AND OrderDetailID <> 0
             AND Quantity > 0 AND TotalAmount >= 0""",
        "OrderDetailID", "ModifiedDate", ["TotalAmount", "Quantity", "ProductID", "OrderID"],
    ),
    "stores": _latest(
        f"""SELECT *, CASE WHEN Province IN ('ON', 'QC') THEN 'EAST'
                           WHEN Province IN ('BC', 'AB') THEN 'WEST' ELSE 'OTHER' END AS region
            FROM (SELECT StoreID, {title("StoreName")} AS StoreName, {title("City")} AS City,
                         upper(trim(Province)) AS Province, ModifiedDate
                  FROM raw_stores WHERE StoreID IS NOT NULL AND StoreID <> 0)""",
        "StoreID", "ModifiedDate", ["StoreName", "City", "Province"],
    ),
    "payment": _latest(
        f"""SELECT *, CASE WHEN payment_status = 'SUCCESS' THEN 1 ELSE 0 END AS is_success
            FROM (SELECT payment_id, amount, modified_date, order_id,
                         {title("payment_method")} AS payment_method,
                         upper(trim(payment_status)) AS payment_status, payment_time
                  FROM raw_payment WHERE payment_id IS NOT NULL AND payment_id <> 0
                    AND order_id IS NOT NULL AND amount >= 0)""",
        "payment_id", "modified_date",
        ["payment_time", "amount", "payment_status", "payment_method", "order_id"],
    ),
    "shipping": _latest(
        f"""SELECT *, date_diff('day', shipment_date, delivery_date)::INTEGER AS delivery_days,
                   CASE WHEN shipment_status = 'DELIVERED' THEN 1 ELSE 0 END AS is_delivered,
                   CASE shipment_status WHEN 'DELIVERED' THEN 'Order completed'
                        WHEN 'IN_TRANSIT' THEN 'Moving to destination'
                        WHEN 'OUT_FOR_DELIVERY' THEN 'Last mile'
                        WHEN 'PENDING' THEN 'Not shipped yet' END AS business_status
            FROM (SELECT shipment_id, {title("carrier")} AS carrier, delivery_date,
                         modified_date, order_id, shipment_date,
                         upper(trim(shipment_status)) AS shipment_status
                  FROM raw_shipping WHERE shipment_id IS NOT NULL AND shipment_id <> 0
                    AND order_id IS NOT NULL)""",
        "shipment_id", "modified_date",
        ["delivery_date", "shipment_date", "shipment_status", "carrier", "order_id"],
    ),
    "inventory": _latest(
        """SELECT * FROM raw_inventory WHERE inventory_id IS NOT NULL AND inventory_id <> 0
             AND stock_quantity >= 0""",
        "inventory_id", "modified_date",
        ["last_restock_date", "stock_quantity", "product_id", "store_id"],
    ),
}

_SILVER_INPUT = {
    "products": "raw_products",
    "customer": "raw_customers",
    "orders": "raw_orders",
    "lines": "raw_lines",
    "stores": "raw_stores",
    "payment": "raw_payment",
    "shipping": "raw_shipping",
    "inventory": "raw_inventory",
}

FACT = """
    SELECT od.OrderDetailID, od.OrderID, od.ProductID, o.CustomerID, o.StoreID, o.OrderDate,
           od.Quantity, od.TotalAmount AS SalesAmount, p.amount AS PaymentAmount, p.is_success,
           p.payment_id, s.is_delivered, s.shipment_id, s.delivery_days
    FROM silver_lines od JOIN silver_orders o ON od.OrderID = o.OrderID
    LEFT JOIN silver_payment p ON od.OrderID = p.order_id
    LEFT JOIN silver_shipping s ON od.OrderID = s.order_id"""


def _with(query: str, *silver: str, raw: tuple[str, ...] = (), extra: dict | None = None) -> str:
    """The query on top of the named silver tables, raw tables and further expressions."""
    parts = {name: RAW[name] for name in [*(_SILVER_INPUT[s] for s in silver), *raw]}
    parts |= {f"silver_{s}": SILVER[s] for s in silver}
    parts |= extra or {}
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH {ctes}\n{query}"


def _on_fact(query: str, *silver: str, extra: dict | None = None) -> str:
    needed = dict.fromkeys(["lines", "orders", "payment", "shipping", *silver])
    return _with(query, *needed, extra={"fact": FACT, **(extra or {})})


def _money(column: str) -> str:
    return f"sum({column}::DECIMAL(24,6))::DOUBLE"


# Stored dimensions that the upserts start from: see queries.py.
PRODUCT_TARGET = """
    SELECT ProductID,
           CASE WHEN ProductID % 7 = 3 THEN ProductName || '||' || Category
                ELSE ProductName END AS ProductName,
           CASE WHEN ProductID % 7 <> 3 THEN Category END AS Category,
           CASE WHEN ProductID % 5 = 0 THEN Price + 1 ELSE Price END AS Price,
           price_category, ModifiedDate, TIMESTAMP '2025-01-01' AS CREATEDDATE,
           'databricks' AS CREATEDBY, TIMESTAMP '2025-01-01' AS UPDATEDDATE,
           'databricks' AS UPDATEDBY
    FROM silver_products WHERE ProductID % 3 <> 0
    UNION ALL
    SELECT -ProductID, 'Gone', Category, Price, price_category, ModifiedDate,
           TIMESTAMP '2025-01-01', 'databricks', TIMESTAMP '2025-01-01', 'databricks'
    FROM silver_products WHERE ProductID % 10 = 1"""


def _scd1(differs: str) -> str:
    return f"""
    SELECT ProductID, ProductName, Category, Price, price_category, ModifiedDate,
           CREATEDDATE, CREATEDBY, UPDATEDDATE, UPDATEDBY
    FROM product_target t
    WHERE NOT EXISTS (SELECT 1 FROM silver_products s WHERE s.ProductID = t.ProductID
                      AND {differs})
    UNION ALL
    SELECT s.ProductID, s.ProductName, s.Category, s.Price, s.price_category, s.ModifiedDate,
           coalesce(t.CREATEDDATE, TIMESTAMP '2026-01-01'), 'databricks',
           TIMESTAMP '2026-01-01',
           CASE WHEN t.ProductID IS NULL THEN 'databricks' ELSE 'databricks-updated' END
    FROM silver_products s LEFT JOIN product_target t ON s.ProductID = t.ProductID
    WHERE t.ProductID IS NULL OR {differs}"""


SCD1 = _scd1(
    """(s.Price IS DISTINCT FROM t.Price OR s.ProductName IS DISTINCT FROM t.ProductName
        OR s.Category IS DISTINCT FROM t.Category)"""
)
_HASHED = "concat_ws('||', {0}.ProductName, {0}.Category, {0}.Price, {0}.ModifiedDate)"
SCD1_BY_HASH = _scd1(f"{_HASHED.format('s')} <> {_HASHED.format('t')}")

CUSTOMER_TARGET = """
    SELECT CustomerID, FullName,
           CASE WHEN CustomerID % 5 = 0 THEN 'Elsewhere' ELSE City END AS City, Email,
           TIMESTAMP '2025-01-01' AS CREATEDDATE, 'databricks' AS CREATEDBY,
           TIMESTAMP '9999-01-01' AS UPDATEDDATE, 'databricks' AS UPDATEDBY, 1 AS IS_ACTIVE
    FROM silver_customer WHERE CustomerID % 3 <> 0
    UNION ALL
    SELECT CustomerID, FullName, CASE WHEN CustomerID % 10 = 0 THEN City ELSE 'Before' END, Email,
           TIMESTAMP '2024-01-01', 'databricks', TIMESTAMP '2025-01-01', 'Databricks-Updated', 0
    FROM silver_customer WHERE CustomerID % 3 <> 0 AND CustomerID % 2 = 0"""


def _scd2(is_new: str, closes: str) -> str:
    return f"""
    SELECT t.CustomerID, t.FullName, t.City, t.Email, t.CREATEDDATE, t.CREATEDBY,
           CASE WHEN c.CustomerID IS NULL THEN t.UPDATEDDATE
                ELSE TIMESTAMP '2026-01-01' END AS UPDATEDDATE,
           CASE WHEN c.CustomerID IS NULL THEN t.UPDATEDBY
                ELSE 'Databricks-Updated' END AS UPDATEDBY,
           CASE WHEN c.CustomerID IS NULL THEN t.IS_ACTIVE ELSE 0 END AS IS_ACTIVE
    FROM customer_target t
    LEFT JOIN (SELECT * FROM silver_customer s WHERE {is_new}) c
      ON c.CustomerID = t.CustomerID AND t.IS_ACTIVE = 1 AND {closes}
    UNION ALL
    SELECT s.CustomerID, s.FullName, s.City, s.Email, TIMESTAMP '2026-01-01', 'databricks',
           TIMESTAMP '9999-01-01', 'databricks', 1
    FROM silver_customer s WHERE {is_new}"""


SCD2 = _scd2(
    """NOT EXISTS (SELECT 1 FROM customer_target a WHERE a.CustomerID = s.CustomerID
         AND a.IS_ACTIVE = 1 AND a.FullName IS NOT DISTINCT FROM s.FullName
         AND a.City IS NOT DISTINCT FROM s.City AND a.Email IS NOT DISTINCT FROM s.Email)""",
    "(c.City IS DISTINCT FROM t.City OR c.Email IS DISTINCT FROM t.Email)",
)
# The plain hash rule: equal only when every column is present and the joined text is equal.
SCD2_HISTORY = _scd2(
    """NOT EXISTS (SELECT 1 FROM customer_target a WHERE a.CustomerID = s.CustomerID
         AND a.FullName || a.City || a.Email = s.FullName || s.City || s.Email)""",
    "c.FullName || c.City || c.Email <> t.FullName || t.City || t.Email",
)

_CUSTOMER_DIM = {"customer_target": CUSTOMER_TARGET, "dim_customer": SCD2}


def _customer_kpi(condition: str, dim: dict | None = None) -> str:
    return _on_fact(
        f"""SELECT d.FullName, count(DISTINCT f.OrderID) AS total_orders,
                   {_money("f.SalesAmount")} AS total_spent,
                   {_money("f.SalesAmount")} / count(f.SalesAmount) AS avg_order_value
            FROM fact f JOIN dim_customer d ON f.CustomerID = d.CustomerID {condition}
            GROUP BY d.FullName""",
        "customer",
        extra=dim or _CUSTOMER_DIM,
    )


# Tables after two batches, the first of which saw the rows modified until FIRST_CUT.
FIRST_CUT = "TIMESTAMP '1998-02-01'"
LOADED, LATER = "TIMESTAMP '2026-01-01'", "TIMESTAMP '2026-02-01'"


def _first(name: str, version: str) -> dict[str, str]:
    raw = _SILVER_INPUT[name]
    body = SILVER[name].replace(raw, f"(SELECT * FROM {raw} WHERE {version} <= {FIRST_CUT})")
    return {f"first_{name}": body}


LAKE_PRODUCT = f"""
    SELECT s.ProductID, s.ProductName, s.Category, s.Price, s.price_category, s.ModifiedDate,
           CASE WHEN f.ProductID IS NULL THEN {LATER} ELSE {LOADED} END AS CREATEDDATE,
           'databricks' AS CREATEDBY,
           CASE WHEN s.ModifiedDate = f.ModifiedDate THEN {LOADED} ELSE {LATER} END
             AS UPDATEDDATE,
           CASE WHEN s.ModifiedDate <> f.ModifiedDate THEN 'databricks-updated'
                ELSE 'databricks' END AS UPDATEDBY
    FROM silver_products s LEFT JOIN first_products f ON s.ProductID = f.ProductID"""

_SAME_CUSTOMER = """(f.FullName IS NOT DISTINCT FROM s.FullName
    AND f.City IS NOT DISTINCT FROM s.City AND f.Email IS NOT DISTINCT FROM s.Email)"""
LAKE_CUSTOMER = f"""
    SELECT s.CustomerID, s.FullName, s.City, s.Email,
           CASE WHEN f.CustomerID IS NOT NULL AND {_SAME_CUSTOMER} THEN {LOADED}
                ELSE {LATER} END AS CREATEDDATE,
           'databricks' AS CREATEDBY, TIMESTAMP '9999-01-01' AS UPDATEDDATE,
           'databricks' AS UPDATEDBY, 1 AS IS_ACTIVE
    FROM silver_customer s LEFT JOIN first_customer f ON s.CustomerID = f.CustomerID
    UNION ALL
    SELECT f.CustomerID, f.FullName, f.City, f.Email, {LOADED}, 'databricks', {LATER},
           'Databricks-Updated', 0
    FROM first_customer f JOIN silver_customer s ON s.CustomerID = f.CustomerID
    WHERE NOT {_SAME_CUSTOMER}"""
_FIRST_CUSTOMER = _first("customer", "ModifiedDate")


# Damage done to the raw files, see queries.py.
_BAD_PRICE = "ProductID % 37 = 1"
_BAD_KEY = "ProductID % 41 = 2"
_CSV_PRODUCTS = {
    "csv_products": """
        SELECT p_partkey AS ProductID, p_name AS ProductName, p_type AS Category,
               p_size AS Price, TIMESTAMP '1998-01-01' + to_days(p_size) AS ModifiedDate
        FROM part"""
}
_CSV_LINE = """'"' || {key} || '","' || ProductName || '","' || Category || '","' || {price}
    || '","' || strftime(ModifiedDate, '%Y-%m-%d %H:%M:%S') || '"'"""

_SHORT_LINE = "o_orderkey % 37 = 5"
_LONG_LINE = "o_orderkey % 31 = 7"
_JSON_BAD_DATE = "o_orderkey % 43 = 3"
_JSON_BROKEN = "o_orderkey % 47 = 5"


def oracle_sql() -> dict[str, str]:
    sql = {
        "high_water_mark": "SELECT max(ts)::TIMESTAMP AS max FROM events",
        "incremental_pull": """SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type, value,
            props FROM events WHERE ts > TIMESTAMP '2024-01-15'""",
        "watermark_advance": """
            SELECT 1 AS ID, 'Orders' AS TABLENAME, 'o_orderdate' AS DELTACOL,
                   max(o_orderdate)::TIMESTAMP AS LASTPROCESSEDVALUE FROM orders
            UNION ALL SELECT 2, 'LineItem', 'l_shipdate', max(l_shipdate)::TIMESTAMP FROM lineitem
            UNION ALL SELECT 3, 'Events', 'ts', max(ts)::TIMESTAMP FROM events
            UNION ALL SELECT 4, 'Broken', 'ts', TIMESTAMP '1900-01-01'""",
        "copy_audit": """
            SELECT 1 AS ID, 'Orders' AS TABLENAME, 'sales' AS SCHEMANAME, count(*) AS ROWREAD,
                   count(*) AS ROWCOPIED, false AS failed FROM orders
            UNION ALL SELECT 2, 'LineItem', 'sales', count(*), count(*), false FROM lineitem
            UNION ALL SELECT 3, 'Events', 'sales', count(*), count(*), false FROM events
            UNION ALL SELECT 4, 'Broken', 'sales', NULL, NULL, true""",
        "incremental_land": """SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type, value,
            props FROM events""",
        "failed_copies": """
            SELECT unnest(['Orders', 'LineItem', 'Events']) AS TABLENAME,
                   'No error message available' AS ERRORMESSAGE
            UNION ALL SELECT 'Broken', 'PATH_NOT_FOUND'""",
        "log_times": """SELECT event_id,
            timezone('America/New_York', timezone('UTC', ts::TIMESTAMP)) AS LOGTIME FROM events""",
        "feed_land": _with("SELECT * FROM raw_payment", raw=("raw_payment",)),
        "feed_land_shipping": _with("SELECT * FROM raw_shipping", raw=("raw_shipping",)),
        "feed_land_inventory": _with("SELECT * FROM raw_inventory", raw=("raw_inventory",)),
        "csv_quarantine_good": _with(
            f"""SELECT ProductID, {title("ProductName")} AS ProductName,
                       {title("Category")} AS Category, Price::DOUBLE AS Price, ModifiedDate,
                       'LOW' AS price_category, TIMESTAMP '2026-01-01' AS ingestion_timestamp
                FROM csv_products
                WHERE ProductID <> 0 AND NOT ({_BAD_PRICE}) AND NOT ({_BAD_KEY})""",
            extra=_CSV_PRODUCTS,
        ),
        "csv_quarantine_bad": _with(
            f"""SELECT CASE WHEN {_BAD_KEY} THEN NULL ELSE ProductID END AS ProductID,
                       {_CSV_LINE.format(
                           key=f"CASE WHEN {_BAD_KEY} THEN 'x' ELSE '' END || ProductID",
                           price=f"CASE WHEN {_BAD_PRICE} THEN 'n/a' ELSE Price::VARCHAR END",
                       )} AS _corrupt_record, TIMESTAMP '2026-01-01' AS error_time
                FROM csv_products WHERE {_BAD_PRICE} OR {_BAD_KEY}""",
            extra=_CSV_PRODUCTS,
        ),
        "csv_quarantine_key_first": _with(
            f"""SELECT ProductID,
                       {_CSV_LINE.format(key="ProductID", price="'n/a'")} AS _corrupt_record,
                       TIMESTAMP '2026-01-01' AS error_time
                FROM csv_products
                WHERE ProductID <> 0 AND {_BAD_PRICE} AND NOT ({_BAD_KEY})""",
            extra=_CSV_PRODUCTS,
        ),
        "json_quarantine_good": f"""
            SELECT o_orderkey AS payment_id, o_totalprice AS amount, o_orderkey AS order_id,
                   'Card' AS payment_method, upper(o_orderstatus) AS payment_status,
                   0 AS is_success, NULL::TIMESTAMP AS modified_date,
                   NULL::TIMESTAMP AS payment_time,
                   TIMESTAMP '2026-01-01' AS ingestion_timestamp
            FROM orders
            WHERE o_orderkey <> 0 AND NOT ({_JSON_BAD_DATE}) AND NOT ({_JSON_BROKEN})""",
        "json_quarantine_bad": f"""
            SELECT CASE WHEN NOT ({_JSON_BROKEN}) THEN o_orderkey END AS payment_id,
                   CASE WHEN {_JSON_BROKEN} THEN '{{broken ' || o_orderkey
                        ELSE '{{"payment_id":' || o_orderkey || ',"payment_time":"someday"}}'
                   END AS _corrupt_record, TIMESTAMP '2026-01-01' AS error_time
            FROM orders WHERE {_JSON_BAD_DATE} OR {_JSON_BROKEN}""",
        "dropped_file_split": """
            SELECT 'to_load' AS status, count(*) AS n_rows
            FROM (SELECT (row_number() OVER () - 1) // 2000 AS file FROM events) GROUP BY file
            UNION ALL SELECT 'empty', 0""",
        "one_dropped_file": """SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type, value,
            props FROM events ORDER BY event_id LIMIT 2000""",
        "drop_stream_landed": f"""
            SELECT o_orderkey::VARCHAR AS OrderID, o_custkey::VARCHAR AS CustomerID,
                   o_orderstatus AS status
            FROM orders WHERE NOT ({_SHORT_LINE}) AND NOT ({_LONG_LINE})""",
        "drop_stream_quarantine": f"""
            SELECT o_orderkey || ',' || o_custkey
                   || CASE WHEN {_SHORT_LINE} THEN '' ELSE ',' || o_orderstatus || ',more' END
                     AS _corrupt_record
            FROM orders WHERE {_SHORT_LINE} OR {_LONG_LINE}""",
        "named_view_scan": "SELECT * FROM supplier",
        "catalog_scan": "SELECT * FROM supplier",
        "schema_scan": "SELECT * FROM supplier",
        "format_scan": "SELECT * FROM supplier",
        "appended_table": _with(
            """SELECT StoreID, StoreName, City, Province, region
               FROM silver_stores, range(2)""", "stores"
        ),
        "dropped_file_scan": """SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type, value,
            props FROM events""",
        "file_drop_stream": """SELECT event_id, ts::TIMESTAMP AS ts, user_id, event_type, value,
            props FROM events""",
        "upsert_stream": _latest(
            """SELECT user_id, event_type, value, ts::TIMESTAMP AS ts, event_id FROM events""",
            "user_id", "ts", ["event_id"],
        ),
        "valid_pk": "SELECT * FROM customer WHERE c_custkey IS NOT NULL AND c_custkey <> 0",
        "fk_not_null": _with(
            """SELECT * FROM raw_orders WHERE CustomerID IS NOT NULL AND StoreID IS NOT NULL""",
            raw=("raw_orders",),
        ),
        "rule_non_negative": _with(
            "SELECT * FROM raw_products WHERE Price >= 0", raw=("raw_products",)
        ),
        "rule_line": _with(
            "SELECT * FROM raw_lines WHERE Quantity > 0 AND TotalAmount >= 0", raw=("raw_lines",)
        ),
        "keep_latest": _latest(
            "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, "
            "l_shipdate::TIMESTAMP AS l_shipdate FROM lineitem",
            "l_orderkey, l_linenumber", "l_shipdate",
            ["l_extendedprice", "l_partkey", "l_suppkey"],
        ),
        "merge_latest": _with(f"SELECT *, {LOADED} AS ingestion_timestamp FROM silver_orders", "orders"),
        "fact_sales": _on_fact(f"SELECT *, {LOADED} AS created_at FROM fact"),
        "dim_store": _with(
            "SELECT StoreID, StoreName, City, Province, region FROM silver_stores", "stores"
        ),
        "dim_payment": _with(
            "SELECT payment_id, payment_method, payment_status, payment_time, is_success "
            "FROM silver_payment", "payment",
        ),
        "dim_shipment": _with(
            "SELECT shipment_id, carrier, delivery_date, order_id, shipment_date, "
            "shipment_status, delivery_days, is_delivered, business_status "
            "FROM silver_shipping", "shipping",
        ),
        "dim_inventory": _with(
            "SELECT inventory_id, product_id, store_id, stock_quantity, last_restock_date "
            "FROM silver_inventory", "inventory",
        ),
        "scd1_product": _with(SCD1, "products", extra={"product_target": PRODUCT_TARGET}),
        "scd1_product_by_hash": _with(
            SCD1_BY_HASH, "products", extra={"product_target": PRODUCT_TARGET}
        ),
        "scd2_customer": _with(SCD2, "customer", extra={"customer_target": CUSTOMER_TARGET}),
        "scd2_customer_all_versions": _with(
            SCD2_HISTORY, "customer", extra={"customer_target": CUSTOMER_TARGET}
        ),
        "scd2_changed_keys": _with(
            """SELECT s.CustomerID AS MergeKey, s.CustomerID, s.FullName, s.City, s.Email
               FROM silver_customer s JOIN customer_target t
                 ON s.CustomerID = t.CustomerID AND t.IS_ACTIVE = 1
               WHERE s.City IS DISTINCT FROM t.City""",
            "customer", extra={"customer_target": CUSTOMER_TARGET},
        ),
        "kpi_daily_sales": _on_fact(
            f"""SELECT OrderDate, {_money("SalesAmount")} AS total_revenue,
                       count(DISTINCT OrderID) AS total_orders,
                       sum(Quantity)::BIGINT AS total_quantity,
                       {_money("SalesAmount")} / count(SalesAmount) AS avg_order_value
                FROM fact GROUP BY OrderDate"""
        ),
        "kpi_product": _on_fact(
            f"""SELECT d.ProductName, d.Category, {_money("f.SalesAmount")} AS total_sales,
                       sum(f.Quantity)::BIGINT AS total_quantity
                FROM fact f JOIN silver_products d ON f.ProductID = d.ProductID
                GROUP BY d.ProductName, d.Category""",
            "products",
        ),
        "kpi_customer": _customer_kpi(""),
        "kpi_customer_active": _customer_kpi("AND d.IS_ACTIVE = 1"),
        "kpi_store": _on_fact(
            f"""SELECT d.StoreName, d.City, {_money("f.SalesAmount")} AS total_sales,
                       count(DISTINCT f.OrderID) AS total_orders
                FROM fact f JOIN silver_stores d ON f.StoreID = d.StoreID
                GROUP BY d.StoreName, d.City""",
            "stores",
        ),
        "kpi_delivery": _on_fact(
            """SELECT sum(delivery_days)::DOUBLE / count(delivery_days) AS avg_delivery_time,
                      (count(*) FILTER (WHERE is_delivered = 1))::BIGINT AS delivered_orders,
                      (count(*) FILTER (WHERE is_delivered = 0))::BIGINT AS pending_orders
               FROM fact"""
        ),
        "kpi_payment": _on_fact(
            """SELECT (count(*) FILTER (WHERE is_success = 1)) * 100.0::DOUBLE
                      / count(*) AS success_rate FROM fact"""
        ),
        "kpi_monthly": _on_fact(
            f"""SELECT year(OrderDate)::INTEGER AS year, month(OrderDate)::INTEGER AS month,
                       {_money("SalesAmount")} AS revenue
                FROM fact GROUP BY ALL"""
        ),
    }
    sql["appended_quarantine"] = (
        f"SELECT ProductID::BIGINT AS key, _corrupt_record, error_time "
        f"FROM ({sql['csv_quarantine_bad']}) UNION ALL "
        f"SELECT payment_id::BIGINT, _corrupt_record, error_time FROM ({sql['json_quarantine_bad']})"
    )
    sql["lakehouse_run"] = sql["lakehouse_daily_sales"] = sql["kpi_daily_sales"]
    sql["lakehouse_product_kpi"], sql["lakehouse_store_kpi"] = sql["kpi_product"], sql["kpi_store"]
    for name in ("store", "inventory", "payment", "shipment"):
        sql[f"lakehouse_dim_{name}"] = sql[f"dim_{name}"]
    sql["lakehouse_second_batch"] = _on_fact("SELECT * FROM fact")
    sql["lakehouse_after_failed_batch"] = sql["lakehouse_second_batch"]
    sql["lakehouse_dim_product"] = _with(
        LAKE_PRODUCT, "products", extra=_first("products", "ModifiedDate")
    )
    sql["lakehouse_customer_history"] = _with(LAKE_CUSTOMER, "customer", extra=_FIRST_CUSTOMER)
    sql["lakehouse_customer_kpi"] = _customer_kpi(
        "", {**_FIRST_CUSTOMER, "dim_customer": LAKE_CUSTOMER}
    )
    sql["silver_new_column"] = _with(
        """SELECT s.*, CASE WHEN s.payment_id % 2 = 0 AND (f.payment_id IS NULL
                                 OR s.modified_date > f.modified_date) THEN 'CAD' END AS currency
           FROM silver_payment s LEFT JOIN first_payment f ON s.payment_id = f.payment_id""",
        "payment", extra=_first("payment", "modified_date"),
    )
    sql["silver_wider_type"] = _with(
        "SELECT * REPLACE (Quantity::BIGINT AS Quantity) FROM silver_lines", "lines"
    )
    names = {"lines": "orderdetails"}
    for name in SILVER:
        sql[f"silver_{names.get(name, name)}"] = _with(
            f"SELECT *, {LOADED} AS ingestion_timestamp FROM silver_{name}", name
        )
    return sql
