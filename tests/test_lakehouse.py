"""Two runs over the whole chain, the second one with changes of every kind."""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import replace

import pytest
from conftest import no_more_shuffle_files, rows, shuffle_files
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators import watermark_seed
from tidemark.plans import SILVER, IngestFailed, Lakehouse, gold, ingest
from tidemark.plans.lakehouse import _of_like_size
from tidemark.sources import current_version
from tidemark.sources.versions import finished_versions, state_versions

UTC = dt.timezone.utc


def at(day, month=1):
    return dt.datetime(2026, month, day, tzinfo=UTC)


def sources(spark, tables):
    kinds = {
        "Customers": schemas.CUSTOMERS, "Products": schemas.PRODUCTS, "Stores": schemas.STORES,
        "Orders": schemas.ORDERS, "OrderDetails": schemas.ORDER_DETAILS,
        "payment": schemas.PAYMENT, "shipping": schemas.SHIPPING,
        "inventory": schemas.INVENTORY,
    }

    def read(name):
        return spark.createDataFrame(tables.get(name, []), kinds[name])

    return (lambda _, name: read(name)), read


FIRST = {
    "Customers": [(1, "Ann", "Lee", "X", "a@x", at(1)), (0, "No", "One", "X", None, at(1))],
    "Products": [(1, " usb hub", "parts", 600.0, at(1)), (2, "old", "parts", -1.0, at(1))],
    "Stores": [(1, "main", "x", "on", at(1))],
    "Orders": [(1, 1, 1, at(5), at(5)), (2, 1, 1, at(6, 2), at(6, 2)), (3, None, 1, at(5), at(5))],
    "OrderDetails": [(11, 1, 1, 2, 10.0, at(5)), (21, 2, 1, 1, 5.0, at(6, 2)),
                     (31, 3, 1, 1, 7.0, at(5)), (12, 1, 1, 0, 9.0, at(5))],
    "payment": [(1, 10.0, at(5), 1, "card", "success", at(5))],
    "shipping": [(1, "fast", dt.date(2026, 1, 8), at(5), 1, dt.date(2026, 1, 6), "delivered")],
    "inventory": [(1, 1, 1, 5, dt.date(2026, 1, 1), at(1))],
}

SECOND = {
    **FIRST,
    "Customers": [*FIRST["Customers"], (1, "Ann", "Lee", "Y", "a@x", at(9))],
    "Products": [*FIRST["Products"], (1, "usb hub", "parts", 100.0, at(9))],
    # Order 2 moves to January and leaves February empty.
    "Orders": [*FIRST["Orders"], (2, 1, 1, at(7), at(9, 3))],
    "OrderDetails": [*FIRST["OrderDetails"], (11, 1, 1, 2, 30.0, at(9, 3))],
    "payment": [*FIRST["payment"], (2, 5.0, at(9, 3), 2, "card", "failed", at(9, 3))],
}


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake"))
    Lakehouse(spark, path, "2026-03-01 00:00:00").run(1, *sources(spark, FIRST))
    first = state(Lakehouse(spark, path))
    assert first["fact"] == [(11, 10.0, 1, 1), (21, 5.0, None, None)]
    # The second run is repeated, as after a failure; the tests see its state once.
    for _ in range(2):
        Lakehouse(spark, path, "2026-04-01 00:00:00").run(2, *sources(spark, SECOND))
    return path


def state(lake):
    return {
        "fact": rows(lake.fact(), "OrderDetailID", "SalesAmount", "is_success", "is_delivered"),
        "customer": rows(lake.gold("dim_customer"), "CustomerID", "City", "IS_ACTIVE"),
        "product": rows(lake.gold("dim_product"), "ProductID", "Price", "price_category"),
        "store": rows(lake.gold("dim_store"), "StoreID", "Province", "region"),
        "daily": rows(lake.gold("gold_sales_summary"), "OrderDate", "total_revenue"),
    }


AFTER_SECOND = {
    "fact": [(11, 30.0, 1, 1), (21, 5.0, 0, None)],
    "customer": [(1, "X", 0), (1, "Y", 1)],
    "product": [(1, 100.0, "LOW")],
    "store": [(1, "ON", "EAST")],
    "daily": [(dt.date(2026, 1, 5), 30.0), (dt.date(2026, 1, 7), 5.0)],
}


def test_state_after_two_runs(spark, root):
    assert state(Lakehouse(spark, root)) == AFTER_SECOND


def test_second_run_pulled_news_only(spark, root):
    log = spark.read.parquet(f"{root}/control/log/batch=2")
    assert rows(log, "ID", "TABLENAME", "ROWCOPIED", "ERRORMESSAGE") == [
        (6, "Customers", 1, None), (7, "Products", 1, None), (8, "Stores", 0, None),
        (9, "Orders", 1, None), (10, "OrderDetails", 1, None),
    ]
    feeds = spark.read.parquet(f"{root}/control/feed_log/batch=2")
    assert rows(feeds, "TABLENAME", "ROWREAD") == [
        ("inventory", 1), ("payment", 2), ("shipping", 1),
    ]


def test_unchanged_rows_keep_their_load_time(spark, root):
    lake = Lakehouse(spark, root)
    loaded = F.month("ingestion_timestamp")
    assert rows(lake.silver("payment"), "payment_id", loaded) == [(1, 3), (2, 4)]
    assert rows(lake.silver("orderdetails"), "OrderDetailID", loaded) == [
        (11, 4), (21, 3), (31, 3),
    ]


def test_closed_versions_are_stored_once(spark, root):
    folder = f"{root}/gold/dim_customer"
    closed = spark.read.parquet(f"{folder}/closed")
    assert rows(closed, "version", "City", "IS_ACTIVE") == [(2, "X", 0)]
    assert current_version(spark, f"{root}/control/watermark") == 2


def test_prune_keeps_the_state_and_the_history(spark, root):
    lake = Lakehouse(spark, root)
    before = state(lake)
    lake.prune(keep=1)
    assert state(Lakehouse(spark, root)) == before
    assert state_versions(spark, f"{root}/silver/orders") == [2]
    assert finished_versions(spark, f"{root}/gold/gold_customer_kpi") == [2]


def lake(spark, tmp_path, day=1, part_bytes=50_000):
    return Lakehouse(
        spark, str(tmp_path / "lake"), f"2026-05-{day:02d} 00:00:00", part_bytes=part_bytes
    )


def test_a_failed_batch_loses_nothing(spark, tmp_path, monkeypatch):
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    first = state(lake(spark, tmp_path))
    with monkeypatch.context() as patched:
        patched.setattr(Lakehouse, "build_kpis", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake(spark, tmp_path, 2).run(2, *sources(spark, SECOND))
    assert state(lake(spark, tmp_path)) == first
    lake(spark, tmp_path, 3).run(3, *sources(spark, SECOND))
    assert state(lake(spark, tmp_path)) == AFTER_SECOND


def test_a_batch_without_changes(spark, tmp_path):
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    first = state(lake(spark, tmp_path))
    lake(spark, tmp_path, 2).run(2, *sources(spark, FIRST), compact=True)
    lake(spark, tmp_path, 3).run(3, *sources(spark, FIRST))
    done = lake(spark, tmp_path)
    assert state(done) == first
    # The months that no batch touched are those of the first batch.
    for name in ("fact_sales", "gold_sales_summary", "sums/customer", "sums/product"):
        assert done.state(f"gold/{name}").parts == {"2026-01": 1, "2026-02": 1}


def test_a_batch_reads_and_refreshes_what_it_touches(spark, tmp_path):
    tables = {**FIRST, "Orders": [(i, 1, 1, at(5, 1 + i % 5), at(5)) for i in range(1, 300)],
              "OrderDetails": [(i * 8, i, 1, 1, 2.0, at(5)) for i in range(1, 300)]}
    lake(spark, tmp_path, 1, 2_000).run(1, *sources(spark, tables))
    later = {**tables, "OrderDetails": [*tables["OrderDetails"], (7 * 8, 7, 1, 1, 9.0, at(9, 3))]}
    lake(spark, tmp_path, 2, 2_000).run(2, *sources(spark, later))
    done = lake(spark, tmp_path)
    months = {"2026-01": 1, "2026-02": 1, "2026-03": 2, "2026-04": 1, "2026-05": 1}
    for name in ("fact_sales", "gold_sales_summary", "sums/store"):
        assert done.state(f"gold/{name}").parts == months
    assert rows(done.gold("gold_sales_summary"), F.sum("total_revenue")) == [(605.0,)]
    assert rows(done.gold("gold_store_performance"), "total_sales", "total_orders") == [(605.0, 299)]
    # One part was rewritten, and split if it had become too large.
    by_order = done.state("gold/by_order/orderdetails").parts
    assert sum(version == 2 for version in by_order.values()) <= 2 < len(by_order) / 2
    seven = spark.createDataFrame([(7,)], "OrderID long")
    found = done.of_orders("orderdetails", seven)
    assert len(found.inputFiles()) == 1
    assert rows(found.filter("OrderID = 7"), "OrderDetailID", "TotalAmount") == [(56, 9.0)]


def test_a_line_that_moves_to_another_order(spark, tmp_path):
    """The copy by order gives the line up where it was."""
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    moved = {**FIRST, "OrderDetails": [*FIRST["OrderDetails"], (11, 2, 1, 2, 10.0, at(9, 3))]}
    lake(spark, tmp_path, 2).run(2, *sources(spark, moved))
    fact = lake(spark, tmp_path).fact()
    assert rows(fact, "OrderDetailID", "OrderID") == [(11, 2), (21, 2)]


def test_closed_versions_are_joined_by_size():
    """Few parts after many batches, and each version is rewritten a few times only."""
    sizes, rewritten, most = {}, 0, 0
    for batch in range(64):
        joined = _of_like_size(sizes, 100)
        rewritten += sum(sizes[p] for p in joined)
        sizes[f"batch-{batch}"] = 100 + sum(sizes.pop(p) for p in joined)
        most = max(most, len(sizes))
    assert most <= 6 and rewritten <= 64 * 100 * 6


def test_closed_versions_of_many_batches(spark, tmp_path):
    tables = FIRST
    for batch in range(1, 4):
        row = (1, "Ann", "Lee", f"City {batch}", "a@x", at(batch, 2))
        tables = {**tables, "Customers": [*tables["Customers"], row]}
        lake(spark, tmp_path, batch).run(batch, *sources(spark, tables))
    done = lake(spark, tmp_path)
    assert rows(done.gold("dim_customer"), "City", "IS_ACTIVE") == [
        ("City 1", 0), ("City 2", 0), ("City 3", 1)
    ]
    assert len(done.state("gold/dim_customer/closed").parts) == 1


def test_undated_orders_come_and_go_once(spark, tmp_path):
    undated = {**FIRST, "Orders": [*FIRST["Orders"], (4, 1, 1, None, at(8))],
               "OrderDetails": [*FIRST["OrderDetails"], (41, 4, 1, 1, 4.0, at(8))]}
    more = {**undated, "OrderDetails": [*undated["OrderDetails"], (42, 4, 1, 1, 6.0, at(9, 3))]}
    dated = {**more, "Orders": [*more["Orders"], (4, 1, 1, at(5, 3), at(10, 3))]}
    shown = []
    for batch, tables in enumerate((undated, more, dated), start=1):
        lake(spark, tmp_path, batch).run(batch, *sources(spark, tables))
        fact = lake(spark, tmp_path).fact().filter("OrderID = 4")
        shown.append(rows(fact, "OrderDetailID", "SalesAmount", F.month("OrderDate")))
    assert shown == [
        [(41, 4.0, None)], [(41, 4.0, None), (42, 6.0, None)], [(41, 4.0, 3), (42, 6.0, 3)],
    ]


def test_empty_tables_and_line_breaks(spark, tmp_path):
    tables = {**FIRST, "Stores": [],
              "Products": [(1, "usb\n hub 5%0A", "a\r\nb", 600.0, at(1))]}
    lake(spark, tmp_path).run(1, *sources(spark, tables))
    done = lake(spark, tmp_path)
    assert done.silver("stores").count() == 0 and done.gold("dim_store").count() == 0
    assert rows(done.silver("products"), "ProductName", "Category") == [
        ("Usb\n Hub 5%0a", "A\r\nb")
    ]
    assert spark.read.parquet(f"{tmp_path}/lake/quarantine/products").count() == 0


def test_a_failed_copy_is_logged_and_ends_the_run(spark, tmp_path):
    tables, feeds = sources(spark, FIRST)

    def broken(name):
        if name == "shipping":
            raise OSError("no route to the feed")
        return feeds(name)

    with pytest.raises(IngestFailed, match="no route to the feed"):
        lake(spark, tmp_path).run(1, tables, broken)
    log = spark.read.parquet(f"{tmp_path}/lake/control/feed_log")
    assert rows(log.filter("ERRORMESSAGE IS NOT NULL"), "TABLENAME") == [("shipping",)]
    with pytest.raises(ValueError, match="nothing published"):
        lake(spark, tmp_path).fact()


def test_a_new_column_reaches_silver(spark, tmp_path):
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    known = SILVER["payment"].schema
    wider = replace(
        SILVER["payment"], schema=T.StructType([*known.fields, T.StructField("currency", T.StringType())])
    )
    second = lake(spark, tmp_path, 2)
    second.specs = {**SILVER, "payment": wider}
    tables, feeds = sources(spark, FIRST)
    new = spark.createDataFrame(
        [(9, 1.0, at(9), 1, "card", "failed", at(9), "CAD")], wider.schema
    )
    second.run(2, tables, lambda n: new if n == "payment" else feeds(n))
    found = lake(spark, tmp_path).silver("payment")
    assert rows(found, "payment_id", "currency") == [(1, None), (9, "CAD")]


def test_a_row_lost_on_the_way_shows_in_the_log(spark, tmp_path, monkeypatch):
    def lossy(df, path):
        return ingest.write_csv(df.filter("OrderID <> 2"), path, coded_breaks=True)

    monkeypatch.setattr(ingest, "write_coded_csv", lossy)
    control = watermark_seed(spark).filter("TABLENAME = 'Orders'")
    done = ingest.ingest_increments(
        spark, control, sources(spark, FIRST)[0], str(tmp_path / "raw"), 1
    )
    assert rows(done.audit, "ROWREAD", "ROWCOPIED") == [(3, 2)]


def test_a_first_batch_stages_each_table_once(spark, tmp_path, monkeypatch):
    """Clean rows and the copies by order go where they stay, not through the staging folder."""
    staged, stage = [], Lakehouse._stage
    monkeypatch.setattr(
        Lakehouse, "_stage", lambda self, df, name: (staged.append(name), stage(self, df, name))[1]
    )
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    assert sorted(staged) == sorted(
        [*(f"parsed/{name}" for name in SILVER), "merged/dim_customer", "closed/dim_customer"]
    )
    assert rows(lake(spark, tmp_path).fact(), "OrderDetailID") == [(11,), (21,)]


def test_a_batch_leaves_no_shuffle_files(spark, tmp_path):
    """They would be kept until the driver's next garbage collection, for all steps at once."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(setting)
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    lake(spark, tmp_path, 2).run(2, *sources(spark, SECOND))
    assert no_more_shuffle_files(spark, before) and spark.conf.get(setting) == was
    assert state(lake(spark, tmp_path)) == AFTER_SECOND


def test_staged_copies_go_as_soon_as_they_are_used(spark, tmp_path, monkeypatch):
    seen, staging = [], tmp_path / "lake" / "staging"
    build_gold = Lakehouse.build_gold

    def parquet():
        return [str(p) for p in staging.rglob("*.parquet")]

    def stop(self):
        seen.append(parquet())
        raise ZeroDivisionError

    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    with monkeypatch.context() as patched:
        patched.setattr(Lakehouse, "build_gold", lambda self: (seen.append(parquet()), build_gold(self)))
        patched.setattr(Lakehouse, "build_kpis", stop)
        with pytest.raises(ZeroDivisionError):
            lake(spark, tmp_path, 2).run(2, *sources(spark, SECOND))
    assert seen == [[], []]
    # What a batch that failed has staged is gone before the next one lands its sources.
    (staging / "parsed").mkdir(parents=True, exist_ok=True)
    (staging / "parsed" / "left.parquet").write_bytes(b"x")
    ingest_ = Lakehouse.ingest
    monkeypatch.setattr(
        Lakehouse, "ingest", lambda self, *a: (seen.append(staging.exists()), ingest_(self, *a))[1]
    )
    lake(spark, tmp_path, 3).run(3, *sources(spark, SECOND))
    assert seen[2:] == [False] and not staging.exists()
    assert state(lake(spark, tmp_path)) == AFTER_SECOND


def test_the_copy_by_order_has_the_columns_of_the_fact_only(spark, tmp_path, monkeypatch):
    """Also where an earlier batch stored more columns of the silver table."""
    with monkeypatch.context() as patched:
        wide = (*gold.FACT_COLUMNS["payment"], "payment_method")
        patched.setitem(gold.FACT_COLUMNS, "payment", wide)
        lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    first = lake(spark, tmp_path)
    assert "payment_method" in first.state("gold/by_order/payment").schema.names
    lake(spark, tmp_path, 2).run(2, *sources(spark, SECOND))
    done = lake(spark, tmp_path)
    assert state(done) == AFTER_SECOND
    for name, columns in gold.FACT_COLUMNS.items():
        assert done.state(f"gold/by_order/{name}").schema.names == list(columns)


def test_few_tables_are_shuffled_at_a_time(spark, tmp_path, monkeypatch):
    running, seen, lock = [], [], threading.Lock()

    def watched(name):
        step = getattr(Lakehouse, name)

        def run(self, *args):
            with lock:
                running.append(name)
                seen.append(running.count(name))
            try:
                return step(self, *args)
            finally:
                with lock:
                    running.remove(name)

        monkeypatch.setattr(Lakehouse, name, run)

    for name in ("refine_table", "build_by_order", "_refresh"):
        watched(name)
    lake(spark, tmp_path).run(1, *sources(spark, FIRST))
    assert len(seen) == len(SILVER) + 3 + 4 and max(seen) <= 2
