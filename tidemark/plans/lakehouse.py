"""The whole run: raw files, silver tables, star schema, KPI tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import stamp
from ..operators.control import watermark_seed
from ..operators.latest import merge_versions
from ..session import listed_by_few_tasks, run_together, shuffles_dropped
from ..sources.sinks import quarantine
from ..sources.versions import (
    ALL_KEYS,
    CODEC,
    PART_BYTES,
    State,
    current_version,
    drop_newer,
    drop_old_states,
    drop_old_versions,
    finished_versions,
    folder_bytes,
    folder_exists,
    load_state,
    merge_parts,
    parts_of,
    publish,
    read_parts,
    remove_folder,
    stored_bytes,
    union_schema,
    version_path,
    widened,
    write_parts,
)
from . import gold, kpi
from .ingest import ingest_feeds, ingest_increments, require_success
from .silver import SILVER, SilverSpec, refine, rejected, sound, versions

# Silver table -> name of its relational source; the others are feeds.
RELATIONAL = {
    "products": "Products",
    "customer": "Customers",
    "orders": "Orders",
    "orderdetails": "OrderDetails",
    "stores": "Stores",
}

# Inputs of the fact, in its order, with their key and their order column.
FACT_INPUTS = {
    "orderdetails": ("OrderDetailID", "OrderID"),
    "orders": ("OrderID", "OrderID"),
    "payment": ("payment_id", "order_id"),
    "shipping": ("shipment_id", "order_id"),
}

# Silver tables whose columns of the fact are kept a second time by order, so that the rows
# of touched orders are found in a few parts. Orders are dealt by their key, which is the
# order, as it is.
BY_ORDER = tuple(gold.FACT_COLUMNS)

# Steps at a time that shuffle whole tables: each keeps its shuffle files until it is stored.
SHUFFLING_AT_ONCE = 2

# Touched orders are few if their stored list takes so many bytes at most: then it is sent to
# the rows of every fact input, else the orders alone are reduced to it.
FEW_ORDERS_BYTES = 1 << 20

# Order of the rows in a file of the fact: what an order's rows share lies together.
FACT_ORDER = ("OrderID", "OrderDetailID")

# Sums of the fact by month that KPIs add up, with their key.
SUMS = {"product": "ProductID", "customer": "CustomerID", "store": "StoreID"}

# Gold tables whose newest version is the whole table, and those kept in parts.
GOLD_TABLES = (
    "dim_store", "dim_inventory", "dim_payment", "dim_shipment",
    "gold_product_performance", "gold_customer_kpi", "gold_store_performance",
)
GOLD_STATES = (
    "fact_sales", "gold_sales_summary", "dim_product", "dim_customer/open", "dim_customer/closed",
    *(f"by_order/{name}" for name in BY_ORDER), *(f"sums/{name}" for name in SUMS),
)


@dataclass
class Lakehouse:
    """Folders of one installation and the steps of one run, each repeatable by batch.

    A batch counts once its marks are published, which is its last step. Until then
    readers see the state of the batch before, and a later batch starts from that state
    too: what a failed batch left is neither read nor added to, and its sources are
    pulled again. Every layer is stored before the next reads it, so a lost executor
    costs the repetition of a step at most. ``as_of`` is the load time of the run.
    """

    spark: SparkSession
    root: str
    as_of: object = field(default_factory=lambda: datetime.now(timezone.utc))
    specs: Mapping[str, SilverSpec] = field(default_factory=lambda: SILVER)
    part_bytes: int = PART_BYTES
    keep: int = 2
    _batch: int | None = field(default=None, init=False)
    _last: int | None = field(default=None, init=False)  # last finished batch
    _compact: bool = field(default=False, init=False)

    def silver(self, name: str) -> DataFrame:
        return self._read(f"silver/{name}")

    def gold(self, name: str) -> DataFrame:
        if name == "dim_customer":
            closed = self._read(f"gold/{name}/closed")
            return self._read(f"gold/{name}/open").unionByName(closed)
        if name in GOLD_STATES:
            return self._read(f"gold/{name}")
        root = f"{self.root}/gold/{name}"
        done = [v for v in finished_versions(self.spark, root) if self._counts(v)]
        if not done:
            raise ValueError(f"nothing published under {root}")
        return self.spark.read.parquet(version_path(root, done[-1]))

    def fact(self) -> DataFrame:
        return self._read("gold/fact_sales")

    def state(self, folder: str) -> State | None:
        """Parts of a table as the last finished batch, or the current one, left them."""
        return load_state(self.spark, f"{self.root}/{folder}", self._counts)

    def run(
        self,
        batch: int,
        read_table: Callable[[str, str], DataFrame],
        read_feed: Callable[[str], DataFrame],
        compact: bool = False,
    ) -> None:
        """Ingest, refine and publish one batch, layer after layer.

        A layer is built only if all of the one before succeeded; a failed copy is
        logged and ends the run. The newest batch may be repeated, but no earlier one.
        ``compact`` gathers the closed customer versions of all batches in one part.
        """
        newest = current_version(self.spark, self._control)
        if newest is not None and newest > batch:
            raise ValueError(f"batch {newest} is already there")
        self._batch, self._compact = batch, compact
        self._last = current_version(self.spark, self._control, before=batch)
        try:
            self._drop_unfinished()
            # Every step is stored, and a state may lie in thousands of folders.
            with shuffles_dropped(self.spark), listed_by_few_tasks(self.spark):
                control, paths = self.ingest(batch, read_table, read_feed)
                sizes = {name: folder_bytes(self.spark, path) for name, path in paths.items()}
                # The largest first, so that none of them is left to run alone at the end.
                names = sorted(self.specs, key=lambda name: -sizes.get(name, 0))
                run_together(
                    self.spark,
                    [partial(self.refine_table, self.specs[n], paths.get(n)) for n in names],
                    SHUFFLING_AT_ONCE,
                )
                self.build_gold()
                self.build_kpis()
                publish(control, self._control, batch)
        finally:
            self._batch = None
        self._last = batch
        remove_folder(self.spark, self._staging)
        self.prune(self.keep)

    def ingest(
        self,
        batch: int,
        read_table: Callable[[str, str], DataFrame],
        read_feed: Callable[[str], DataFrame],
    ) -> tuple[DataFrame, dict[str, str]]:
        """Land the batch: the moved marks, and the raw folder per silver table with rows."""
        before = current_version(self.spark, self._control, before=batch)
        control = (
            watermark_seed(self.spark)
            if before is None
            else self.spark.read.parquet(version_path(self._control, before))
        )
        log, feed_log = f"{self.root}/control/log", f"{self.root}/control/feed_log"
        tables, feeds = run_together(
            self.spark,
            [
                partial(ingest_increments, self.spark, control, read_table,
                        f"{self.root}/raw/tables", batch, self._next_log_id(log, batch)),
                partial(ingest_feeds, self.spark, read_feed, f"{self.root}/raw/feeds", batch,
                        next_log_id=self._next_log_id(feed_log, batch)),
            ],
        )
        tables.audit.write.mode("overwrite").parquet(f"{log}/batch={batch}")
        feeds.audit.write.mode("overwrite").parquet(f"{feed_log}/batch={batch}")
        require_success(tables.audit, feeds.audit)
        landed = {
            silver: tables.paths[source]
            for silver, source in RELATIONAL.items()
            if source in tables.paths
        }
        return tables.control, {**landed, **feeds.paths}

    def _next_log_id(self, log: str, batch: int) -> int:
        if not folder_exists(self.spark, log):
            return 1
        earlier = self.spark.read.parquet(log).filter(F.col("batch") < batch)
        return (earlier.agg(F.max("ID")).first()[0] or 0) + 1

    def refine_table(self, spec: SilverSpec, path: str | None) -> None:
        """Silver state with one raw batch merged in, and its rejected records.

        The text is parsed once into a typed staging copy that both outputs read; all
        clean versions go from there into the state in one shuffle with its rows. Only the
        parts of the state with keys of the batch are rewritten; a column that is new in
        the batch is added to the state. Without a raw folder the state stays.
        """
        root, base = f"{self.root}/silver/{spec.name}", self._base(f"silver/{spec.name}")
        if path is None:
            if base is None:
                empty = refine(spec, self.spark.createDataFrame([], spec.schema), self.as_of).good
                write_parts(empty, root, self._batch, F.lit(ALL_KEYS), cover=[ALL_KEYS])
            return
        options = {"coded_breaks": True} if spec.format == "csv" else {}
        parsed = self._stage(spec.read(self.spark, path, **options), f"parsed/{spec.name}")
        good = versions(spec, parsed, self.as_of)
        bad = f"{self.root}/quarantine/{spec.name}/batch={self._batch}"
        remove_folder(self.spark, bad)
        quarantine(rejected(spec, parsed, self.as_of), bad)
        schema = union_schema(base.schema, good.schema) if base else good.schema
        merge_parts(
            self.spark, root, self._batch, widened(good, schema), spec.key,
            lambda stored, batch: merge_versions(stored, batch, spec.key, spec.version, spec.ties),
            base, schema, self.part_bytes, sound(spec, parsed),
        )
        self._unstage(f"parsed/{spec.name}")

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self._staging}/{name}/batch={self._batch}"
        df.write.mode("overwrite").parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def _unstage(self, *names: str) -> None:
        """Remove staged copies once what is made from them is stored."""
        for name in names:
            remove_folder(self.spark, f"{self._staging}/{name}")

    def changed(self, name: str) -> DataFrame:
        """Silver rows that this batch added or replaced; only parts it wrote are read."""
        state = self.state(f"silver/{name}")
        written = [part for part, version in state.parts.items() if version == self._batch]
        rows = read_parts(self.spark, f"{self.root}/silver/{name}", state, only=written)
        return rows.filter(F.col("ingestion_timestamp") == stamp(self.as_of))

    def before(self, name: str) -> DataFrame:
        """Silver rows as the batch before left them, of the parts this batch rewrote."""
        root, base = f"{self.root}/silver/{name}", self._base(f"silver/{name}")
        state = self.state(f"silver/{name}")
        return read_parts(self.spark, root, base, state.schema, _replaced(base, state))

    def build_gold(self) -> None:
        projections = {
            "dim_store": gold.dim_store(self.silver("stores")),
            "dim_inventory": gold.dim_inventory(self.silver("inventory")),
            "dim_payment": gold.dim_payment(self.silver("payment")),
            "dim_shipment": gold.dim_shipment(self.silver("shipping")),
        }
        run_together(
            self.spark,
            [
                self.build_fact,
                self.build_dim_product,
                self.build_dim_customer,
                *self._publications(projections),
            ],
        )

    def build_dim_product(self) -> None:
        """Only products that changed are merged, into the parts they lie in."""
        root = f"{self.root}/gold/dim_product"
        merge_parts(
            self.spark, root, self._batch, self.changed("products"), "ProductID",
            lambda stored, products: gold.dim_product(stored, products, self.as_of),
            self._base("gold/dim_product"), schemas.DIM_PRODUCT, self.part_bytes,
        )

    def build_dim_customer(self) -> None:
        """Customers that changed are merged with the open versions; what that closes is
        added to the closed ones as a part of its own.

        Closed parts of like size are joined on the way: each is rewritten a number of
        times that grows with the logarithm of all of them, and as few are left.
        """
        root, name = f"{self.root}/gold/dim_customer", "gold/dim_customer"
        changed = self.changed("customer")
        merged: list[DataFrame] = []

        def merge(stored: DataFrame, customers: DataFrame) -> DataFrame:
            versions = gold.dim_customer(stored, customers, self.as_of)
            merged.append(self._stage(versions, "merged/dim_customer"))
            return merged[0].filter("IS_ACTIVE = 1")

        merge_parts(
            self.spark, f"{root}/open", self._batch, changed, "CustomerID", merge,
            self._base(f"{name}/open"), schemas.DIM_CUSTOMER, self.part_bytes,
        )
        closed = merged[0].filter("IS_ACTIVE = 0")
        closed = self._stage(closed, "closed/dim_customer")
        base, part = self._base(f"{name}/closed"), f"batch-{self._batch}"
        if base is None or self._compact:
            joined = list(base.parts) if base else []
        else:
            joined = _of_like_size(base.sizes, stored_bytes(closed))
        if joined:
            stored = read_parts(self.spark, f"{root}/closed", base, only=joined)
            closed = closed.unionByName(stored)
        write_parts(closed, f"{root}/closed", self._batch, F.lit(part), base, [*joined, part])
        self._unstage("merged/dim_customer", "closed/dim_customer")

    def moved(self, name: str, columns: Iterable[str]) -> DataFrame:
        """Rows of a fact input that this batch added or replaced, marked ``_now``, and the
        replaced ones as they were."""
        key, _ = FACT_INPUTS[name]
        now = self.changed(name).select(*columns)
        before = self.before(name).select(*columns).join(now.select(key), key, "left_semi")
        return now.withColumn("_now", F.lit(True)).unionByName(
            before.withColumn("_now", F.lit(False))
        )

    def build_by_order(self, name: str) -> DataFrame | None:
        """The second copy of a silver table, dealt by order, of the columns that the fact
        takes. Only the parts of orders that changed rows belong to, now or before, are
        rewritten. Returns the moved rows, staged; None where there was no copy before."""
        (key, order), columns = FACT_INPUTS[name], gold.FACT_COLUMNS[name]
        stored_as = self.silver(name).schema
        folder = f"gold/by_order/{name}"
        base = self._base(folder)
        if base is None:
            source = self.silver(name).select(*columns).withColumn("_now", F.lit(True))
        else:
            source = self._stage(self.moved(name, columns), f"by_order/{name}")

        def exchange(stored: DataFrame, moved: DataFrame) -> DataFrame:
            kept = stored.join(moved.select(key).distinct(), key, "left_anti")
            now = moved.filter("_now").drop("_now")
            return kept.select(*now.columns).unionByName(now)

        merge_parts(
            self.spark, f"{self.root}/{folder}", self._batch, source, order, exchange,
            base, T.StructType([stored_as[c] for c in columns]), self.part_bytes, order=[key],
        )
        return None if base is None else source

    def of_orders(self, name: str, touched: DataFrame) -> DataFrame:
        """A fact input from the parts in which the given orders lie."""
        folder = "silver/orders" if name == "orders" else f"gold/by_order/{name}"
        state = self.state(folder)
        only = parts_of(touched, "OrderID", state.parts)
        return read_parts(self.spark, f"{self.root}/{folder}", state, only=only)

    def build_fact(self) -> None:
        """Store the fact; after the first batch only months with touched orders.

        Touched are the orders of changed rows, as they are now and as they were. Only
        their rows are built anew, from the parts they lie in; the other rows of their
        months are taken over.
        """
        copies = [partial(self.build_by_order, name) for name in BY_ORDER]
        staged = dict(zip(BY_ORDER, run_together(self.spark, copies, SHUFFLING_AT_ONCE)))
        root, base = f"{self.root}/gold/fact_sales", self._base("gold/fact_sales")
        if base is None:
            inputs = [self.silver(name) for name in FACT_INPUTS]
            fact = gold.fact_sales(*inputs, as_of=self.as_of)
            write_parts(fact, root, self._batch, gold.order_month(), order=FACT_ORDER)
            return
        changed = []
        for name, (key, order) in FACT_INPUTS.items():
            rows = staged.get(name)
            if rows is None:
                rows = self.moved(name, dict.fromkeys((key, order)))
            changed.append((rows, order))
        touched = self._stage(gold.touched_orders(changed), "touched_orders")
        self._unstage(*(f"by_order/{name}" for name in BY_ORDER))
        states = [self.of_orders("orders", touched), self.before("orders")]
        months = gold.months_of(states, touched)
        if not months:
            write_parts(self.fact().limit(0), root, self._batch, gold.order_month(), base, [])
            return
        inputs = [self.of_orders(name, touched) for name in FACT_INPUTS]
        rebuilt = gold.fact_sales(
            *inputs, as_of=self.as_of, only_orders=touched,
            many_orders=stored_bytes(touched) > FEW_ORDERS_BYTES,
        )
        stored = read_parts(self.spark, root, base, only=months)
        fact = gold.refreshed_months(stored, touched, rebuilt)
        write_parts(fact, root, self._batch, gold.order_month(), base, months, order=FACT_ORDER)
        self._unstage("touched_orders")

    def build_kpis(self) -> None:
        """KPI tables; the fact is read in the months that this batch rewrote, and their
        daily sales and sums take the place of the stored ones."""
        state = self.state("gold/fact_sales")
        months = _replaced(self._base("gold/fact_sales"), state)
        run_together(
            self.spark,
            [partial(self._refresh, name, state, months)
             for name in ("gold_sales_summary", *(f"sums/{name}" for name in SUMS))],
            SHUFFLING_AT_ONCE,
        )
        sums = {name: self._read(f"gold/sums/{name}") for name in SUMS}
        tables = {
            "gold_product_performance": kpi.product_totals(sums["product"], self.gold("dim_product")),
            "gold_customer_kpi": kpi.customer_totals(sums["customer"], self.gold("dim_customer")),
            "gold_store_performance": kpi.store_totals(sums["store"], self.gold("dim_store")),
        }
        run_together(self.spark, self._publications(tables))

    def _refresh(self, name: str, fact: State, months: list[str]) -> None:
        """Some months of a table that is kept by month beside the fact."""
        root, base = f"{self.root}/gold/{name}", self._base(f"gold/{name}")
        months = list(fact.parts) if base is None else months
        rows = read_parts(self.spark, f"{self.root}/gold/fact_sales", fact, only=months)
        month = gold.order_month()
        if name == "gold_sales_summary":
            write_parts(kpi.daily_sales(rows), root, self._batch, month, base, months)
            return
        sums, by = name.removeprefix("sums/"), month.alias("month")
        made = (
            kpi.product_sums(rows, by) if sums == "product" else kpi.order_sums(rows, SUMS[sums], by)
        )
        write_parts(made, root, self._batch, F.col("month"), base, months, order=[SUMS[sums]])

    def prune(self, keep: int = 2) -> None:
        """Drop all but the newest states. Parts that those refer to stay."""
        for name in self.specs:
            drop_old_states(self.spark, f"{self.root}/silver/{name}", keep)
        for name in GOLD_STATES:
            drop_old_states(self.spark, f"{self.root}/gold/{name}", keep)
        for name in GOLD_TABLES:
            drop_old_versions(self.spark, f"{self.root}/gold/{name}", keep)
        drop_old_versions(self.spark, self._control, keep)

    def _publications(self, tables: dict[str, DataFrame]) -> list[partial]:
        return [
            partial(publish, table, f"{self.root}/gold/{name}", self._batch)
            for name, table in tables.items()
        ]

    @property
    def _control(self) -> str:
        return f"{self.root}/control/watermark"

    @property
    def _staging(self) -> str:
        return f"{self.root}/staging"

    def _drop_unfinished(self) -> None:
        """Remove what came after the last finished batch before this one."""
        remove_folder(self.spark, self._staging)
        last = -1 if self._last is None else self._last
        states = [*(f"silver/{name}" for name in self.specs), *(f"gold/{n}" for n in GOLD_STATES)]
        for folder in (*states, *(f"gold/{name}" for name in GOLD_TABLES)):
            drop_newer(self.spark, f"{self.root}/{folder}", last)

    def _counts(self, version: int) -> bool:
        """Whether a state is that of a finished batch or of the current one."""
        if self._batch is None and self._last is None:
            self._last = current_version(self.spark, self._control)
        return version == self._batch or (self._last is not None and version <= self._last)

    def _base(self, folder: str) -> State | None:
        """State in parts that the current batch starts from."""
        return load_state(
            self.spark, f"{self.root}/{folder}",
            lambda version: version != self._batch and self._counts(version),
        )

    def _read(self, folder: str) -> DataFrame:
        state = self.state(folder)
        if state is None:
            raise ValueError(f"nothing published under {self.root}/{folder}")
        return read_parts(self.spark, f"{self.root}/{folder}", state)


def _replaced(base: State | None, state: State) -> list[str]:
    """Parts of either state that the other has not, or has in another version."""
    before = base.parts if base else {}
    names = {**before, **state.parts}
    return [p for p in names if before.get(p) != state.parts.get(p)]


def _of_like_size(sizes: Mapping[str, int], total: int) -> list[str]:
    """Parts to join with a new one of ``total`` bytes, smallest first, as long as the next
    is at most twice as large as all before it together."""
    found = []
    for part, size in sorted(sizes.items(), key=lambda item: item[1]):
        if size > 2 * total:
            break
        found.append(part)
        total += size
    return found
