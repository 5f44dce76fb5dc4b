from __future__ import annotations

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import scd2_changed_keys
from tidemark.plans import dim_customer, dim_product

CUSTOMER = "CustomerID long, FullName string, City string, Email string"
SHOWN = ("CustomerID", "FullName", "City", "Email", "IS_ACTIVE")
PRODUCT = (
    "ProductID long, ProductName string, Category string, Price double, price_category string, "
    "ModifiedDate timestamp"
)


def product(key, price, name="n"):
    return (key, name, "c", price, "LOW", None)


def run_products(spark, *snapshots, **options):
    state = spark.createDataFrame([], schemas.DIM_PRODUCT)
    for day, snapshot in enumerate(snapshots, start=1):
        source = spark.createDataFrame(snapshot, PRODUCT)
        moment = f"2026-01-0{day} 00:00:00"
        state = dim_product(state, source, moment, **options)
    return state


def run_customers(spark, *snapshots, **options):
    state = spark.createDataFrame([], schemas.DIM_CUSTOMER)
    for day, snapshot in enumerate(snapshots, start=1):
        source = spark.createDataFrame(snapshot, CUSTOMER)
        moment = f"2026-01-0{day} 00:00:00"
        state = dim_customer(state, source, moment, **options)
    return state


def test_scd1_inserts_updates_keeps(spark):
    state = run_products(spark, [product(1, 1.0), product(2, 2.0)],
                         [product(2, 3.0), product(3, 1.0)])
    shown = state.select(
        "ProductID", "Price", F.dayofmonth("CREATEDDATE"), "CREATEDBY",
        F.dayofmonth("UPDATEDDATE"), "UPDATEDBY",
    )
    assert rows(shown) == [
        (1, 1.0, 1, "databricks", 1, "databricks"),
        (2, 3.0, 1, "databricks", 2, "databricks-updated"),
        (3, 1.0, 2, "databricks", 2, "databricks"),
    ]
    assert state.schema.names == schemas.DIM_PRODUCT.names


def test_scd1_twice_changes_nothing(spark):
    data = [product(1, 1.0), product(2, None)]
    once = run_products(spark, data)
    assert rows(run_products(spark, data, data)) == rows(once)
    assert rows(run_products(spark, data, data, changed_by="hash")) == rows(
        run_products(spark, data, changed_by="hash")
    )


def test_scd1_null_moving_between_columns(spark):
    before = [(1, "x", None, 1.0, "LOW", None)]
    after = [(1, None, "x", 1.0, "LOW", None)]
    assert rows(run_products(spark, before, after), "ProductName", "Category") == [(None, "x")]
    by_hash = run_products(spark, before, after, changed_by="hash")
    assert rows(by_hash, "ProductName", "Category") == [("x", None)]


def test_scd2_change_closes_and_adds(spark):
    state = run_customers(spark, [(1, "a", "A", "e"), (2, "b", "B", "f")],
                          [(1, "a", "Z", "e"), (3, "c", "C", "g")])
    assert rows(state, *SHOWN) == [
        (1, "a", "A", "e", 0), (1, "a", "Z", "e", 1), (2, "b", "B", "f", 1), (3, "c", "C", "g", 1),
    ]
    audit = state.filter("CustomerID = 1").select(
        "IS_ACTIVE", F.col("CREATEDDATE").cast("string"), F.col("UPDATEDDATE").cast("string"),
        "UPDATEDBY",
    )
    assert rows(audit) == [
        (0, "2026-01-01 00:00:00", "2026-01-02 00:00:00", "Databricks-Updated"),
        (1, "2026-01-02 00:00:00", "9999-01-01 00:00:00", "databricks"),
    ]


def test_scd2_revert(spark):
    steps = [[(1, "a", c, "e")] for c in ("A", "B", "A")]
    assert rows(run_customers(spark, *steps), "City", "IS_ACTIVE") == [
        ("A", 0), ("A", 1), ("B", 0),
    ]
    literal = run_customers(spark, *steps, against="all_versions")
    assert rows(literal, "City", "IS_ACTIVE") == [("A", 0), ("B", 1)]


def test_scd2_null_field(spark):
    data = [(1, "a", "A", None)]
    assert rows(run_customers(spark, data, data), "IS_ACTIVE") == [(1,)]
    literal = run_customers(spark, data, data, against="all_versions")
    assert rows(literal, "IS_ACTIVE") == [(1,), (1,)]


def test_scd2_changed_keys(spark):
    state = run_customers(spark, [(1, "a", "A", "e"), (2, "b", "B", "f")])
    source = spark.createDataFrame([(1, "a", "Z", "e"), (2, "b", "B", "f"), (3, "c", "C", "g")],
                                   CUSTOMER)
    got = scd2_changed_keys(state, source, "CustomerID", ("FullName", "City", "Email"))
    assert rows(got) == [(1, 1, "a", "Z", "e")]


def test_repeated_source_key_fails(spark):
    try:
        run_customers(spark, [(1, "a", "A", "e"), (1, "a", "B", "e")]).collect()
    except Exception as error:
        assert "repeats a value of CustomerID" in str(error)
    else:
        raise AssertionError("a repeated key went through")


def test_history_is_not_shuffled(spark, tmp_path):
    run_customers(spark, [(1, "a", "A", "e")]).write.partitionBy("IS_ACTIVE").parquet(
        str(tmp_path / "dim")
    )
    stored = spark.read.schema(schemas.DIM_CUSTOMER).parquet(str(tmp_path / "dim"))
    source = spark.createDataFrame([(1, "a", "B", "e")], CUSTOMER)
    plan = dim_customer(stored, source)._jdf.queryExecution().executedPlan().toString()
    history = plan[plan.index("Union") : plan.index("Generate")]
    assert "Exchange" not in history and "PartitionFilters: [NOT (IS_ACTIVE" in history


snapshot = st.dictionaries(
    st.integers(1, 3),
    st.tuples(st.just("n"), st.sampled_from("AB"), st.sampled_from(["e", None])),
    max_size=3,
)


def emulate(snapshots, all_versions):
    """Row by row: close the active version and add one for every new-looking row."""
    state = []
    for source in snapshots:
        def known(key, row):
            if all_versions:
                return None not in row and any(v[:2] == [key, row] for v in state)
            return any(v == [key, row, 1] for v in state)

        new = [(k, r) for k, r in source.items() if not known(k, r)]
        for key, row in new:
            for version in state:
                comparable = not all_versions or (None not in row and None not in version[1])
                if version[0] == key and version[2] == 1 and version[1] != row and comparable:
                    version[2] = 0
        state += [[key, row, 1] for key, row in new]
    return sorted(((k, *r, a) for k, r, a in state), key=str)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(snapshot, min_size=1, max_size=4), st.booleans())
def test_scd2_matches_row_by_row(spark, snapshots, all_versions):
    against = "all_versions" if all_versions else "active"
    state = run_customers(
        spark, *([(k, *r) for k, r in s.items()] for s in snapshots), against=against
    )
    got = sorted((tuple(r) for r in state.select(*SHOWN).collect()), key=str)
    assert got == emulate(snapshots, all_versions)
    if not all_versions:
        active = [r[0] for r in got if r[-1] == 1]
        assert len(active) == len(set(active))
