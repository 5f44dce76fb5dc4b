from __future__ import annotations

from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import has_values, keep_latest, merge_latest, valid_key
from tidemark.operators.merge import unique_by

KVT = "k long, v int, t string"


def test_valid_key(spark):
    ints = spark.createDataFrame([(1,), (0,), (None,), (-3,)], "k long")
    assert rows(valid_key(ints, "k")) == [(-3,), (1,)]
    texts = spark.createDataFrame([("a",), ("0",), (" ",), ("",), (None,)], "k string")
    assert rows(valid_key(texts, "k")) == [("a",)]


def test_valid_key_reaches_the_parquet_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    plan = valid_key(spark.read.parquet(str(tmp_path / "t")), "id")._jdf.queryExecution()
    assert "PushedFilters: [IsNotNull(id), Not(EqualTo(id,0))]" in plan.toString()


def test_has_values(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a int, b int")
    assert rows(has_values(df, "a", "b")) == [(1, 2)]
    assert has_values(df) is df


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, 2, "y"), (2, 5, "a"), (2, 5, "b"), (3, None, "z")], KVT
    )
    assert rows(keep_latest(df, "k", "v", ["t"])) == [(1, 2, "y"), (2, 5, "b"), (3, None, "z")]


def test_keep_latest_cuts_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a")], KVT)
    plan = keep_latest(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    first, second = (line for line in plan.splitlines() if "WindowGroupLimit" in line)
    assert "Final" in first and "Partial" in second
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


version = st.one_of(st.none(), st.integers(0, 3))
some_rows = st.lists(
    st.tuples(st.integers(1, 4), version, st.sampled_from("abc")), min_size=1, max_size=20
)
few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def newest(data):
    """Brute force: per key the greatest (version, text), NULL lowest."""
    best = {}
    for k, v, t in data:
        rank = (v is not None, v or 0, t)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, v, t))
    return sorted(r for _, r in best.values())


@few
@given(some_rows)
def test_keep_latest_matches_brute_force_and_is_idempotent(spark, data):
    once = keep_latest(spark.createDataFrame(data, KVT), "k", "v", ["t"])
    assert rows(once) == newest(data)
    assert rows(keep_latest(once, "k", "v", ["t"])) == rows(once)


@few
@given(some_rows, some_rows)
def test_merge_latest_equals_latest_of_both(spark, old, new):
    def latest(data):
        return keep_latest(spark.createDataFrame(data, KVT), "k", "v", ["t"])

    merged = merge_latest(latest(old), latest(new), "k", "v", ["t"])
    assert rows(merged) == newest(old + new)


def test_unique_by(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    assert rows(unique_by(df, "k")) == [(1, "a"), (2, "b")]
    try:
        unique_by(df.union(df), "k").collect()
    except Exception as error:
        assert "repeats a value of k" in str(error)
    else:
        raise AssertionError("a repeated key went through")


def test_split_accounts_for_every_row(spark, tmp_path):
    """good + bad + dropped = input, whichever check comes first."""
    from tidemark.plans.silver import SILVER, refine

    spec = SILVER["products"]
    lines = ["ProductID,ProductName,Category,Price,ModifiedDate"]
    stamp = '"2026-01-01 00:00:00"'
    cases = Counter()
    for i in range(1, 60):
        kind = ["ok", "bad_price", "bad_key", "zero_key"][i % 4]
        key = {"bad_key": f"x{i}", "zero_key": "0"}.get(kind, i)
        price = "n/a" if kind == "bad_price" else "5.5"
        lines.append(f'"{key}","a","b","{price}",{stamp}')
        cases[kind] += 1
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    raw = spec.read(spark, str(tmp_path))
    split = refine(spec, raw)
    assert split.good.count() == cases["ok"]
    assert split.bad.count() == cases["bad_price"] + cases["bad_key"]
    late = refine(spec, raw, quarantine_first=False)
    assert rows(late.good.drop("ingestion_timestamp")) == rows(
        split.good.drop("ingestion_timestamp")
    )
    assert late.bad.count() == cases["bad_price"]
