"""States in parts: what a batch rewrites, splits, and wider types."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import merge_latest
from tidemark.sources.versions import (
    ALL_KEYS,
    NOWHERE,
    load_state,
    merge_parts,
    parts_of,
    read_parts,
    split,
    union_schema,
    wider_type,
    with_part,
    write_parts,
)


def merged(spark, root, version, source, part_bytes):
    path = f"{root}/source-{version}"
    source.write.parquet(path)
    source = spark.read.parquet(path)
    return merge_parts(
        spark, f"{root}/state", version, source, "k",
        lambda stored, batch: merge_latest(stored, batch, "k", "v", []),
        load_state(spark, f"{root}/state"), source.schema, part_bytes,
    )


def numbers(spark, first, last, v=1):
    return spark.range(first, last).select(F.col("id").alias("k"), F.lit(v).alias("v"))


def test_parts_cover_all_keys(spark):
    keys = numbers(spark, 0, 2000)
    uneven = ["p0", "p10", "p110", "p111"]
    placed = with_part(keys, "k", uneven)
    assert placed.count() == 2000
    share = {r[0]: r[1] for r in placed.groupBy("state_part").count().collect()}
    assert set(share) == set(uneven) and 850 < share["p0"] < 1150 and 180 < share["p111"] < 320
    assert parts_of(keys, "k", [ALL_KEYS]) == [ALL_KEYS]
    assert split("p0", 300, 100) == ["p000", "p001", "p010", "p011"]
    assert split("p0", 100, 100) == ["p0"] and split("p0", 0, 100) == ["p0"]


def test_a_batch_of_k_keys_rewrites_k_parts_at_most(spark, tmp_path):
    root = str(tmp_path)
    write_parts(
        with_part(numbers(spark, 0, 4000), "k", [f"p{i:010b}" for i in range(1024)]),
        f"{root}/state", 1, None, cover=[f"p{i:010b}" for i in range(1024)],
    )
    assert len(load_state(spark, f"{root}/state").parts) == 1024
    state = merged(spark, root, 2, numbers(spark, 10, 17, v=2), 1 << 20)
    assert len(state.parts) == 1024
    assert sum(version == 2 for version in state.parts.values()) <= 7
    found = read_parts(spark, f"{root}/state", state)
    assert rows(found.groupBy("v").count()) == [(1, 3993), (2, 7)]


def test_parts_follow_the_size_of_the_state(spark, tmp_path):
    root, seen = str(tmp_path), []
    for version in range(1, 6):
        state = merged(spark, root, version, numbers(spark, 0, 3000 * version, version), 20_000)
        seen.append(len(state.parts))
        assert max(state.sizes.values()) < 60_000
    assert seen == sorted(seen) and seen[-1] >= 2 * seen[0]
    found = read_parts(spark, f"{root}/state", state)
    assert rows(found.agg(F.count("*"), F.count_distinct("k"), F.min("v"))) == [(15000, 15000, 5)]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_merge_with_nothing_stored_is_no_join(spark):
    batch = numbers(spark, 0, 20)
    merged_rows = merge_latest(read_parts(spark, "none", None, batch.schema), batch, "k", "v", [])
    assert "Join" not in plan(merged_rows)
    assert merged_rows.count() == 20


def test_rows_are_dealt_to_uneven_parts_without_a_shuffle(spark):
    placed = with_part(numbers(spark, 0, 2000), "k", ["p0", "p10", "p110", "p111"])
    physical = placed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical and "hashpartitioning" not in physical


def test_few_parts_are_written_where_they_were_merged(spark, tmp_path):
    """One shuffle, that of the uniqueness check; the source is given with its keys alone."""
    path = str(tmp_path / "keys")
    numbers(spark, 0, 400).write.parquet(path)
    stored = spark.read.parquet(path)
    groups = spark.sparkContext
    groups.setJobGroup("few", "few parts")
    state = merge_parts(
        spark, f"{tmp_path}/state", 1, stored.withColumn("v", F.col("v") + 1), "k",
        lambda old, new: merge_latest(old, new, "k", "v", []), None, stored.schema,
        1 << 20, stored.select("k"),
    )
    stages = {s for j in groups.statusTracker().getJobIdsForGroup("few")
              for s in groups.statusTracker().getJobInfo(j).stageIds}
    groups._jsc.clearJobGroup()
    assert len(stages) <= 3 and list(state.parts) == [ALL_KEYS]
    found = read_parts(spark, f"{tmp_path}/state", state)
    assert rows(found.agg(F.count("*"), F.min("v"))) == [(400, 2)]


def test_an_empty_part_stays_in_the_list(spark, tmp_path):
    root = str(tmp_path)
    cover = ["p0", "p1"]
    one = numbers(spark, 0, 1)
    state = write_parts(with_part(one, "k", cover), f"{root}/state", 1, None, cover=cover)
    assert sorted(state.parts) == cover and NOWHERE in state.parts.values()
    state = merged(spark, root, 2, numbers(spark, 1, 50), 1 << 20)
    assert read_parts(spark, f"{root}/state", state).count() == 50


def test_wider_types_and_new_columns(spark, tmp_path):
    root = str(tmp_path)
    narrow = spark.createDataFrame([(i, i, 1.5, "2026-01-02") for i in range(200)],
                                   "k long, n int, f float, d string")
    narrow = narrow.withColumn("d", F.col("d").cast("date"))
    leaves = [f"p{i:03b}" for i in range(8)]
    base = write_parts(with_part(narrow, "k", leaves), f"{root}/state", 1, None, cover=leaves)
    wide = spark.createDataFrame([(3, 2**40, 2.25, None, "x")], "k long, n long, f double, d date, c string")
    wide = wide.withColumn("d", F.lit("2026-03-04 05:06:07").cast("timestamp_ntz"))
    schema = union_schema(base.schema, wide.schema)
    assert [f.dataType.simpleString() for f in schema.fields] == [
        "bigint", "bigint", "double", "timestamp_ntz", "string"
    ]

    def replace(stored, batch):
        return stored.join(batch, "k", "left_anti").unionByName(batch.select(*stored.columns))

    merge_parts(spark, f"{root}/state", 2, wide, "k", replace, base, schema, 1 << 20)
    state = load_state(spark, f"{root}/state")
    assert sorted(set(state.parts.values())) == [1, 2]
    found = read_parts(spark, f"{root}/state", state)
    assert found.schema == schema and found.count() == 200
    moment = F.date_format("d", "yyyy-MM-dd HH:mm:ss")
    assert rows(found.filter("k in (3, 4)"), "k", "n", "f", moment, "c") == [
        (3, 2**40, 2.25, "2026-03-04 05:06:07", "x"), (4, 4, 1.5, "2026-01-02 00:00:00", None)
    ]


def test_types_without_a_common_one(spark):
    assert wider_type("n", T.LongType(), T.ShortType()) == T.LongType()
    assert wider_type("n", T.IntegerType(), T.DoubleType()) == T.DoubleType()
    for first, second in [(T.LongType(), T.DoubleType()), (T.StringType(), T.IntegerType()),
                          (T.DateType(), T.StringType()), (T.FloatType(), T.LongType())]:
        with pytest.raises(TypeError, match="neither"):
            wider_type("n", first, second)


def test_rows_lie_in_their_file_by_order(spark, tmp_path):
    """Near values compress better: the same rows take less space than scattered ones."""
    scattered = numbers(spark, 0, 40_000).repartition(4, "k").orderBy(F.xxhash64("k"))
    part = F.when(F.col("k") % 2 == 0, "even").otherwise("odd")
    plain = write_parts(scattered, f"{tmp_path}/plain", 1, part)
    state = write_parts(scattered, f"{tmp_path}/state", 1, part, order=["k"])
    files = sorted((tmp_path / "state").rglob("*.parquet"))
    for file in files:
        keys = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert keys and keys == sorted(keys)
    assert sum(state.sizes.values()) < 0.8 * sum(plain.sizes.values())
    found = read_parts(spark, f"{tmp_path}/state", state)
    assert rows(found.agg(F.count("*"), F.count_distinct("k"))) == [(40_000, 40_000)]
