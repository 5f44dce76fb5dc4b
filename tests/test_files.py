from __future__ import annotations

import datetime as dt

from conftest import rows

from tidemark import schemas
from tidemark.operators.quality import split_corrupt
from tidemark.sources import (
    append_table,
    create_table,
    current_version,
    file_row_counts,
    list_files,
    overwrite_table,
    publish,
    quarantine,
    read_csv,
    read_current,
    read_json,
    register_view,
    split_drops,
    table,
    write_csv,
    write_json,
)

SHORT = schemas._schema("k long, q int, p double, m timestamp")
STAMP = "2026-01-01 00:00:00"


def write_lines(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_damaged_csv_records(spark, tmp_path):
    write_lines(
        tmp_path / "a.csv",
        "any,header,is,fine",
        f'"1","10","5.5","{STAMP}"',
        f'"abc","10","5.5","{STAMP}"',
        f'"3","xx","5.5","{STAMP}"',
        '"4","10"',
        f'"5","10","5.5","{STAMP}","extra"',
        f'"","10","5.5","{STAMP}"',
        f'"7","10","","{STAMP}"',
    )
    split = split_corrupt(read_csv(spark, str(tmp_path), SHORT), "k", STAMP)
    assert rows(split.good, "k", "p") == [(1, 5.5), (7, None), (None, 5.5)]
    assert rows(split.bad, "k", schemas.CORRUPT) == [
        (3, f'"3","xx","5.5","{STAMP}"'),
        (4, '"4","10"'),
        (5, f'"5","10","5.5","{STAMP}","extra"'),
        (None, f'"abc","10","5.5","{STAMP}"'),
    ]


def test_a_record_is_bad_whatever_columns_are_read(spark, tmp_path):
    write_lines(tmp_path / "a.csv", "k,q,p,m", f'"3","10","5.5","not a date"')
    df = read_csv(spark, str(tmp_path), SHORT)
    assert df.select("k", schemas.CORRUPT).first()[1] is not None
    write_lines(tmp_path / "j" / "a.json", '{"k":3,"q":1,"m":"not a date"}')
    df = read_json(spark, str(tmp_path / "j"), SHORT)
    assert tuple(df.select("k", schemas.CORRUPT).first()) == (
        3, '{"k":3,"q":1,"m":"not a date"}',
    )


def test_damaged_json_records(spark, tmp_path):
    write_lines(
        tmp_path / "a.json",
        '{"k":1,"q":2,"p":1.5}',
        "{bad",
        '{"k":"x","q":2}',
        '{"k":4,"m":"someday"}',
    )
    split = split_corrupt(read_json(spark, str(tmp_path), SHORT), "k")
    assert rows(split.good, "k", "q", "p") == [(1, 2, 1.5)]
    assert rows(split.bad, "k") == [(4,), (None,), (None,)]


def test_json_over_several_lines(spark, tmp_path):
    write_lines(tmp_path / "a.json", "[", '{"k":1,', '"q":2},', '{"k":2}', "]")
    df = read_json(spark, str(tmp_path), SHORT, multi_line=True)
    assert rows(df, "k", "q", schemas.CORRUPT) == [(1, 2, None), (2, None, None)]


def test_wildcards_and_single_files(spark, tmp_path):
    write_lines(tmp_path / "x" / "a.csv", "k,q,p,m", "1,1,1,")
    write_lines(tmp_path / "x" / "b.csv", "k,q,p,m", "2,2,2,")
    assert rows(read_csv(spark, f"{tmp_path}/x/*", SHORT), "k") == [(1,), (2,)]
    assert rows(read_csv(spark, str(tmp_path / "x"), SHORT, only="b.csv"), "k") == [(2,)]


def test_text_round_trip_keeps_microseconds_and_quotes(spark, tmp_path):
    moment = dt.datetime(2026, 1, 1, 1, 2, 3, 456789, dt.timezone.utc)
    schema = schemas._schema("k long, t string, m timestamp")
    df = spark.createDataFrame([(1, 'a "b", \\c', moment), (2, None, None)], schema)
    write_csv(df, str(tmp_path / "c"))
    write_json(df, str(tmp_path / "j"))
    assert rows(read_csv(spark, str(tmp_path / "c"), schema).drop(schemas.CORRUPT)) == rows(df)
    assert rows(read_json(spark, str(tmp_path / "j"), schema).drop(schemas.CORRUPT)) == rows(df)
    texts = "".join(f.read_text() for f in (tmp_path / "c").glob("part*"))
    assert '"1"' in texts and '"2"' in texts


def test_line_breaks_inside_quotes(spark, tmp_path):
    write_lines(tmp_path / "a.csv", "k,t", '"1","a', 'b"', '"2","c"')
    schema = schemas._schema("k long, t string")
    df = read_csv(spark, str(tmp_path), schema, multi_line=True)
    assert rows(df, "k", "t", schemas.CORRUPT) == [(1, "a\nb", None), (2, "c", None)]


def test_empty_text_does_not_survive_csv(spark, tmp_path):
    schema = schemas._schema("k long, t string")
    write_csv(spark.createDataFrame([(1, "")], schema), str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c"), schema), "k", "t") == [(1, None)]


def test_drop_folder(spark, tmp_path):
    write_lines(tmp_path / "full one.csv", "k,q,p,m", "1,1,1,", "2,2,2,")
    write_lines(tmp_path / "empty.csv", "k,q,p,m")
    write_lines(tmp_path / "notes.txt", "x")
    assert rows(list_files(spark, str(tmp_path)), "name", "length") == [
        ("empty.csv", 8), ("full one.csv", 22), ("notes.txt", 2),
    ]
    split = split_drops(file_row_counts(spark, str(tmp_path), SHORT))
    assert rows(split.to_load, "name", "n_rows") == [("full one.csv", 2)]
    assert rows(split.empty, "name", "n_rows") == [("empty.csv", 0)]
    assert (tmp_path / "empty.csv").exists()


def test_tables(spark):
    create_table(spark, "dim_p", schemas.DIM_PRODUCT)
    create_table(spark, "dim_p", schemas.DIM_PRODUCT)
    assert [f.name for f in table(spark, "dim_p").schema] == schemas.DIM_PRODUCT.names
    df = spark.createDataFrame([(1, "a")], "k int, t string")
    overwrite_table(df, "plain")
    overwrite_table(df.withColumnRenamed("t", "u"), "plain")
    append_table(df.withColumnRenamed("t", "u"), "plain")
    assert rows(table(spark, "plain", "default"), "k", "u") == [(1, "a"), (1, "a")]
    overwrite_table(df, "bucketed", bucket_by="k", buckets=4)
    joined = table(spark, "bucketed").join(table(spark, "bucketed"), "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quarantine_appends(spark, tmp_path):
    bad = spark.createDataFrame([(1, "x")], f"k int, {schemas.CORRUPT} string")
    quarantine(bad, str(tmp_path / "q"))
    quarantine(bad, str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2


def test_versions(spark, tmp_path):
    root, schema = str(tmp_path / "state"), schemas._schema("k long")
    assert read_current(spark, root, schema).count() == 0
    first = spark.createDataFrame([(1,)], schema)
    publish(first, root, 1)
    publish(read_current(spark, root, schema).union(first), root, 2)
    assert read_current(spark, root, schema).count() == 2
    # A repeated run starts from the state before it.
    publish(read_current(spark, root, schema, before=2).union(first), root, 2)
    assert read_current(spark, root, schema).count() == 2
    # An unfinished version does not count.
    (tmp_path / "state" / "version=000000000003").mkdir()
    assert current_version(spark, root) == 2
    register_view(spark, "state_view", root)
    assert table(spark, "state_view").count() == 2
