from __future__ import annotations

import pytest
from conftest import rows

from tidemark import schemas
from tidemark.operators import merge_latest
from tidemark.plans import dim_customer
from tidemark.sources import read_csv
from tidemark.streaming import (
    drop_stream,
    drops,
    files_per_batch,
    land_drops,
    read_stream_state,
    upsert_stream,
)

HEADER = ",".join(schemas.EMPLOYEE_EVENTS.names)


def drop(folder, name, *keys):
    lines = [HEADER, *(f'"{k}","A","B","d","e","1","2026-01-01","2026-01-01"' for k in keys)]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_every_file_lands_once(spark, tmp_path):
    folder, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()

    def run():
        land_drops(drop_stream(spark, str(folder), schemas.EMPLOYEE_EVENTS), target, check)
        return rows(read_csv(spark, target, schemas.EMPLOYEE_EVENTS), "EmployeeID")

    drop(folder, "a.csv", 1, 2)
    drop(folder, "empty.csv")
    assert run() == [("1",), ("2",)]
    assert run() == [("1",), ("2",)]
    drop(folder, "b.csv", 3)
    assert run() == [("1",), ("2",), ("3",)]
    assert (folder / "empty.csv").exists()


def events(folder, name, *lines):
    (folder / name).write_text("\n".join(["k,v,t", *lines]) + "\n")


def test_upserts_equal_one_batch(spark, tmp_path):
    schema = schemas._schema("k long, v int, t string")
    folder, root = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()

    def run(per_batch=1):
        upsert_stream(
            drop_stream(spark, str(folder), schema, files_per_batch=per_batch),
            root,
            schema,
            lambda state, batch: merge_latest(state, batch, "k", "v", ["t"]),
            key="k",
            version="v",
            ties=["t"],
            checkpoint=str(tmp_path / "check"),
        )
        return rows(read_stream_state(spark, root, schema))

    events(folder, "a.csv", "1,5,a", "1,4,b", "2,1,c")
    events(folder, "b.csv", "1,3,late", "3,1,d")
    assert run() == [(1, 5, "a"), (2, 1, "c"), (3, 1, "d")]
    events(folder, "c.csv", "2,9,z")
    assert run() == [(1, 5, "a"), (2, 9, "z"), (3, 1, "d")]


def test_history_from_a_stream(spark, tmp_path):
    schema = schemas._schema(
        "CustomerID long, FullName string, City string, Email string, v int"
    )
    folder, root = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()

    def run(name, *lines):
        (folder / name).write_text("\n".join([",".join(schema.names), *lines]) + "\n")
        upsert_stream(
            drop_stream(spark, str(folder), schema),
            root,
            schemas.DIM_CUSTOMER,
            dim_customer,
            key="CustomerID",
            version="v",
            checkpoint=str(tmp_path / "check"),
        )
        return rows(
            read_stream_state(spark, root, schemas.DIM_CUSTOMER), "CustomerID", "City", "IS_ACTIVE"
        )

    assert run("a.csv", "1,n,A,e,1", "1,n,B,e,2") == [(1, "B", 1)]
    assert run("b.csv", "1,n,C,e,3", "2,m,X,f,1") == [(1, "B", 0), (1, "C", 1), (2, "X", 1)]


def test_damaged_records_are_quarantined(spark, tmp_path):
    folder, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    drop(folder, "a.csv", 1)
    (folder / "b.csv").write_text(f"{HEADER}\n2,B\n3,A,B,d,e,1,x,y,ninth\n")

    def stream():
        return drop_stream(spark, str(folder), schemas.EMPLOYEE_EVENTS)

    land_drops(stream(), target, check, quarantine=str(tmp_path / "bad"))
    landed = read_csv(spark, f"{target}/*", schemas.EMPLOYEE_EVENTS)
    assert rows(landed, "EmployeeID") == [("1",)]
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert rows(bad, schemas.CORRUPT) == [("2,B",), ("3,A,B,d,e,1,x,y,ninth",)]
    with pytest.raises(Exception, match="damaged record"):
        land_drops(stream(), str(tmp_path / "other"), str(tmp_path / "check2"))


def test_a_repeated_micro_batch_adds_nothing(spark, tmp_path):
    """One query parses each file; what ended between the two writes is written again."""
    folder, target, bad = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "bad")
    folder.mkdir()
    drop(folder, "a.csv", 1, 2)
    (folder / "b.csv").write_text(f"{HEADER}\n9,B\n")
    check = tmp_path / "check"
    land_drops(
        drop_stream(spark, str(folder), schemas.EMPLOYEE_EVENTS), target, str(check), quarantine=bad
    )
    assert [p.name for p in check.iterdir()] == ["landed"]
    again = read_csv(spark, f"{folder}/a.csv", schemas.EMPLOYEE_EVENTS)
    for _ in range(2):
        drops._land(again, 0, target, bad, "csv")
    landed = read_csv(spark, f"{target}/*", schemas.EMPLOYEE_EVENTS)
    assert rows(landed, "EmployeeID") == [("1",), ("2",)]
    assert spark.read.parquet(bad).count() == 0


def test_damaged_rows_do_not_reach_a_state(spark, tmp_path):
    schema = schemas._schema("k long, v int, t string")
    folder, root = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()
    events(folder, "a.csv", "1,5,a", "x,oops,b", ",1,keyless")
    upsert_stream(
        drop_stream(spark, str(folder), schema), root, schema,
        lambda state, batch: merge_latest(state, batch, "k", "v", ["t"]),
        key="k", version="v", ties=["t"], checkpoint=str(tmp_path / "check"),
        quarantine=str(tmp_path / "bad"),
    )
    assert rows(read_stream_state(spark, root, schema)) == [(1, 5, "a")]
    assert rows(spark.read.parquet(str(tmp_path / "bad")), schemas.CORRUPT) == [("x,oops,b",)]


def test_a_small_batch_rewrites_only_its_part(spark, tmp_path):
    schema = schemas._schema("k long, v int, t string")
    folder, root = tmp_path / "in", str(tmp_path / "state")
    folder.mkdir()

    def run():
        upsert_stream(
            drop_stream(spark, str(folder), schema), root, schema,
            lambda state, batch: merge_latest(state, batch, "k", "v", ["t"]),
            key="k", version="v", ties=["t"], checkpoint=str(tmp_path / "check"),
            part_bytes=2_000,
        )

    def size(path):
        return sum(f.stat().st_size for f in path.rglob("*.parquet"))

    events(folder, "a.csv", *(f"{i},1,{'text' * 9}{i}" for i in range(1, 4000)))
    run()
    whole = size(tmp_path / "state")
    for number in range(2, 5):
        events(folder, f"b{number}.csv", f"7,{number},changed")
        run()
        written = max((tmp_path / "state").glob("version=*"))
        assert size(written) < whole / 8
    assert size(tmp_path / "state") < whole * 1.3
    state = read_stream_state(spark, root, schema)
    assert state.count() == 3999 and rows(state.filter("k = 7")) == [(7, 4, "changed")]


def test_a_timeout_stops_the_stream_and_raises(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    drop(folder, "a.csv", 1)
    stream = drop_stream(spark, str(folder), schemas.EMPLOYEE_EVENTS)
    with pytest.raises(TimeoutError):
        land_drops(stream, str(tmp_path / "out"), str(tmp_path / "check"), timeout=0.001)
    assert not spark.streams.active


def test_the_number_of_micro_batches_does_not_grow_with_the_files(spark, tmp_path):
    schema = schemas._schema("k long, v int, t string")
    for many, batches in ((3, 2), (24, 4)):
        folder, root = tmp_path / f"in{many}", str(tmp_path / f"state{many}")
        folder.mkdir()
        for i in range(many):
            events(folder, f"{i}.csv", f"{i % 5},{i},a")
        (folder / "other.txt").write_text("not taken")
        n = files_per_batch(spark, str(folder), least=2, batches=4)
        upsert_stream(
            drop_stream(spark, str(folder), schema, files_per_batch=n), root, schema,
            lambda state, batch: merge_latest(state, batch, "k", "v", ["t"]),
            key="k", version="v", ties=["t"], checkpoint=str(tmp_path / f"check{many}"),
        )
        done = [p.name for p in (tmp_path / f"check{many}" / "commits").glob("[0-9]*")]
        assert len(done) == batches
        latest = {i % 5: i for i in range(many)}
        found = read_stream_state(spark, root, schema)
        assert rows(found, "k", "v") == sorted(latest.items())
