from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    band,
    day_diff,
    equals_flag,
    exact_avg,
    exact_sum,
    full_name,
    group_of,
    log_time,
    mapped,
    percent_of,
    row_hash,
    row_hash_plain,
    stamp,
    title_case,
    upper_trim,
)
from tidemark.plans.silver import (
    LOWEST_BAND,
    OTHER_REGION,
    PRICE_BANDS,
    REGIONS,
    SHIPMENT_TEXTS,
)


def values(spark, ddl, data, column):
    return [r[0] for r in spark.createDataFrame(data, ddl).select(column).collect()]


def test_text(spark):
    given = [("  uSB-c hUB o'neil  x1y ",), (None,)]
    assert values(spark, "t string", given, title_case("t")) == ["Usb-c Hub O'neil  X1y", None]
    assert values(spark, "t string", [(" on ",), (None,)], upper_trim("t")) == ["ON", None]
    names = [("A", None), (None, None), ("A", "B")]
    assert values(spark, "a string, b string", names, full_name("a", "b")) == ["A", "", "A B"]


def test_price_bands(spark):
    prices = [(500.0,), (500.01,), (200.0,), (200.01,), (None,)]
    got = values(spark, "p double", prices, band("p", PRICE_BANDS, LOWEST_BAND))
    assert got == ["MEDIUM", "HIGH", "LOW", "MEDIUM", "LOW"]


def test_regions_and_texts(spark):
    provinces = [("ON",), ("AB",), ("NS",), (None,), ("QC",), ("BC",)]
    got = values(spark, "p string", provinces, group_of("p", REGIONS, OTHER_REGION))
    assert got == ["EAST", "WEST", "OTHER", "OTHER", "EAST", "WEST"]
    states = [("DELIVERED",), ("LOST",), (None,)]
    assert values(spark, "s string", states, mapped("s", SHIPMENT_TEXTS)) == [
        "Order completed",
        None,
        None,
    ]
    assert values(spark, "s string", states, equals_flag("s", "DELIVERED")) == [1, 0, 0]


def test_day_diff(spark):
    d = dt.date
    data = [(d(2026, 1, 5), d(2026, 1, 1)), (None, d(2026, 1, 1)), (d(2026, 1, 5), None)]
    assert values(spark, "e date, s date", data, day_diff("e", "s")) == [4, None, None]


def test_log_time_is_wall_clock_of_the_log_zone(spark):
    summer = F.to_timestamp(F.lit("2026-07-01 12:00:00"))
    winter = F.to_timestamp(F.lit("2026-01-01 12:00:00"))
    got = spark.range(1).select(
        log_time(summer).cast("string"), log_time(winter).cast("string")
    ).first()
    assert tuple(got) == ("2026-07-01 08:00:00", "2026-01-01 07:00:00")


def test_stamp(spark):
    fixed = spark.range(1).select(stamp("2026-01-01 00:00:00").cast("string")).first()[0]
    assert fixed == "2026-01-01 00:00:00"
    assert spark.range(1).select(stamp()).first()[0] is not None


def test_plain_hashes_overlook_what_the_checked_ones_tell_apart(spark):
    df = spark.createDataFrame([("1", "2a"), ("12", "a"), ("1", None), (None, "1")],
                               "a string, b string")

    def hashes(column):
        return [r[0] for r in df.select(column).collect()]

    joined = hashes(row_hash_plain("a", "b"))
    assert joined[0] == joined[1] and joined[2] is None
    piped = hashes(row_hash_plain("a", "b", separator="||"))
    assert piped[0] != piped[1] and piped[2] == piped[3]
    assert len(set(hashes(row_hash("a", "b")))) == 4


def test_plain_hash_is_crc32_of_the_text(spark):
    import zlib

    df = spark.createDataFrame([(7, "Ann", "X", "e")], "k long, n string, c string, m string")
    got = df.select(row_hash_plain("k", "n", "c", "m")).first()[0]
    assert got == zlib.crc32(b"7AnnXe")


def test_sums_do_not_depend_on_order(spark):
    cents = [(0.1,)] * 3 + [(1e9,), (None,), (-1e9,)]
    df = spark.createDataFrame(cents, "x double")
    got = df.agg(exact_sum("x"), exact_avg("x")).first()
    assert tuple(got) == (0.3, 0.3 / 5)
    # Nothing below a cent is lost, and amounts beyond six decimals count as well.
    small = spark.createDataFrame([(0.004,)] * 1000 + [(1.005,), (-2.5,)], "x double")
    assert small.agg(exact_sum("x")).first()[0] == 2.505
    tiny = spark.createDataFrame([(1.25e-9,)] * 4, "x double")
    assert tiny.agg(exact_sum("x")).first()[0] == pytest.approx(5e-9, rel=1e-9)
    none = df.filter("x > 1e10").agg(
        exact_avg("x"), percent_of(F.sum(F.lit(1)), F.count(F.lit(1)))
    ).first()
    assert tuple(none) == (None, None)
