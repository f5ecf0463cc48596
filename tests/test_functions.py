from __future__ import annotations

import hashlib
from datetime import date

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from shiplake.functions import hashing, measures, text, timeparts
from shiplake.functions.numbering import with_row_number
from shiplake.operators import dims


def values(frame, column="v"):
    return [r[column] for r in frame.select(column).collect()]


def test_text_clean_up(spark):
    frame = spark.createDataFrame([(" South of  USA ",), ("\tUS \n Center",), (None,)], "s string")
    assert values(frame.select(text.normalise_text(F.col("s")).alias("v"))) == ["South of USA", "US Center", None]
    assert values(frame.select(text.strip_text(F.col("s")).alias("v")))[0] == "South of  USA"
    assert values(frame.limit(1).select(text.clean_identifier(F.lit(" wh003 ")).alias("v"))) == ["WH003"]


def test_halves_round_as_sql_does(spark):
    cases = [(0.50345, 4), (2.675, 2), (1.005, 2), (0.125, 2), (-0.125, 2), (0.5035, 4), (12.25, 1), (7.0, 2)]
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, ?)", case).fetchone()[0] for case in cases]
    got = [spark.range(1).select(measures.rounded(F.lit(x), n).alias("v")).first()["v"] for x, n in cases]
    assert got == want and got[0] == 0.5034
    assert values(spark.range(1).select(measures.rounded(F.lit(None).cast("double"), 2).alias("v"))) == [None]


def test_ids_are_padded_and_may_grow(spark):
    frame = spark.createDataFrame([(1,), (1234,)], "n long")
    assert values(frame.select(text.numbered_id("RT", F.col("n")).alias("v"))) == ["RT001", "RT1234"]


def test_dates_parse_or_become_null(spark):
    frame = spark.createDataFrame([("1/31/2018 22:56",), ("13/45/2018 1:00",), ("",), (None,)], "s string")
    parsed = values(frame.select(timeparts.parse_order_date(F.col("s")).alias("v")))
    assert str(parsed[0]) == "2018-01-31 22:56:00" and parsed[1:] == [None, None, None]
    iso = spark.createDataFrame([("2024-01-05T10:00:00Z",), ("soon",)], "s string")
    assert [v is None for v in values(iso.select(timeparts.parse_iso_timestamp(F.col("s")).alias("v")))] == [False, True]


def test_weekday_numbers(spark):
    days = spark.createDataFrame([("Monday",), ("SUNDAY",), ("Someday",)], "s string")
    assert values(days.select(timeparts.weekday_number(F.col("s")).alias("v"))) == [0, 6, None]
    one = spark.createDataFrame([(date(2024, 1, 1),)], "d date")  # a Monday
    assert values(one.select(timeparts.monday_based_weekday(F.col("d")).alias("v"))) == [0]


def test_hash_slot_is_pinned(spark):
    row = spark.range(1).select(
        F.xxhash64(F.lit("180517")).alias("h"), hashing.hash_slot(F.lit(180517), 6).alias("slot")
    ).first()
    assert (row["h"], row["slot"]) == (2740953342744520280, 2)


def test_cohort_equals_sha256(spark):
    ids = [str(i) for i in range(300)]
    frame = spark.createDataFrame([(i,) for i in ids], "id string")

    def member(i, percent):
        bucket = int.from_bytes(hashlib.sha256(f"42:{i}".encode()).digest()[:8], "big") / ((1 << 64) - 1)
        return percent >= 100 or bucket < percent / 100.0

    for percent in (0.5, 60.0, 75.0, 100.0):
        chosen = frame.filter(hashing.in_cohort(F.lit(42), F.col("id"), F.lit(percent)))
        assert {r["id"] for r in chosen.collect()} == {i for i in ids if member(i, percent)}


def test_risk_tiers_at_the_bounds(spark):
    frame = spark.createDataFrame([(p,) for p in (0.0, 0.399999, 0.4, 0.699999, 0.6999996, 0.7, 1.0)], "p double")
    tiers = values(frame.select(measures.risk_tier(F.col("p")).alias("v")))
    assert tiers == ["LOW", "LOW", "MEDIUM", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


def test_lenient_numbers(spark):
    frame = spark.createDataFrame([("2.5",), ("x",), (None,)], "s string")
    assert values(frame.select(measures.number_or_zero(F.col("s")).alias("v"))) == [2.5, 0.0, 0.0]
    assert spark.range(1).select(measures.flag_or_false(F.lit(None)).alias("v")).first()["v"] is False


def test_calendar_covers_a_month_on_each_side(spark):
    frame = spark.createDataFrame([(date(2015, 1, 31), date(2015, 3, 15)), (date(2015, 2, 2), None)], "a date, b date")
    rows = dims.build_date_dim((frame, "a"), (frame, "b")).orderBy("full_date").collect()
    expected = pd.date_range("2014-12-01", "2015-04-15", freq="D")
    assert [r["full_date"] for r in rows] == [d.date() for d in expected]
    assert [r["date_key"] for r in rows] == [int(d.strftime("%Y%m%d")) for d in expected]
    assert [r["day_of_week"] for r in rows] == [d.day_name() for d in expected]
    assert [r["is_weekend"] for r in rows] == [d.dayofweek >= 5 for d in expected]
    assert [r["quarter"] for r in rows] == [d.quarter for d in expected]


def test_row_numbers_follow_the_order_across_partitions(spark):
    words = [f"{(i * 7919) % 5003:05d}" for i in range(3000)]
    frame = spark.createDataFrame([(w,) for w in words], "w string").repartition(7)
    numbered = with_row_number(frame, ["w"], "n").collect()
    assert [r["w"] for r in sorted(numbered, key=lambda r: r["n"])] == sorted(words)
    assert sorted(r["n"] for r in numbered) == list(range(1, len(words) + 1))


def test_route_and_region_dimensions(spark):
    orders = spark.createDataFrame(
        [("Europe", "West  Europe "), ("Europe", " West Europe"), ("Africa", "North"), ("USCA", "US Center "), ("USCA", None)],
        "market string, order_region string",
    )
    routes = dims.build_route_dim(orders.filter("order_region is not null")).orderBy("route_id").collect()
    assert [tuple(r) for r in routes] == [
        ("RT001", "Africa", "North"), ("RT002", "Europe", "West Europe"), ("RT003", "USCA", "US Center"),
    ]
    regions = dims.build_region_keys(orders).orderBy("warehouse_id").collect()
    assert [r["region"] for r in regions] == sorted(["West  Europe ", " West Europe", "North", "US Center "])
    assert regions[0]["warehouse_name"] == "Warehouse " + regions[0]["region"]
