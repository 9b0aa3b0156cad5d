"""Feeds side by side with their spine, each in tasks of its own and read once."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.plans.registry import QUERIES, load_catalog
from strata.session import scratch_path

KEYS = ["d", "k"]
ROWS = [("m", "a", 1, "x"), ("m", "a", 2, "x"), ("m", "a", 4, "y"), ("m", None, 8, "x"), (None, "b", 16, "y"), ("n", "c", None, "x"), ("n", "z", 32, "y")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_feeds_aggregated_by_the_keys_are_dealt_anew(spark):
    rows = spark.createDataFrame(ROWS, "d string, k string, v long, t string")
    spine = rows.filter("k is null or k <> 'z'").select(*KEYS).distinct()
    feeds = {t: (rows.filter(F.col("t") == t).groupBy(*KEYS).agg(F.sum("v").alias("v")), "v") for t in "xy"}
    out = J.widen(spine, feeds, KEYS)
    assert out.columns == [*KEYS, "x", "y"]
    assert got(out) == sorted([("m", "a", 3, 4), ("m", None, 8, None), (None, "b", None, 16), ("n", "c", None, None)], key=repr)
    assert "Exchange" in plan(J.widen(spine, feeds, KEYS)).split("Union")[0]  # else one task holds the hash tables of all feeds


@pytest.mark.parametrize(("agg", "a"), [("sum", (7, 70)), ("max", (4, 40)), ("first", (1, 10))])
def test_a_frame_that_is_spine_and_feeds_is_read_once(spark, agg, a):
    rows = spark.createDataFrame(ROWS, "d string, k string, v long, t string").select(*KEYS, "v", (F.col("v") * 10).alias("w"))
    out = J.widen(rows, {"v": (rows, "v"), "w": (rows, "w")}, KEYS, agg=agg)
    assert got(out) == sorted([("m", "a", *a), ("m", None, 8, 80), (None, "b", 16, 160), ("n", "c", None, None), ("n", "z", 32, 320)], key=repr)
    assert plan(J.widen(rows, {"v": (rows, "v"), "w": (rows, "w")}, KEYS, agg=agg)).count("Scan") == 1


def test_keys_of_other_widths_and_cases_meet(spark):
    spine = spark.createDataFrame([(1, "a"), (2, "b")], "K long, d string")
    feed = spark.createDataFrame([(1, "a", 5), (3, "a", 6)], "k int, d string, v long")
    assert got(J.widen(spine, {"v": (feed, "v")}, ["k", "d"])) == [(1, "a", 5), (2, "b", None)]


def test_wide_usage_reads_the_view_once(spark):
    base, day = scratch_path(spark, "usage"), dt.datetime(2024, 1, 1, 5)
    rows = [(1, day, 7, "view"), (2, day, 7, "view"), (3, day, 7, "purchase"), (4, day, None, "click"), (5, None, 7, "signup"), (5, None, 7, "signup")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{base}/events.parquet")
    load_catalog()
    out = QUERIES["m60_usage_wide"](spark, base)
    assert out.columns == ["Date", "OdsCode", "Logins", "RecordViews", "Prescriptions", "P9NewAppUsers"]
    assert got(out) == sorted([("2024-01-01", 7, 2.0, 0.0, 1.0, 0.0), ("2024-01-01", None, 0.0, 1.0, 0.0, 0.0), (None, 7, 0.0, 0.0, 0.0, 2.0)], key=repr)
    assert plan(QUERIES["m60_usage_wide"](spark, base)).count("FileScan") == 1
