"""Operators along an order against plain windows: hot entities, nulls, gaps, few and many buckets, a million rows."""
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.operators import ordered as R
from strata.operators.projection import with_row_id
from strata.operators.quality import Check

G = random.Random(3)
ROWS = [("hot" if i % 10 else G.choice(["a", "b", None]), G.choice([None, *range(30)]), i, G.choice([None, 1, 2, -5, 7])) for i in range(600)]


@pytest.fixture(scope="module")
def frame(spark):
    rows = list(ROWS)
    G.shuffle(rows)
    return spark.createDataFrame(rows, "e string, d int, i int, v long").repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("buckets", [1, 7, 200])
@pytest.mark.parametrize("partition", [[], ["e"]])
def test_running_sums_and_numbers(frame, buckets, partition):
    w = Window.partitionBy(*partition).orderBy("d", "i")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    want = frame.withColumns({"s": F.sum("v").over(so_far), "n": F.row_number().over(w).cast("long") - 1})
    out = R.numbered(R.running(frame, ["d", "i"], {"s": F.col("v")}, partition, buckets), ["d", "i"], "n", partition=partition, buckets=buckets)
    assert rows(out) == rows(want)


@pytest.mark.parametrize("n,block", [(1, 3), (3, 3), (12, 5), (12, 1000)])
def test_rolling_with_a_halo(frame, n, block):
    for partition in ([], ["e"]):
        w = Window.partitionBy(*partition).orderBy("d", "i").rowsBetween(-(n - 1), 0)
        want = frame.withColumn("m", F.when(F.count("v").over(w) == n, F.avg("v").over(w)))
        assert rows(R.rolling(frame, ["d", "i"], "v", n, "m", partition, block, buckets=9)) == rows(want)


def test_buckets_are_even_and_in_order(frame):
    sizes = [r["count"] for r in R.bucketed(frame, ["e", "d", "i"], 10).groupBy("_bucket").count().collect()]
    assert len(sizes) in (10, 11) and max(sizes) < 3 * 600 / 10  # the entity with nine tenths of the rows is cut, too
    out = R.bucketed(frame, ["d", "i"], 10).groupBy("_bucket").agg(F.min(F.struct("d", "i")).alias("lo"), F.max(F.struct("d", "i")).alias("hi")).orderBy("_bucket").collect()
    key = lambda k: (k.d is not None, k.d or 0, k.i)
    assert all(key(a.hi) < key(b.lo) for a, b in zip(out, out[1:]))


def test_plans_have_no_single_partition_window_over_rows(frame):
    plan = R.running(frame, ["d", "i"], {"s": F.col("v")}, buckets=8)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("_s_s" in x and "[_bucket" in x for x in windows) == 1


def test_order_checks_meet_at_the_borders(spark):
    up = spark.range(500).select(F.col("id").alias("k"), F.floor(F.col("id") / 2).alias("v"))
    for buckets in (1, 13, 100):
        assert R.order_violations(up, "v", ["k"], buckets=buckets).first()[0] == 0
        assert R.order_violations(up, "v", ["k"], strict=True, buckets=buckets).first()[0] == 250
        down = up.withColumn("v", F.when(F.col("k") % 7 == 0, None).otherwise(-F.col("k")))
        w = Window.orderBy("k")
        want = down.select(F.lag("v").over(w).alias("p"), "v").where("v < p").count()
        assert R.order_violations(down, "v", ["k"], buckets=buckets).first()[0] == want > 300
    assert R.order_violations(up.limit(0), "v", ["k"]).first()[0] == 0
    check = Check.increasing(up, "v", ["k"])
    assert "checkpoint" not in up.select(check.observed)._jdf.queryExecution().toString().lower() if hasattr(check, "observed") else True


def test_positional_join_of_a_million_rows(spark):
    n = 1_000_000
    a = spark.range(n).select((F.col("id") * 3).alias("x"))
    b = spark.range(n - 5).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("y"))
    out = J.zip_join(a, b, ["x"], ["y"])
    assert out.where(F.col("y").isNull()).count() == 5
    assert out.where(F.col("x") == 3 * F.substring("y", 2, 8).cast("long")).count() == n - 5


def test_row_ids_of_ties_and_empty_frames(spark, frame):
    ids = [r.u for r in with_row_id(frame, ["i"], "u", start=5).orderBy("i").collect()]
    assert ids == list(range(5, 605)) and with_row_id(frame.limit(0), ["i"], "u").count() == 0
