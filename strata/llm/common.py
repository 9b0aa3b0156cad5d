"""Helpers shared by the corpus operators."""
from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: later stages re-read the files instead of recomputing,
    also after an executor is lost, and Spark knows the table's true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same on pure ASCII text and is much cheaper."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, LOWER)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_total(
    df: DataFrame, key: str, order: list[str], value: Column, name: str, rows_per_bucket: int = 500, repeats: int = 8000,
) -> DataFrame:
    """Exclusive running sum of ``value`` within ``key``, along ``order``, for keys of any size.

    ``order[0]`` must be a long spread evenly over the 64-bit range (a hash);
    its high bits cut every key into buckets. A window runs inside each bucket
    and the bucket totals (one row per key and bucket) are summed separately,
    so that no task ever gets a whole key. The result does not depend on the
    number of buckets.

    Rows that are equal in all of ``order`` share a bucket. Of those that come more than ``repeats`` times (or
    a ten-thousandth of all rows, if that is more) one row stands for all in the bucket, and the rows
    themselves are numbered apart, by a hash of their place in a settled table.
    """
    n = df.count()
    bits = min(20, max(3, math.ceil(math.log2(max(1, n / rows_per_bucket)))))
    limit = max(repeats, n // 10_000)
    # a key that is never null: the join then has the window's partitioning, and wide rows move once
    with_bucket = df.withColumns({
        "_rt_key": F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")),
        "_rt_bucket": F.shiftright(F.col(order[0]), 64 - bits), "_rt_value": value.cast("long")})
    totals = settle(with_bucket.groupBy("_rt_key", "_rt_bucket").agg(
        F.sum("_rt_value").alias("_rt_sum"), F.count(F.lit(1)).alias("_rt_rows")), "bucket-totals")
    before = Window.partitionBy("_rt_key").orderBy("_rt_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_rt_key", "_rt_bucket", F.coalesce(F.sum("_rt_sum").over(before), F.lit(0)).alias("_rt_offset"))
    inside = Window.partitionBy("_rt_key", "_rt_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rt_value").over(inside), F.lit(0))

    def added(local: DataFrame) -> DataFrame:
        return (
            local.join(offsets, ["_rt_key", "_rt_bucket"])
            .withColumn(name, (F.col("_rt_offset") + F.col("_rt_local")).cast("long"))
            .drop("_rt_key", "_rt_bucket", "_rt_value", "_rt_local", "_rt_offset")
        )

    full = totals.where(F.col("_rt_rows") > limit).select("_rt_key", "_rt_bucket")  # fewer than 10,000, as each holds over a ten-thousandth
    repeated = None if full.isEmpty() else _repeated(with_bucket.join(F.broadcast(full), ["_rt_key", "_rt_bucket"]), order, start, limit)
    if repeated is None:
        return added(with_bucket.withColumn("_rt_local", start))

    same = reduce(and_, (with_bucket[c].eqNullSafe(F.col(f"_rt_o{i}")) for i, c in enumerate(order)), with_bucket["_rt_key"] == F.col("_rt_k"))
    marks = repeated.select(
        F.col("_rt_key").alias("_rt_k"), *[F.col(c).alias(f"_rt_o{i}") for i, c in enumerate(order)], F.col("_rt_local").alias("_rt_first"),
        F.row_number().over(Window.orderBy("_rt_key", *order)).alias("_rt_group"))
    marks = settle(marks, "repeated-rows")  # at most 10,000 rows
    places = [f"_rt_o{i}" for i in range(len(order))]
    others = with_bucket.join(F.broadcast(marks), same, "left_anti")
    line = others.unionByName(repeated.drop("_rt_local").withColumn("_rt_stands", F.lit(True)), allowMissingColumns=True)
    single = added(line.withColumn("_rt_local", start).where(F.col("_rt_stands").isNull()).drop("_rt_stands"))
    copies = settle(
        with_bucket.join(F.broadcast(marks), same).drop("_rt_k", *places)
        .withColumn("_rt_uid", F.monotonically_increasing_id()), "copies").withColumn("_rt_place", F.xxhash64("_rt_uid"))
    kept = copies.select(
        F.struct(*df.columns, "_rt_key", "_rt_bucket", "_rt_first").alias("_rt_row"), "_rt_group", "_rt_place", "_rt_uid", F.col("_rt_value").alias("_rt_own"))
    numbered = running_total(kept, "_rt_group", ["_rt_place", "_rt_uid"], F.col("_rt_own"), "_rt_copy", rows_per_bucket, repeats)
    several = numbered.select("_rt_row.*", (F.col("_rt_row._rt_first") + F.col("_rt_copy")).alias("_rt_local"))
    return single.unionByName(
        several.join(F.broadcast(offsets.join(full, ["_rt_key", "_rt_bucket"], "left_semi")), ["_rt_key", "_rt_bucket"])
        .select(*df.columns, (F.col("_rt_offset") + F.col("_rt_local")).cast("long").alias(name)))


def _repeated(rows: DataFrame, order: list[str], start: Column, limit: int) -> DataFrame | None:
    """One row for those of ``rows`` that are equal in key and order more than ``limit`` times: their sum and its start in the bucket."""
    alike = settle(
        rows.groupBy("_rt_key", "_rt_bucket", *order).agg(F.sum("_rt_value").alias("_rt_value"), F.count(F.lit(1)).alias("_rt_rows"))
        .withColumn("_rt_local", start), "alike")
    many = alike.where(F.col("_rt_rows") > limit).drop("_rt_rows")
    return None if many.isEmpty() else many


def roots(edges: DataFrame, rows_per_task: int = 250_000) -> DataFrame | None:
    """(nid, root) of every end of ``edges`` (a, b): the smallest nid that can be reached; None without edges.

    Each round gives every node its smallest neighbour, then that one's, and keeps the edges between different
    ones under their new names. So a round leaves at most a quarter of a path, a star is done in one, and later rounds
    are small: they are written in few files.
    """
    named: DataFrame | None = None
    left = settle(edges.where(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while n := left.count():
        few = max(4, math.ceil(n / rows_per_task))
        lower = left.select(F.col("b").alias("nid"), F.col("a").alias("up")).unionByName(
            left.select(F.col("a").alias("nid"), F.col("a").alias("up"))).groupBy("nid").agg(F.min("up").alias("up"))
        lower = settle(lower.coalesce(few), "lower")
        above = lower.select(F.col("nid").alias("up"), F.col("up").alias("next"))
        for _ in range(2):
            lower = lower.join(above, "up").select("nid", F.col("next").alias("up"))
        lower = settle(lower.coalesce(few), "lower")
        ends = lambda c: lower.select(F.col("nid").alias(c), F.col("up").alias(f"{c}_up"))
        left = settle(left.join(ends("a"), "a").join(ends("b"), "b").where(F.col("a_up") != F.col("b_up")).select(
            F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct().coalesce(few), "edges")
        if named is None:
            named = lower.withColumnRenamed("up", "root")
        else:
            newer = lower.select(F.col("nid").alias("root"), F.col("up").alias("newer"))
            named = named.join(newer, "root", "left").select("nid", F.coalesce("newer", "root").alias("root"))
    return None if named is None else settle(named, "roots")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Python stages get whole texts in Arrow batches of at most ``rows`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
