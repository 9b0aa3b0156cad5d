"""Distinct values in the run log: an exact count and a mergeable sketch of each column.

The newest drop is compared with the log alone; no earlier drop is read again. Counts are exact always. The sketches
(theta, ``2 ** lg_k`` values) answer what counts can't: how many values are new or gone, and how many there were over all runs.
These are exact while no side has more than ``2 ** lg_k`` values (``certain``); beyond, the standard error of a sketch is
``2 ** (-lg_k / 2)`` of the union, and changes of a few values can go unseen, so ``unchanged`` is null unless the counts differ.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 16
LOG_SCHEMA = "load_date TIMESTAMP, file_name STRING, column STRING, distinct_count BIGINT, sketch BINARY"


def _text(c: str) -> Column:
    """Sketches take text, numbers or bytes; every type has a text form, under which equal values are equal."""
    return F.col(c).cast("string")


def distinct_log(df: DataFrame, file_name: str, columns: Sequence[str], load_date: str | None = None, drop: str | None = None,
                 lg_k: int = LG_K) -> DataFrame:
    """One log row for each column, nulls not counted; ``drop`` names a date column, for a log of all drops of ``df`` in one pass.
    An empty drop has counts of 0 and empty sketches."""
    aggs = [a for i, c in enumerate(columns) for a in (F.count_distinct(_text(c)).alias(f"_n{i}"), F.theta_sketch_agg(_text(c), lg_k).alias(f"_s{i}"))]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("distinct_count"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]
    wide = df.agg(*aggs) if drop is None else df.groupBy(drop).agg(*aggs)
    day = (F.lit(load_date) if drop is None else F.col(drop)).cast("timestamp").alias("load_date")
    return wide.select(day, F.inline(F.array(*rows))).select("load_date", F.lit(file_name).alias("file_name"), "column", "distinct_count", "sketch")


def distinct_change(now: DataFrame, log: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Log rows of the newest drop (``now``) against the last earlier ones of the same file and column.

    Returns ``file_name, column, now, previous, added, removed, over_runs, certain, unchanged``; without an earlier run
    ``previous``, ``added``, ``removed`` and ``unchanged`` are null. ``over_runs``: values over all runs, this one included."""
    at = ["file_name", "column"]
    dated = now.select(*at, F.col("load_date").alias("_now"), F.col("distinct_count").alias("now"), F.col("sketch").alias("_sketch"))
    earlier = dated.select(*at, "_now").join(log, at).where(F.col("load_date") < F.col("_now")).groupBy(*at).agg(
        F.max_by(F.struct("distinct_count", "sketch"), "load_date").alias("_last"), F.theta_union_agg("sketch", lg_k).alias("_all"))
    size = F.theta_sketch_estimate
    x = dated.join(earlier, at, "left").select(
        *at, "now", F.col("_last.distinct_count").alias("previous"),
        size(F.theta_difference("_sketch", "_last.sketch")).alias("added"), size(F.theta_difference("_last.sketch", "_sketch")).alias("removed"),
        F.coalesce(size(F.theta_union("_sketch", "_all", lg_k)), F.col("now")).alias("over_runs"))
    x = x.withColumn("certain", (F.greatest("now", "previous") <= 2**lg_k))
    same = (F.col("added") == 0) & (F.col("removed") == 0)
    return x.withColumn("unchanged", F.when(F.col("now") != F.col("previous"), False).when(F.col("certain"), same))
