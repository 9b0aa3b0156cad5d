"""Operators along a total order, for tables of any size: running sums, row numbers, rolling windows, positional
joins and order checks that never put the table, or one entity of it, into one task.

The rows are cut into range buckets of their order key. The splitters are quantiles of a bounded sample (the rows
whose keys have the smallest hashes), had in a scalar subquery, so a row's bucket is a function of its key: nothing is
checkpointed, and a task that runs again gives the same rows. A window works inside each bucket; what buckets owe to
each other (totals, counts, border rows) is one row for each bucket and entity.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import col

MOST_BUCKETS = 256
SAMPLED = 16  # sampled keys for each bucket


def bucketed(df: DataFrame, order: Sequence, buckets: int | None = None, name: str = "_bucket") -> DataFrame:
    """``df`` with the number of each row's range bucket: rows of a smaller key are never in a later bucket.

    ``order`` should be a total order; rows of equal keys share a bucket. Nulls come first.
    """
    n = buckets or min(MOST_BUCKETS, max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    key = F.struct(*[col(o).alias(f"k{i}") for i, o in enumerate(order)])
    sample = df.select(key.alias("k")).orderBy(F.xxhash64("k")).limit(n * SAMPLED)
    splits = sample.agg(F.filter(F.sort_array(F.collect_list("k")), lambda k, i: (i + 1) % SAMPLED == 0)).scalar()
    with_splits = df.withColumn("_splits", splits)  # a subquery may not stand inside the filter itself
    return with_splits.withColumn(name, F.size(F.filter("_splits", lambda s: s < key))).drop("_splits")


def _on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join on keys that may be null."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(and_, (left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys))
    return left.join(renamed, cond).drop(*(f"_r_{k}" for k in keys))


def running(df: DataFrame, order: Sequence, values: Mapping[str, Column], partition: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Running sums of ``values`` (name -> Column) along ``order``, within ``partition`` if given; null until the first
    value, as a window's sum is. Two levels: a window inside (bucket, entity), and the buckets' totals summed before it."""
    partition = list(partition)
    placed = bucketed(df, [*partition, *order], buckets)
    placed = placed.withColumns({f"_v_{n}": c for n, c in values.items()})
    inside = Window.partitionBy("_bucket", *partition).orderBy(*[col(o) for o in order]).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"_s_{n}": F.sum(f"_v_{n}").over(inside) for n in values})
    totals = placed.groupBy("_bucket", *partition).agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values))
    before = Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *partition, *(F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in values))
    joined = _on(local, offsets, ["_bucket", *partition])
    out = {n: F.coalesce(F.col(f"_s_{n}") + F.col(f"_o_{n}"), F.col(f"_s_{n}"), F.col(f"_o_{n}")) for n in values}
    return joined.withColumns(out).select(*df.columns, *(n for n in values if n not in df.columns))


def numbered(df: DataFrame, order: Sequence, name: str, start: int = 0, partition: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Dense row numbers from ``start`` along ``order``, within ``partition`` if given."""
    return running(df, order, {name: F.lit(1).cast("long")}, partition, buckets).withColumn(name, F.col(name) + (start - 1))


def zipped(a: DataFrame, b: DataFrame, order_a: Sequence, order_b: Sequence, how: str = "left") -> DataFrame:
    """The i-th row of ``a`` with the i-th of ``b``: both sides numbered densely, then an equi-join on the number."""
    return numbered(a, order_a, "_pos").join(numbered(b, order_b, "_pos"), "_pos", how).drop("_pos")


def rolling(df: DataFrame, order: Sequence, value: str, n: int, name: str, partition: Sequence[str] = (), rows_per_block: int = 100_000,
            buckets: int | None = None) -> DataFrame:
    """Mean over the last ``n`` rows, null until ``n`` values are in the window. Rows are cut into blocks by their dense
    number, and the last ``n`` - 1 rows of a block go with the next one, too (its halo), where they are dropped after the window."""
    block = max(rows_per_block, n)
    placed = numbered(df, order, "_pos", partition=partition, buckets=buckets).withColumn("_block", F.floor(F.col("_pos") / block))
    halo = F.col("_pos") % block >= block - (n - 1)
    sent = placed.withColumn("_at", F.explode(F.when(halo, F.array(F.col("_block"), F.col("_block") + 1)).otherwise(F.array("_block"))))
    w = Window.partitionBy("_at", *partition).orderBy("_pos").rowsBetween(-(n - 1), 0)
    mean = F.when(F.count(F.col(value)).over(w) == n, F.avg(F.col(value)).over(w))
    return sent.withColumn("_mean", mean).where(F.col("_at") == F.col("_block")).withColumn(name, F.col("_mean")).select(
        *df.columns, *([] if name in df.columns else [name]))


def order_violations(df: DataFrame, value: str, order: Sequence, strict: bool = False, buckets: int | None = None) -> DataFrame:
    """One row with the number of rows whose ``value`` is below (``strict``: not above) the one before along ``order``.
    Rows are compared inside their bucket; of each bucket only the first and the last value meet its neighbours."""
    placed = bucketed(df.select(*order, F.col(value).alias("_v")), order, buckets)
    down = (lambda a, b: a <= b) if strict else (lambda a, b: a < b)
    inside = Window.partitionBy("_bucket").orderBy(*order)
    local = placed.select("_bucket", "_v", F.struct(*order).alias("_k"), down(F.col("_v"), F.lag("_v").over(inside)).alias("_down"))
    per = local.groupBy("_bucket").agg(F.count_if("_down").alias("_n"), F.min_by(F.struct("_v"), "_k").alias("_first"), F.max_by(F.struct("_v"), "_k").alias("_last"))
    along = Window.orderBy("_bucket")  # one row for each bucket
    border = down(F.col("_first._v"), F.lag("_last").over(along)["_v"])
    return per.select("_n", border.alias("_border")).agg((F.coalesce(F.sum("_n"), F.lit(0)) + F.count_if("_border")).alias("violations"))
