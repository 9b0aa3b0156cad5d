"""Set operations, de-duplication and ordering."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col
from strata.operators.timeseries import last_per


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def distinct(df: DataFrame) -> DataFrame:
    """U3."""
    return df.distinct()


def dedup_first(df: DataFrame, subset: Sequence[str], order: Sequence) -> DataFrame:
    """U4: one row per ``subset``: the first under ``order`` (deterministic,
    unlike ``dropDuplicates``). Partial aggregate — safe on hot keys."""
    return last_per(df, subset, order, first=True, null_keys="keep")


def dedup_last(df: DataFrame, subset: Sequence[str], order: Sequence) -> DataFrame:
    """One row per ``subset``: the last under ``order``."""
    return last_per(df, subset, order, first=False, null_keys="keep")


def missing_from(batch: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct batch keys absent from the history (anti-join)."""
    return batch.select(*keys).distinct().join(history.select(*keys), list(keys), "left_anti")


def all_present(batch: DataFrame, history: DataFrame, keys: Sequence[str]) -> Column:
    """Scalar boolean — every batch key already exists in the history."""
    return missing_from(batch, history, keys).select(F.count(F.lit(1)) == 0).scalar()


def sort(df: DataFrame, keys: Sequence, ascending: bool = True) -> DataFrame:
    """O1: total sort (only meaningful at a sink)."""
    return df.orderBy(*[col(k).asc() if ascending else col(k).desc() for k in keys])


def tail(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """O2: last ``n`` rows under ``order`` (a top-k: each task keeps n rows)."""
    return df.orderBy(*[col(k).desc() for k in order]).limit(n)


def first_last(df: DataFrame, c, keys=None) -> DataFrame:
    """O3: first and last value of an ordered period column, explicitly."""
    aggs = [F.min(col(c)).alias("first"), F.max(col(c)).alias("last")]
    if keys:
        return df.groupBy(*([keys] if isinstance(keys, str) else keys)).agg(*aggs)
    return df.agg(*aggs)
