"""Aggregations.

All group-bys are hash aggregates with map-side partial aggregation, so a hot
key is pre-combined on every executor before the shuffle. pandas semantics
are explicit: null keys are dropped (T5) and the sum of an all-null group is
0 (T6) unless asked otherwise. Values broadcast back to rows go through an
aggregate + join (skew-split by AQE) instead of an unsplittable window.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def drop_null_keys(df: DataFrame, keys: Sequence) -> DataFrame:
    cond = None
    for k in keys:
        c = col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.filter(cond) if cond is not None else df


def sum_by(df: DataFrame, keys, measures, null_keys: str = "drop", null_sum=0, names: Mapping[str, str] | None = None) -> DataFrame:
    """A1: sum of one or more measures by keys."""
    keys = _keys(keys)
    measures = [measures] if isinstance(measures, str) else list(measures)
    src = drop_null_keys(df, keys) if null_keys == "drop" else df
    names = names or {}
    aggs = []
    for m in measures:
        s = F.sum(col(m))
        if null_sum is not None:
            s = F.coalesce(s, F.lit(null_sum))
        aggs.append(s.alias(names.get(m, m)))
    return src.groupBy(*keys).agg(*aggs)


def monthly_sum(df: DataFrame, date, measures, fmt: str = "yyyy-MM", name: str = "Month", null_sum=0) -> DataFrame:
    """A2: format the date to a month label and sum every measure."""
    measures = [measures] if isinstance(measures, str) else list(measures)
    keyed = df.filter(col(date).isNotNull()).withColumn(name, F.date_format(col(date), fmt))
    return sum_by(keyed, [name], measures, null_keys="keep", null_sum=null_sum)


def count_by(df: DataFrame, keys, name: str = "count", value=None, null_keys: str = "drop") -> DataFrame:
    """A3: row count per keys (``value`` given: non-null count of it)."""
    keys = _keys(keys)
    src = drop_null_keys(df, keys) if null_keys == "drop" else df
    c = F.count(F.lit(1)) if value is None else F.count(col(value))
    return src.groupBy(*keys).agg(c.cast("long").alias(name))


def agg_by(df: DataFrame, keys, spec: Sequence[tuple[str, str, str]], null_keys: str = "drop") -> DataFrame:
    """A4: mixed aggregates ``[(func, column, alias)]`` per group."""
    keys = _keys(keys)
    src = drop_null_keys(df, keys) if null_keys == "drop" else df
    fns = {
        "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
        "max": F.max,
        "min": F.min,
        "count": lambda c: F.count(c).cast("long"),
        "size": lambda c: F.count(F.lit(1)).cast("long"),
        "mean": F.avg,
        "nunique": lambda c: F.count_distinct(c).cast("long"),
        "first_nonnull": lambda c: F.min(c),
    }
    return src.groupBy(*keys).agg(*[fns[f](col(c)).alias(a) for f, c, a in spec])


def cond_counts(df: DataFrame, keys, value, categories: Mapping[str, object], answered: str | None = "Answered", pct: Mapping[str, tuple[str, str]] | None = None, dp: int = 4) -> DataFrame:
    """A5: per-category counts (``count_if``), answered count and percentages."""
    keys = _keys(keys)
    aggs = [F.count_if(col(value) == v).cast("long").alias(n) for n, v in categories.items()]
    if answered:
        aggs.append(F.count(col(value)).cast("long").alias(answered))
    out = drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)
    for name, (num, den) in (pct or {}).items():
        out = out.withColumn(name, F.bround(F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")), dp))
    return out


def coverage(df: DataFrame, keys, flag, total: str = "Total", hits: str = "Connected", pct: str = "Percent", dp: int = 4) -> DataFrame:
    """Size, sum of a 0/1 flag and the share per group."""
    keys = _keys(keys)
    out = drop_null_keys(df, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias(total), F.coalesce(F.sum(col(flag)), F.lit(0)).cast("long").alias(hits)
    )
    return out.withColumn(pct, F.bround(F.try_divide(F.col(hits).cast("double"), F.col(total).cast("double")), dp))


def headline_row(df: DataFrame, aggs: Sequence[Column], labels: Mapping[str, object] | None = None) -> DataFrame:
    """Global aggregate into a single labelled row."""
    out = df.agg(*aggs)
    for k, v in (labels or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def paired_ack_count(df: DataFrame, fine_keys, coarse_keys, name: str = "n") -> DataFrame:
    """Count per fine key, floor(n/2) (pairs), re-sum per coarse key."""
    fine = count_by(df, fine_keys, name="_n")
    halves = fine.withColumn("_h", F.floor(F.col("_n") / 2).cast("long"))
    return halves.groupBy(*_keys(coarse_keys)).agg(F.sum("_h").cast("long").alias(name))


def share_within(df: DataFrame, group, sub, name: str = "count", share: str = "share", dp: int = 4) -> DataFrame:
    """Count per (group, sub) and its share of the group's count."""
    g = _keys(group)
    fine = count_by(df, g + _keys(sub), name=name)
    tot = fine.groupBy(*g).agg(F.sum(name).alias("_tot"))
    return fine.join(tot, g).withColumn(
        share, F.bround(F.try_divide(F.col(name).cast("double"), F.col("_tot").cast("double")), dp)
    ).drop("_tot")


def n_unique(df: DataFrame, c, keys=None, name: str = "n_unique", approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A10: distinct count (HyperLogLog++ when ``approx``)."""
    a = F.approx_count_distinct(col(c), rsd) if approx else F.count_distinct(col(c))
    a = a.cast("long").alias(name)
    return df.groupBy(*_keys(keys)).agg(a) if keys else df.agg(a)


def scalar_agg(df: DataFrame, c, funcs: Sequence[str] = ("min", "max", "sum", "count")) -> DataFrame:
    """One-row scalar aggregates."""
    m = {"min": F.min, "max": F.max, "sum": F.sum, "count": lambda x: F.count(x).cast("long"), "mean": F.avg}
    return df.agg(*[m[f](col(c)).alias(f"{f}_{c}") for f in funcs])


def column_totals(df: DataFrame, measures: Sequence[str], name_col: str = "column", value_col: str = "total") -> DataFrame:
    """Totals of every measure, transposed to (column, total) rows."""
    wide = df.agg(*[F.coalesce(F.sum(col(m)), F.lit(0)).cast("double").alias(m) for m in measures])
    return wide.unpivot([], list(measures), name_col, value_col)


def pivot_sum(df: DataFrame, keys, pivot_col, value, categories: Sequence, fill=0, agg: str = "sum") -> DataFrame:
    """Pivot long -> wide over a fixed category list, fill absent cells."""
    keys = _keys(keys)
    f = {"sum": F.sum, "mean": F.avg, "max": F.max, "count": F.count}[agg]
    out = drop_null_keys(df, keys).groupBy(*keys).pivot(pivot_col, list(categories)).agg(f(col(value)))
    if fill is not None:
        out = out.na.fill(fill, subset=[str(c) for c in categories])
    return out


def categories_of(df: DataFrame, c: str, known: Sequence[str] = (), most: int = 500) -> list[str]:
    """The columns of a pivot over whatever occurs: ``known`` first, then the others found, in order. The values come to the
    driver, as column names must; more than ``most`` raise, and none is dropped silently."""
    found = [r[0] for r in df.where(col(c).isNotNull()).select(col(c)).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{c} has more than {most} values, too many for columns")
    return [*known, *sorted(set(found) - set(known))]


def pivot_multi(df: DataFrame, keys, pivot_col, values: Sequence[str], categories: Sequence, sep: str = "_", fill=0) -> DataFrame:
    """Pivot several value columns; names ``<value><sep><category>``."""
    keys = _keys(keys)
    out = drop_null_keys(df, keys).groupBy(*keys).pivot(pivot_col, list(categories)).agg(
        *[F.sum(col(v)).alias(v) for v in values]
    )
    ren = {f"{c}_{v}": f"{v}{sep}{c}" for c in categories for v in values}
    out = out.withColumnsRenamed(ren)
    if fill is not None:
        out = out.na.fill(fill, subset=list(ren.values()))
    return out


def duplicates(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Rows whose key occurs more than once, with the key's count.

    Counts are a partial aggregate; the offending keys are joined back by a
    join that spreads a hot key, rather than windowed.
    """
    from strata.operators.timeseries import attach

    keys = _keys(keys)
    dup = count_by(df, keys, name=name).filter(F.col(name) > 1)
    return attach(df, dup, keys, "inner", rows=name)


def suppressed_share(df: DataFrame, number_col: str, value_col: str, whole: Column, parts: Column, token: str = "*") -> tuple[Column, Column]:
    """``total`` and ``fill`` for ``impute_suppressed`` where the numbers of all part rows, suppressed or not, are taken off the
    whole, and what is left is shared out over all suppressed cells."""
    stats = df.agg(
        F.coalesce(F.sum(F.when(whole, F.col(number_col).cast("double"))), F.lit(0.0)).alias("_whole"),
        F.coalesce(F.sum(F.when(parts, F.col(number_col).cast("double"))), F.lit(0.0)).alias("_parts"),
        F.count_if(col(value_col) == token).cast("double").alias("_n"))
    total = stats.select("_whole").scalar()
    return total, F.try_divide(total - stats.select("_parts").scalar(), stats.select("_n").scalar())


def impute_suppressed(df: DataFrame, value_col: str, total, fill: Column | None = None, token: str = "*", name: str | None = None) -> DataFrame:
    """Replace suppressed cells with (total - sum known) / n suppressed, or with ``fill``.

    ``total`` is a scalar Column (e.g. a scalar subquery of the national
    figure) or a number; known/suppressed counts come from one aggregate.
    """
    name = name or value_col
    known = col(value_col).try_cast("double")
    if fill is None:
        stats = df.agg(
            F.coalesce(F.sum(F.when(col(value_col) != token, known)), F.lit(0.0)).alias("_known"),
            F.count_if(col(value_col) == token).alias("_n"),
        )
        tot = total if isinstance(total, Column) else F.lit(float(total))
        fill = F.try_divide(tot - stats.select("_known").scalar(), stats.select(F.col("_n").cast("double")).scalar())
    return df.withColumn(name, F.when(col(value_col) == token, fill).otherwise(known))


def supplier_flag(df: DataFrame, keys, supplier, match: str, name: str = "flag") -> DataFrame:
    """De-duplicate (keys, supplier), flag rows whose supplier contains ``match``."""
    keys = _keys(keys)
    d = df.select(*[col(k) for k in keys], col(supplier).alias("_s")).distinct()
    return d.withColumn(name, F.when(F.coalesce(F.contains(F.col("_s"), F.lit(match)), F.lit(False)), 1).otherwise(0)).withColumnRenamed("_s", supplier if isinstance(supplier, str) else "supplier")


def totals_by_org(df: DataFrame, keys, stock: Sequence[str] = (), flow: Sequence[str] = ()) -> DataFrame:
    """MAX of stock columns and SUM of flow columns per org."""
    keys = _keys(keys)
    aggs = [F.max(col(c)).alias(c) for c in stock] + [F.sum(col(c)).alias(c) for c in flow]
    return df.groupBy(*keys).agg(*aggs)


def month_wide(df: DataFrame, date, keys, measures: Sequence[str], name: str = "Month") -> DataFrame:
    """Month-grain roll-up: ``trunc(date,'MM')`` + keys, sum of measures."""
    keyed = df.withColumn(name, F.trunc(col(date), "MM"))
    return keyed.groupBy(name, *_keys(keys)).agg(*[F.sum(col(m)).alias(m) for m in measures])
