"""Time-series, window and resampling operators.

Rule of thumb used throughout: aggregate to period grain first, window
second. Global (un-partitioned) windows only ever see one row per period,
so their single task is bounded by the calendar, not by the data. Per-entity
windows run on (entity, period) aggregates, bounded by the calendar too.
"Latest"/"last" selections are aggregates (``max_by`` over a struct order),
which combine map-side and so survive a hot key.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import col
from strata.operators.aggregates import drop_null_keys, sum_by


def _keys(keys) -> list:
    if keys is None:
        return []
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def rolling_mean(df: DataFrame, order, c, n: int, name: str | None = None, partition=None) -> DataFrame:
    """Trailing mean over ``n`` rows; null until ``n`` non-null values
    are in the window (pandas ``rolling(n).mean()``)."""
    w = Window.partitionBy(*_keys(partition)).orderBy(*[col(o) for o in _keys(order)]).rowsBetween(-(n - 1), 0)
    avg = F.avg(col(c)).over(w)
    return df.withColumn(name or f"{c}_rolling_{n}", F.when(F.count(col(c)).over(w) == n, avg))


def cumsum(df: DataFrame, order, cols, partition=None, names: Mapping[str, str] | None = None) -> DataFrame:
    """Running sum over ordered rows (ROWS frame), optionally per entity."""
    w = Window.partitionBy(*_keys(partition)).orderBy(*[col(o) for o in _keys(order)]).rowsBetween(
        Window.unboundedPreceding, 0
    )
    names = names or {}
    out = df
    for c in _keys(cols):
        out = out.withColumn(names.get(c, f"cum_{c}"), F.sum(col(c)).over(w))
    return out


def cumsum_by(df: DataFrame, key, date, c, name: str | None = None) -> DataFrame:
    """Per-entity cumulative sum by date; same-day rows are summed first
    so the running value does not depend on input order."""
    daily = sum_by(df, [key, date], [c])
    return cumsum(daily, [date], [c], partition=[key], names={c: name or f"cum_{c}"})


def dense_cumsum(df: DataFrame, key, date, c, name: str | None = None, step: str = "1 day") -> DataFrame:
    """Per-entity cumulative series on every period from the entity's
    first observation to the global last period (carried forward over gaps;
    periods before an entity's first observation are absent).

    Each entity's calendar is exploded from its own start, so no
    entities x calendar scaffold is materialised beyond the output itself.
    """
    daily = sum_by(df, [key, date], [c])
    last = daily.select(F.max(date)).scalar()
    starts = daily.groupBy(key).agg(F.min(date).alias("_first"))
    spine = starts.select(key, F.explode(F.sequence(F.col("_first"), last, F.expr(f"INTERVAL {step}"))).alias(date))
    filled = spine.join(daily, [key, date], "left").na.fill(0, subset=[c])
    w = Window.partitionBy(key).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return filled.select(key, date, F.sum(c).over(w).alias(name or f"cum_{c}"))


HOT_ROWS, HOT_KEYS = 1_000_000, 1000  # the most frequent keys of more rows are hot; any other has less than a thousandth of all rows


def attach(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left", rows: str = "_rows", salts: int = 16,
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join per-group values (``groups``, with the group's number of rows in ``rows``) back to the rows of ``df``.

    The rows of a hot key are spread over ``salts`` join keys, its group is repeated for each; all others have one. (AQE can't split
    a hot key: the aggregate's output is already partitioned by it.) Which keys are hot comes as an array of at most ``HOT_KEYS``
    hashes from the exact counts; a key that shares a hot one's hash is spread, too.
    """
    key, n = F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.col(rows)
    most = groups.where(n > hot_rows).select(key.alias("_key"), n.alias("_n")).orderBy(F.desc("_n"), "_key").limit(HOT_KEYS)
    hot = most.select(F.sort_array(F.collect_set("_key"))).scalar()
    spread = groups.withColumn("_salt", F.explode(F.when(F.array_contains(hot, key), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts)).cast("int")
    salted = df.withColumn("_salt", F.when(F.array_contains(hot, key), place).otherwise(0))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


_N = "_rows"


def _counted(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    return df.groupBy(*keys).agg(value, F.count(F.lit(1)).alias(_N))


def n_in_group(df: DataFrame, keys, c=None, name: str = "n_in_group") -> DataFrame:
    """Group size (non-null count of ``c``) attached to every row.

    Aggregate + join instead of ``count() over (partition by …)``: the
    aggregate combines map-side, the join spreads a hot key.
    """
    keys = _keys(keys)
    cnt = F.count(F.lit(1)) if c is None else F.count(col(c))
    return attach(df, _counted(df, keys, cnt.cast("long").alias(name)), keys).drop(_N)


def any_flag(df: DataFrame, keys, cond: Column, name: str = "any_flag") -> DataFrame:
    """1 when any row of the group satisfies ``cond``, attached to rows."""
    keys = _keys(keys)
    return attach(df, _counted(df, keys, F.max(F.when(cond, 1).otherwise(0)).alias(name)), keys).drop(_N)


def latest_flag(df: DataFrame, keys, period, name: str = "latest") -> DataFrame:
    """1 when the row's period is the group's latest, else 0."""
    keys = _keys(keys)
    g = _counted(df, keys, F.max(col(period)).alias("_mx"))
    return attach(df, g, keys).withColumn(name, F.when(col(period) == F.col("_mx"), 1).otherwise(0)).drop("_mx", _N)


def order_key(order: Sequence, nulls_last_wins: Sequence[str] = ()) -> Column:
    """A struct ordering key. Columns in ``nulls_last_wins`` sort nulls after
    every value (pandas ``sort_values`` default), so null wins a max."""
    parts = []
    for o in order:
        name = o if isinstance(o, str) else None
        if name is not None and name in nulls_last_wins:
            parts.append(F.col(name).isNull())
        parts.append(col(o))
    return F.struct(*parts)


def last_per(df: DataFrame, keys, order: Sequence, nulls_last_wins: Sequence[str] = (), first: bool = False, null_keys: str = "drop") -> DataFrame:
    """The last (``first=True``: first) row of each group under a
    total ``order`` — ``max_by`` over a struct key, a partial aggregate."""
    keys = _keys(keys)
    src = drop_null_keys(df, keys) if null_keys == "drop" else df
    payload = [c for c in df.columns if c not in keys]
    key = order_key(order, nulls_last_wins)
    pick = F.min_by if first else F.max_by
    body = F.struct(*[F.col(f"`{c}`") for c in payload])
    return src.groupBy(*keys).agg(pick(body, key).alias("_r")).select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in payload])


def reduce_answers(df: DataFrame, entity: str, type_col: str, date: str, answer: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Last answer per (entity, type) by date, then one answer per entity
    by answer text ascending with nulls last (``tail(1)``: null > Yes > No)."""
    stage1 = last_per(df, [entity, type_col], [date, *tiebreak])
    return last_per(stage1, [entity], [answer, date, *tiebreak], nulls_last_wins=[answer])


def _period_label(c: Column, freq: str) -> Column:
    if freq == "MS":
        return F.trunc(c, "MM")
    if freq == "ME":
        return F.last_day(c)
    if freq == "W":
        return F.next_day(F.date_sub(c, 1), "SU")
    if freq == "D":
        return F.to_date(c)
    raise ValueError(freq)


_STEP = {"MS": "1 month", "ME": "1 month", "W": "7 days", "D": "1 day"}


def resample(df: DataFrame, date, measures: Sequence[str], freq: str = "MS", name: str | None = None, fill=0) -> DataFrame:
    """Pandas ``resample(freq).sum()`` — sum per period label and
    zero-fill every empty period between the first and last label.

    ``MS`` month start, ``ME`` month end, ``W`` week ending Sunday, ``D`` day.
    """
    name = name or (date if isinstance(date, str) else "period")
    labelled = df.filter(col(date).isNotNull()).withColumn("_p", _period_label(col(date), freq))
    agg = labelled.groupBy("_p").agg(*[F.sum(col(m)).alias(m) for m in measures])
    lo, hi = agg.select(F.min("_p")).scalar(), agg.select(F.max("_p")).scalar()
    if freq == "ME":
        cal = agg.sparkSession.range(1).select(
            F.explode(F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.expr("INTERVAL 1 month"))).alias("_s")
        ).select(F.last_day("_s").alias("_p"))
    else:
        cal = agg.sparkSession.range(1).select(F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {_STEP[freq]}"))).alias("_p"))
    out = cal.join(agg, "_p", "left")
    if fill is not None:
        out = out.na.fill(fill, subset=list(measures))
    return out.withColumnRenamed("_p", name)


def month_bucket_truncated_last(df: DataFrame, date, keys, measures: Sequence[str], name: str = "Date") -> DataFrame:
    """Month buckets labelled by month end, except the last month which
    is labelled by the true last date present."""
    mx = df.select(F.max(col(date))).scalar()
    labelled = df.withColumn(name, F.least(F.last_day(col(date)), F.to_date(mx)))
    return labelled.groupBy(name, *_keys(keys)).agg(*[F.sum(col(m)).alias(m) for m in measures])


def fill_months(df: DataFrame, month, measures: Sequence[str], keys=None, fill=0) -> DataFrame:
    """Insert every missing month (between the min and max present)
    with zero measures; per key when ``keys`` is given (per-key calendar)."""
    keys = _keys(keys)
    if keys:
        bounds = df.groupBy(*keys).agg(F.min(col(month)).alias("_lo"), F.max(col(month)).alias("_hi"))
        spine = bounds.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 month"))).alias(month))
    else:
        lo, hi = df.select(F.min(col(month))).scalar(), df.select(F.max(col(month))).scalar()
        spine = df.sparkSession.range(1).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 month"))).alias(month))
    return spine.join(df, [*keys, month], "left").na.fill(fill, subset=list(measures))


def new_and_cumulative(df: DataFrame, date, keys=None, new: str = "new", cum: str = "cumulative") -> DataFrame:
    """Count of new items per month (gap-filled) and the running total."""
    keys = _keys(keys)
    m = df.withColumn("_m", F.trunc(col(date), "MM")).groupBy(*keys, "_m").agg(F.count(F.lit(1)).cast("long").alias(new))
    filled = fill_months(m, "_m", [new], keys=keys)
    w = Window.partitionBy(*keys).orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    return filled.withColumn(cum, F.sum(new).over(w).cast("long")).withColumnRenamed("_m", "Month")
