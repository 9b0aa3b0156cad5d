"""Joins (J1-J17).

Strategy is left to Catalyst + AQE: a side is broadcast only when its size is
known to be under ``spark.sql.autoBroadcastJoinThreshold`` (static estimate)
or measured under the adaptive threshold at runtime; otherwise the join
shuffles and AQE splits skewed partitions. Explicit ``broadcast()`` is used
only for frames whose row count is bounded by construction (one row per
partition, a calendar, a scalar). Scalars attach as scalar subqueries, never
through a cross join.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col
from strata.operators.ordered import zipped
from strata.operators.projection import with_row_id


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def join_on(a: DataFrame, b: DataFrame, left_on, right_on=None, how: str = "left", null_safe: bool = False) -> DataFrame:
    """Equi-join on one or several keys that may be named differently.

    Same-named keys use USING semantics (one key column, coalesced for a
    full join). ``null_safe`` matches null keys with each other like pandas.
    """
    lk = _keys(left_on)
    rk = _keys(right_on) if right_on is not None else lk
    if lk == rk and all(isinstance(k, str) for k in lk) and not null_safe:
        return a.join(b, lk, how)
    conds = [(a[l].eqNullSafe(b[r]) if null_safe else a[l] == b[r]) for l, r in zip(lk, rk)]
    out = a.join(b, reduce(lambda x, y: x & y, conds), how)
    if lk == rk:
        # collapse the duplicated key columns (coalesce for outer joins)
        keep = [F.coalesce(a[k], b[k]).alias(k) for k in lk]
        rest = [a[c] for c in a.columns if c not in lk] + [b[c] for c in b.columns if c not in rk]
        out = out.select(*keep, *rest)
    return out


def full_join(a: DataFrame, b: DataFrame, keys) -> DataFrame:
    """Full outer join with a single coalesced key column per key."""
    return a.join(b, _keys(keys), "full")


def outer_merge_all(dfs: Sequence[DataFrame], key) -> DataFrame:
    """N-way full outer merge of tables keyed by ``key`` (unique per input).

    One shuffle: union all inputs by name (missing columns null) and take the
    single non-null value per column and key — instead of n-1 chained joins.
    A key that an input holds twice would need several rows; it raises.
    """
    keys = _keys(key)
    tagged = [d.withColumn("_input", F.lit(i)) for i, d in enumerate(dfs)]
    u = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tagged)
    vals = [c for c in u.columns if c not in (*keys, "_input")]
    most = F.greatest(F.lit(0), *[F.count_if(F.col("_input") == i) for i in range(len(dfs))])
    out = u.groupBy(*keys).agg(most.alias("_most"), *[F.max(F.col(f"`{c}`")).alias(c) for c in vals])
    unique = F.when(F.col("_most") > 1, F.raise_error(F.lit("outer_merge_all: a key occurs twice in an input"))).otherwise(F.lit(True))
    return out.filter(unique).drop("_most")


def calendar(spark, start: Column, end: Column, step: str = "1 day", name: str = "Date") -> DataFrame:
    """Calendar scaffold: one row per period between two scalar bounds."""
    return spark.range(1).select(F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}"))).alias(name))


def scaffold(entities: DataFrame, start: Column, end: Column, step: str = "1 day", name: str = "Date") -> DataFrame:
    """Every entity x every period between the scalar bounds.

    The calendar is generated per entity row (``explode(sequence)``), so the
    scaffold is produced in parallel without a cross join or broadcast.
    """
    return entities.distinct().withColumn(name, F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}"))))


def scaffold_dates(entities: DataFrame, dates: DataFrame, name: str = "Date") -> DataFrame:
    """J6 over the dates that occur: every entity x every distinct date (a
    calendar-bounded set, one array), without a cross join."""
    known = dates.agg(F.array_sort(F.collect_set(F.col(name).cast("date")))).scalar()
    return entities.distinct().withColumn(name, F.explode(known))


def zip_join(a: DataFrame, b: DataFrame, order_a: Sequence, order_b: Sequence, how: str = "left") -> DataFrame:
    """Positional join — i-th row of ``a`` (by ``order_a``) with the i-th of ``b``, for frames of any size."""
    return zipped(a, b, order_a, order_b, how)


def widen(spine: DataFrame, feeds: Mapping[str, tuple[DataFrame, str]], keys, agg: str = "sum") -> DataFrame:
    """Left-join many same-grain feeds onto a spine in one shuffle.

    ``feeds`` maps an output column to ``(frame, value column)``. Every frame
    becomes rows with its own columns filled, in their own types (longs stay
    exact), and is read once however many columns it gives; one aggregation
    brings them together, and rows whose keys are absent from the spine are
    dropped by a presence marker.

    The keys travel as one struct. Frames already dealt by the keys (each
    aggregated by them, say) would otherwise be unioned partition by
    partition: one task would then hold the hash tables of all feeds.
    """
    keys = _keys(keys)
    key, marker = "__key", "__spine"
    frames = {id(spine): (spine, [F.lit(True).alias(marker)])}
    for name, (df, value) in feeds.items():
        frames.setdefault(id(df), (df, []))[1].append(F.col(value).alias(name))
    parts = [df.select(F.struct(*keys).alias(key), *cols) for df, cols in frames.values()]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    f = {"sum": F.sum, "max": F.max, "first": F.min}[agg]
    wide = rows.groupBy(key).agg(F.max(marker).alias(marker), *[f(n).alias(n) for n in feeds])
    return wide.filter(F.col(marker)).select(f"{key}.*", *feeds)


def join_month_offset(a: DataFrame, b: DataFrame, key: str, a_date, b_date, offset: int = 1, how: str = "left") -> DataFrame:
    """Month m of ``a`` joins month m+offset of ``b`` on (key, yyyy-MM)."""
    a2 = a.withColumn("_ym", F.date_format(F.add_months(col(a_date), offset), "yyyy-MM"))
    b2 = b.withColumn("_ym", F.date_format(col(b_date), "yyyy-MM"))
    return a2.join(b2, [key, "_ym"], how).drop("_ym")


def state_as_of(panel: DataFrame, events: DataFrame, entity: str, month: str, event_date: str, aggs: Mapping[str, tuple[Column, str]]) -> DataFrame:
    """Each (entity, month) of the panel sees every event dated on or
    before that month's end.

    Linear instead of a panel x events fan-out: events are pre-aggregated per
    (entity, month end), unioned with the panel rows and made cumulative by a
    per-entity running window whose length is bounded by the number of months.
    ``aggs`` maps output names to ``(per-event Column, 'max' | 'sum')``;
    months before the entity's first event get 0.
    """
    from pyspark.sql import Window

    comb = {"max": F.max, "sum": F.sum}
    ev = events.groupBy(F.col(entity), F.last_day(col(event_date)).alias("_me")).agg(
        *[comb[how](c).alias(n) for n, (c, how) in aggs.items()]
    ).withColumn("_panel", F.lit(1))
    p = panel.select(entity, month, F.last_day(col(month)).alias("_me"), F.lit(2).alias("_panel"))
    u = p.unionByName(ev, allowMissingColumns=True)
    w = Window.partitionBy(entity).orderBy("_me", "_panel").rowsBetween(Window.unboundedPreceding, 0)
    cum = u.select(
        entity, month, "_panel",
        *[F.coalesce(comb[how](n).over(w), F.lit(0)).alias(n) for n, (_, how) in aggs.items()],
    )
    return cum.filter(F.col("_panel") == 2).drop("_panel")


def state_sweep(events: DataFrame, entity: str, event_date: str, state: str, order: Sequence[str], none: str, month: str) -> DataFrame:
    """Entities in each state at the end of every month, from the first event's month to the last's.

    ``order`` lists the states from the strongest: an entity is in the strongest one that it has reported so far, and in
    ``none`` while it has reported none. Swept over the changes: an entity enters a state in the month in which it
    first reports it and leaves it for a stronger one, so the work follows the events and only the calendar's months
    are summed up, never entities x months. Events with another or a null state count for ``none`` only.
    """
    from pyspark.sql import Window

    at = F.trunc(col(event_date), "MM")
    first = events.groupBy(col(entity).alias("_e")).agg(F.min(at).alias("_any"), *(F.min(F.when(col(state) == s, at)).alias(s) for s in order))
    changes = []
    for i, s in enumerate(order):
        stronger = F.least(*(F.col(x) for x in order[:i]), F.lit(None).cast("date"), F.lit(None).cast("date")) if i else F.lit(None).cast("date")
        enters = F.col(s).isNotNull() & (stronger.isNull() | (F.col(s) < stronger))
        changes += [F.when(enters, F.struct(F.col(s).alias("m"), F.lit(s).alias("s"), F.lit(1).alias("d"))),
                    F.when(enters & stronger.isNotNull(), F.struct(stronger.alias("m"), F.lit(s).alias("s"), F.lit(-1).alias("d")))]
    swept = first.select(F.explode(F.filter(F.array(*changes), lambda c: c.isNotNull())).alias("c")).select("c.*")
    steps = swept.groupBy(F.col("m").alias(month)).agg(*(F.sum(F.when(F.col("s") == s, F.col("d")).otherwise(0)).alias(s) for s in order))
    span = events.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where("lo IS NOT NULL")
    months = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias(month))
    so_far = Window.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)  # one row per month of the calendar
    counted = months.join(steps, month, "left").select(month, *(F.sum(F.coalesce(F.col(s), F.lit(0))).over(so_far).alias(s) for s in order))
    everyone = first.select(F.count(F.lit(1)).alias("n")).scalar()
    return counted.withColumn(none, everyone - reduce(lambda a, b: a + b, (F.col(s) for s in order)))


def with_scalar(df: DataFrame, name: str, scalar_df: DataFrame) -> DataFrame:
    """Attach a one-row, one-column aggregate to every row."""
    return df.withColumn(name, scalar_df.scalar())


def num_den(df: DataFrame, keys, field: str, value: str, num_field: str, den_field: str, num: str = "Numerator", den: str = "Denominator") -> DataFrame:
    """numerator/denominator of a long (key, Field, Value) table in one
    pass of conditional aggregation (no self-join)."""
    keys = _keys(keys)
    return df.filter(F.col(field).isin(num_field, den_field)).groupBy(*keys).agg(
        F.sum(F.when(F.col(field) == num_field, col(value))).alias(num),
        F.sum(F.when(F.col(field) == den_field, col(value))).alias(den),
    )


def exists_in(df: DataFrame, other: DataFrame, keys, negate: bool = False) -> DataFrame:
    """Semi-join (``negate``: anti-join) on keys."""
    return df.join(other.select(*_keys(keys)), _keys(keys), "left_anti" if negate else "left_semi")


def scaffold_fill(facts: DataFrame, scaffold_df: DataFrame, keys, zero_cols: Sequence[str], max_fill: Mapping[str, str] | None = None) -> DataFrame:
    """Outer-join facts onto a scaffold, zero-fill measures, fill a date
    column with its global maximum (scalar subquery)."""
    out = facts.join(scaffold_df, _keys(keys), "full")
    out = out.na.fill(0, subset=list(zero_cols))
    for c, src in (max_fill or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), scaffold_df.select(F.max(src)).scalar()))
    return out


def coverage_by_group(members: DataFrame, groups: DataFrame, snap: str, group: str, name: str = "n", size: str | None = None) -> DataFrame:
    """Members counted per (snapshot, group); every group is listed for
    every snapshot, with 0 where it has no member. ``size``: a column of
    ``groups`` (how many members the group could have) to stand beside the count.

    The grid is built by exploding the (calendar-bounded) set of snapshot
    dates on each group row — no cross join; the counts are a partial
    aggregate joined onto the grid.
    """
    counts = members.groupBy(snap, group).agg(F.count(F.lit(1)).cast("long").alias(name))
    snaps = members.agg(F.array_sort(F.collect_set(col(snap)))).scalar()
    grid = groups.select(group, *([size] if size else [])).distinct().withColumn(snap, F.explode(snaps))
    return grid.join(counts, [snap, group], "left").na.fill(0, subset=[name])


def join_fiscal_year(facts: DataFrame, pop: DataFrame, key: str, fact_date: str, pop_date: str, how: str = "full") -> DataFrame:
    """Facts in [1 Apr y, 1 Apr y+1) meet the population extract of year y."""
    from strata.functions.columns import fin_year_start

    f = facts.withColumn("_fy", fin_year_start(col(fact_date)))
    p = pop.withColumn("_fy", fin_year_start(col(pop_date)))
    return f.join(p, [key, "_fy"], how).drop("_fy")


def map_hierarchy(df: DataFrame, hops: Sequence[tuple[DataFrame, str, str]], how: str = "left") -> DataFrame:
    """Successive left joins through mapping tables ``(dim, left_key, right_key)``."""
    out = df
    for dim, lk, rk in hops:
        out = join_on(out, dim, lk, rk, how=how)
        if lk != rk and rk in out.columns and lk in out.columns:
            out = out.drop(dim[rk])
    return out
