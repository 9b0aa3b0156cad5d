"""Data-quality suites with drift thresholds and run logs.

A suite is a list of :class:`Check`. All aggregate observations of a suite
compile into ONE ``df.agg(...)`` pass; checks that need their own plan
(ordering, calendars, log look-ups) contribute scalar subqueries. The
result is a small DataFrame ``(check, column, observed, min_value,
max_value, success, hard)``; nothing is collected unless
:func:`raise_on_failure` is called.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SCHEMAS = {
    "pre_load_log": "row_count BIGINT, load_date TIMESTAMP, file_to_load STRING",
    "pre_load_agg_log": "load_date TIMESTAMP, file_name STRING, aggregation STRING, aggregate_value BIGINT, comment STRING",
    "post_load_log": "load_date TIMESTAMP, tbl_name STRING, aggregation STRING, aggregate_value BIGINT",
}


@dataclass
class Check:
    """One expectation. ``observed`` is an aggregate Column over the suite's
    frame (computed in the shared pass) or, with ``scalar=True``, a scalar
    Column evaluated on its own. Bounds may be numbers or scalar Columns."""

    name: str
    observed: Column
    min: float | Column | None = None
    max: float | Column | None = None
    column: str | None = None
    hard: bool = True
    scalar: bool = False
    pass_if_no_bounds: bool = True
    extra: dict = field(default_factory=dict)

    # ---- constructors
    @staticmethod
    def not_null(c: str) -> Check:
        blank = F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
        return Check("not_null", F.count_if(blank.isNull()), 0, 0, c)

    @staticmethod
    def unique(c: str) -> Check:
        return Check("unique", F.count(F.col(c)) - F.count_distinct(F.col(c)), 0, 0, c)

    @staticmethod
    def in_set(c: str, values: Sequence) -> Check:
        return Check("in_set", F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values))), 0, 0, c)

    @staticmethod
    def castable(c: str, to: str) -> Check:
        return Check(f"type_{to}", F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(to).isNull()), 0, 0, c)

    @staticmethod
    def type_is(df: DataFrame, c: str, expected: str) -> Check:
        ok = 1.0 if df.schema[c].dataType.simpleString() == expected else 0.0
        return Check(f"type_is_{expected}", _with_rows(ok), 1, 1, c)

    @staticmethod
    def columns(df: DataFrame, expected: Sequence[str]) -> Check:
        ok = 1.0 if set(df.columns) == set(expected) else 0.0
        return Check("columns", _with_rows(ok), 1, 1, None)

    @staticmethod
    def row_count(lo=None, hi=None) -> Check:
        return Check("row_count", F.count(F.lit(1)), lo, hi)

    @staticmethod
    def sum_between(c: str, lo=None, hi=None) -> Check:
        return Check("sum_between", F.sum(F.col(c)), lo, hi, c)

    @staticmethod
    def distinct_between(c: str, lo=None, hi=None, hard: bool = True) -> Check:
        return Check("distinct_between", F.count_distinct(F.col(c)), lo, hi, c, hard=hard)

    @staticmethod
    def between(c: str, lo, hi) -> Check:
        return Check("values_between", F.count_if((F.col(c) < lo) | (F.col(c) > hi)), 0, 0, c, extra={"lo": lo, "hi": hi})

    @staticmethod
    def increasing(df: DataFrame, c: str, order: Sequence[str], strict: bool = False) -> Check:
        """V9: values of ``c`` never go down along ``order`` — compared inside range buckets, and at their borders."""
        from strata.operators.ordered import order_violations

        viol = order_violations(df, c, order, strict).scalar()
        return Check("increasing", viol, 0, 0, c, scalar=True)

    @staticmethod
    def no_zero_days(df: DataFrame, date: str, measure: str, ignore: Sequence[str] = ()) -> Check:
        """Resampled daily totals never 0 (ignored days excepted)."""
        from strata.operators.timeseries import resample

        days = resample(df, date, [measure], "D", name="_d")
        if ignore:
            days = days.filter(~F.col("_d").isin([F.lit(d).cast("date") for d in ignore]))
        zero = days.select(F.count_if(F.col(measure) == 0)).scalar()
        return Check("no_zero_days", zero, 0, 0, measure, scalar=True)

    @staticmethod
    def calendar(df: DataFrame, date: str, expected: int | None = None) -> Check:
        """Distinct dates equal the days of the (latest) month, or ``expected``."""
        obs = F.count_distinct(F.to_date(F.col(date)))
        exp = F.lit(expected) if expected is not None else df.select(F.dayofmonth(F.last_day(F.max(date)))).scalar()
        return Check("calendar", obs, exp, exp, date)

    @staticmethod
    def baseline(base: float, pct: float, observed: Column | None = None) -> Check:
        """A fixed baseline +- pct %."""
        lo, hi = threshold(base, pct)
        return Check("baseline", observed if observed is not None else F.count(F.lit(1)), lo, hi)


def threshold(prev, pct: float) -> tuple[Column, Column]:
    """``tol = round_half_even(pct% * prev)``, band ``[prev - tol, prev + tol]``."""
    p = prev if isinstance(prev, Column) else F.lit(prev)
    tol = F.bround(p * F.lit(pct / 100.0), 0)
    return p - tol, p + tol


def last_log(log: DataFrame, file_col: str, file_substring: str, filters: Mapping[str, str] | None = None,
             date_col: str = "load_date") -> DataFrame:
    """The newest log rows whose file name contains ``file_substring``
    (and whose other columns equal ``filters``)."""
    x = log.filter(F.col(file_col).contains(file_substring))
    for k, v in (filters or {}).items():
        x = x.filter(F.col(k) == v)
    return x.filter(F.col(date_col) == x.select(F.max(date_col)).scalar())


def drift(observed: Column, prev: Column, pct: float, name: str = "drift", column: str | None = None,
          hard: bool = True, scalar: bool = False) -> Check:
    """Observed value within ``pct``% of the previous run; a first
    run (no previous value) passes."""
    lo, hi = threshold(prev, pct)
    return Check(name, observed, lo, hi, column, hard=hard, scalar=scalar)


def not_decreasing(observed: Column, prev: Column, column: str | None = None, scalar: bool = False) -> Check:
    """Today >= previous (first run passes)."""
    return Check("not_decreasing", observed, prev, None, column, scalar=scalar)


def _with_rows(ok: float) -> Column:
    """A finding about the schema, evaluated with the table's rows: a table that can't be read fails."""
    return F.when(F.count(F.lit(1)) >= 0, F.lit(ok))


def last_two(per: DataFrame, period: str) -> DataFrame:
    """The newest two rows of a period-grain frame as one row: ``now_<c>`` and
    ``prev_<c>`` (null where there is no previous period). One scan for both sides."""
    values = [c for c in per.columns if c != period]
    two = per.orderBy(F.col(period).desc()).limit(2).agg(
        F.sort_array(F.collect_list(F.struct(period, *values)), asc=False).alias("_two"))
    at = lambda i, c: F.try_element_at("_two", F.lit(i))[c]
    return two.select(*[at(1, c).alias(f"now_{c}") for c in values], *[at(2, c).alias(f"prev_{c}") for c in values])


def run_suite(df: DataFrame, checks: Sequence[Check], one_row: bool = False) -> DataFrame:
    """Evaluate checks: aggregates in one pass, then one row per check.
    ``one_row``: ``df`` is one row already, and values and bounds are its columns."""
    aggs = [(i, c) for i, c in enumerate(checks) if not c.scalar and not one_row]
    base = df if one_row else df.agg(*[c.observed.cast("double").alias(f"_o{i}") for i, c in aggs]) if aggs else df.sparkSession.range(1).drop("id")
    rows = []
    for i, c in enumerate(checks):
        obs = c.observed.cast("double") if c.scalar or one_row else F.col(f"_o{i}")
        lo = c.min if isinstance(c.min, Column) else F.lit(c.min)
        hi = c.max if isinstance(c.max, Column) else F.lit(c.max)
        lo, hi = lo.cast("double"), hi.cast("double")
        ok = F.coalesce(obs >= lo, F.lit(True)) & F.coalesce(obs <= hi, F.lit(True))
        if c.scalar is False and c.min is None and c.max is None and not c.pass_if_no_bounds:
            ok = F.lit(False)
        rows.append(F.struct(F.lit(c.name).alias("check"), F.lit(c.column).cast("string").alias("column"),
                             obs.alias("observed"), lo.alias("min_value"), hi.alias("max_value"),
                             (ok & obs.isNotNull() | (lo.isNull() & hi.isNull())).alias("success"), F.lit(c.hard).alias("hard")))
    return base.select(F.inline(F.array(*rows)))


def report(results: DataFrame) -> DataFrame:
    """PASS / FAILED label per check."""
    return results.withColumn("outcome", F.when(F.col("success"), "PASS").otherwise(F.when(F.col("hard"), "FAILED").otherwise("WARN")))


def raise_on_failure(results: DataFrame) -> None:
    """Abort the run when a hard check failed (one tiny action)."""
    bad = results.filter(~F.col("success") & F.col("hard")).select("check", "column").collect()
    if bad:
        raise AssertionError(f"validation failed: {[(r['check'], r['column']) for r in bad]}")


def arrival(df: DataFrame) -> Column:
    """Scalar boolean — did any input arrive? (stops at the first row)."""
    return df.limit(1).select(F.count(F.lit(1)) > 0).scalar()


# ---------------------------------------------------------------- run logs
def preload_log(df: DataFrame, load_date: str | Column) -> DataFrame:
    """Pre-load row count per input file."""
    d = load_date if isinstance(load_date, Column) else F.lit(load_date).cast("timestamp")
    return df.groupBy(F.input_file_name().alias("file_to_load")).agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        "row_count", d.alias("load_date"), "file_to_load")


def agg_log(df: DataFrame, file_name: str, aggs: Mapping[tuple[str, str], Column], load_date: str | Column) -> DataFrame:
    """Several aggregates of one file in one pass, one log row each."""
    d = load_date if isinstance(load_date, Column) else F.lit(load_date).cast("timestamp")
    items = list(aggs.items())
    wide = df.agg(*[c.cast("long").alias(f"_a{i}") for i, (_, c) in enumerate(items)])
    rows = [F.struct(F.lit(a).alias("aggregation"), F.col(f"_a{i}").alias("aggregate_value"), F.lit(cm).alias("comment"))
            for i, ((a, cm), _) in enumerate(items)]
    return wide.select(F.inline(F.array(*rows))).select(d.alias("load_date"), F.lit(file_name).alias("file_name"),
                                                        "aggregation", "aggregate_value", "comment")


def postload_log(tables: Mapping[str, DataFrame], load_date: str | Column) -> DataFrame:
    """Post-load row count of every sink table."""
    from functools import reduce

    d = load_date if isinstance(load_date, Column) else F.lit(load_date).cast("timestamp")
    parts = [t.agg(F.count(F.lit(1)).cast("long").alias("aggregate_value")).select(
        d.alias("load_date"), F.lit(n).alias("tbl_name"), F.lit("count").alias("aggregation"), "aggregate_value")
        for n, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def append_log(log: DataFrame, path: str) -> None:
    """Append run-log rows to their (shared) log table folder."""
    log.write.mode("append").parquet(path)
