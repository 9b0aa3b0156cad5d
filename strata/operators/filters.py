"""Row filters (F1-F17). Plain predicates are left to Catalyst, which pushes
them into the Parquet scan; helpers here encode the pandas null semantics and
the clock- and data-dependent cut-offs explicitly."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import col


def keep(df: DataFrame, cond: Column) -> DataFrame:
    """F1/F16: conjunction/disjunction of predicates."""
    return df.filter(cond)


def isin(df: DataFrame, c, values: Sequence, negate: bool = False) -> DataFrame:
    """membership; the negated form keeps nulls like pandas ``~isin``."""
    m = col(c).isin(list(values))
    return df.filter(~F.coalesce(m, F.lit(False)) if negate else m)


def contains(df: DataFrame, c, pattern: str, negate: bool = False) -> DataFrame:
    """regex search; the negated form drops nulls (pandas ``== False``).

    A literal pattern becomes a substring test, which Parquet can push down
    (``StringContains``) and which avoids the regex engine per row."""
    m = col(c).contains(pattern) if re.fullmatch(r"[\w \-]+", pattern) else col(c).rlike(pattern)
    return df.filter(~m if negate else m)


def on_or_after(df: DataFrame, c, cutoff: str) -> DataFrame:
    """lower date bound (pushed down to Parquet)."""
    return df.filter(col(c) >= F.lit(cutoff).cast("date"))


def bucketed_status(df: DataFrame, period, status, buckets: Sequence[tuple[str | None, str | None, Sequence[str]]]) -> DataFrame:
    """each period bucket ``(lo, hi, allowed)`` (inclusive, lexicographic
    ``yyyy-MM``) keeps its own status set; one pass instead of split+union."""
    cond = None
    for lo, hi, allowed in buckets:
        inb = F.lit(True)
        if lo is not None:
            inb = inb & (col(period) >= lo)
        if hi is not None:
            inb = inb & (col(period) <= hi)
        c = inb & col(status).isin(list(allowed))
        cond = c if cond is None else cond | c
    return df.filter(cond)


def nulls(df: DataFrame, c, keep_null: bool = True) -> DataFrame:
    """F6."""
    return df.filter(col(c).isNull() if keep_null else col(c).isNotNull())


def not_gt_keep_null(df: DataFrame, c, threshold) -> DataFrame:
    """``~(x > t)`` with pandas semantics (null rows are kept)."""
    return df.filter(~F.coalesce(col(c) > threshold, F.lit(False)))


def latest_rows(df: DataFrame, c) -> DataFrame:
    """F8: rows whose ``c`` equals the global maximum (scalar subquery)."""
    return df.filter(col(c) == df.select(F.max(col(c))).scalar())


def latest_per_month(df: DataFrame, date, period: str = "year_month") -> DataFrame:
    """rows on the last date present in their month.

    ``period='month_of_year'`` reproduces grouping by calendar month only.
    The per-month maxima (one per month) are semi-joined back; the set is
    bounded by the calendar, so AQE broadcasts it.
    """
    key = F.trunc(col(date), "MM") if period == "year_month" else F.month(col(date))
    maxima = df.groupBy(key.alias("_m")).agg(F.max(col(date)).alias("_d")).select("_d")
    return df.join(maxima, col(date) == F.col("_d"), "left_semi")


def active_as_of(df: DataFrame, as_of, open_col: str | None = "Open_Date", close_col: str = "Close_Date") -> DataFrame:
    """``(close is null or close > d) and open < d``."""
    d = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    cond = col(close_col).isNull() | (col(close_col) > d)
    if open_col is not None:
        cond = cond & (col(open_col) < d)
    return df.filter(cond)


def drop_incomplete(df: DataFrame, period, run_date: str | None = None, mode: str = "run_month") -> DataFrame:
    """drop the trailing, incomplete period.

    ``run_month``: drop periods (``yyyy-MM`` text or dates) in the run month or later.
    ``max``: drop the latest period present.
    """
    if mode == "max":
        return df.filter(col(period) < df.select(F.max(col(period))).scalar())
    cur = F.date_format(F.lit(run_date).cast("date"), "yyyy-MM")
    p = col(period)
    if df.schema[period].dataType.typeName() != "string":
        p = F.date_format(p, "yyyy-MM")
    return df.filter(p < cur)


def cap_to_report_month(df: DataFrame, c, run_date: str) -> DataFrame:
    """keep dates up to the last day of the month before ``run_date``."""
    cap = F.last_day(F.add_months(F.lit(run_date).cast("date"), -1))
    return df.filter(col(c) <= cap)


def parse_age(c) -> Column:
    """F13 helper: ``'90+'`` -> 90, ``'ALL'`` -> null."""
    return F.regexp_replace(col(c), r"\+$", "").try_cast("int")


def adult_population(df: DataFrame, age, min_age: int, inclusive: bool = False) -> DataFrame:
    """top-coded age parse, then an age threshold (``ALL`` rows drop out)."""
    a = parse_age(age)
    return df.filter(a >= min_age if inclusive else a > min_age)


def dropna(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """F14."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def drop_totals(df: DataFrame, c, tokens: Sequence[str] = ("Grand Total",), nan_text: bool = True) -> DataFrame:
    """drop total rows and rows whose value is the text ``'nan'``."""
    cond = F.lit(False)
    for t in tokens:
        cond = cond | F.coalesce(F.contains(col(c), F.lit(t)), F.lit(False))
    if nan_text:
        cond = cond | F.coalesce(col(c) == "nan", F.lit(False))
    return df.filter(~cond)


def split_by_zero(df: DataFrame, c) -> tuple[DataFrame, DataFrame]:
    """(rows with measure = 0, rows with measure > 0)."""
    return df.filter(col(c) == 0), df.filter(col(c) > 0)
