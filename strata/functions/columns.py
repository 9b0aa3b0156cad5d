"""Column -> Column helpers (built-in expressions only, no Python UDFs).

Every helper accepts a column name or a ``Column`` and returns a ``Column``,
so they stay inside whole-stage code generation.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = "str | Column"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- numbers
def coerce(c, default: float | None = 0.0, to: str = "double") -> Column:
    """Numeric coercion; unparsable text -> null -> ``default``."""
    v = col(c).try_cast(to)
    return v if default is None else F.coalesce(v, F.lit(default).cast(to))


def percent(c) -> Column:
    """``'12.5%'`` -> 0.125 (malformed -> null)."""
    return F.try_divide(F.regexp_replace(col(c), "%", "").try_cast("double"), F.lit(100.0))


def yesno(c) -> Column:
    """Yes/No in any case -> 1/0, anything else -> null."""
    u = F.upper(F.trim(col(c)))
    return F.when(u == "YES", F.lit(1)).when(u == "NO", F.lit(0))


def value_map(c, mapping: Mapping, default=0) -> Column:
    """C4: value lookup with a default for unmapped values (and null)."""
    out = None
    for k, v in mapping.items():
        out = (F.when(col(c) == k, F.lit(v)) if out is None else out.when(col(c) == k, F.lit(v)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def flag(cond: Column) -> Column:
    """Boolean condition -> 1/0 (null condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def eq_flag(c, value) -> Column:
    return flag(col(c) == value)


def in_flag(c, values: Iterable) -> Column:
    return flag(col(c).isin(list(values)))


def not_in_flag(c, values: Iterable) -> Column:
    return flag(~F.coalesce(col(c).isin(list(values)), F.lit(False)))


def case(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """First matching branch wins."""
    out = None
    for cond, val in branches:
        v = val if isinstance(val, Column) else F.lit(val)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def ratio(num, den, dp: int | None = 4) -> Column:
    """num/den, division by zero -> null, half-even rounding."""
    r = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return F.bround(r, dp) if dp is not None else r


def rate(num, den, per: float = 1000.0, dp: int | None = None) -> Column:
    """Rate per ``per`` population: num / (den / per)."""
    r = F.try_divide(col(num).cast("double"), F.try_divide(col(den).cast("double"), F.lit(float(per))))
    return F.bround(r, dp) if dp is not None else r


def inf_to_zero(num, den) -> Column:
    """x/0 -> 0 (pandas inf cleaned); 0/0 and nulls stay null."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when((d == 0) & (n != 0), F.lit(0.0)).otherwise(F.try_divide(n, d))


def row_sum(cols: Sequence) -> Column:
    """P10: null-skipping row sum (all-null -> 0)."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


def add(cols: Sequence) -> Column:
    """Null-propagating row sum."""
    return reduce(lambda a, b: a + b, [col(c) for c in cols])


def residual(total, part) -> Column:
    """Total - part."""
    return col(total) - col(part)


def override(base, new) -> Column:
    """``new`` when present, else ``base``."""
    return F.coalesce(col(new), col(base))


def fill(c, value) -> Column:
    """Null -> constant."""
    return F.coalesce(col(c), value if isinstance(value, Column) else F.lit(value))


def null_if_negative(c) -> Column:
    """C20: negative sentinel -> null."""
    return F.when(col(c) >= 0, col(c))


def null_if_blank(c, tokens: Sequence[str] = ("", "null")) -> Column:
    """C20: blank / whitespace / 'null' text -> null."""
    t = F.trim(col(c))
    return F.when(~F.lower(t).isin(list(tokens)), col(c))


def round_half_even(c, dp: int = 0) -> Column:
    """Numpy-compatible (half-even) rounding."""
    return F.bround(col(c), dp)


def floor_fill(c) -> Column:
    """Floor, null -> 0."""
    return F.coalesce(F.floor(col(c)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- dates
def parse_date(c, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    """First format that parses wins; unparsable -> null."""
    return F.coalesce(*[F.try_to_date(col(c).cast("string"), f) for f in formats])


def parse_timestamp(c, formats: Sequence[str]) -> Column:
    return F.coalesce(*[F.try_to_timestamp(col(c).cast("string"), F.lit(f)) for f in formats])


def fmt_date(c, pattern: str = "yyyy-MM") -> Column:
    """Date -> text."""
    return F.date_format(col(c), pattern)


def yyyymmdd_int(c) -> Column:
    """Date -> 20240131 as a long."""
    return F.date_format(col(c), "yyyyMMdd").cast("long")


def month_year(c) -> Column:
    """Un-padded ``month-year`` label (e.g. ``3-2021``)."""
    return F.concat_ws("-", F.month(col(c)).cast("string"), F.year(col(c)).cast("string"))


def add_month(c, n: int = 1) -> Column:
    """Calendar month arithmetic (clamped to month end)."""
    return F.add_months(col(c), n)


AVG_MONTH_SECONDS = 2629746  # 30.436875 days: the average Gregorian month


def add_avg_month(c) -> Column:
    """The 'average month' offset of older pandas ``timedelta64(1, 'M')``."""
    # 30 days 10:29:06 == AVG_MONTH_SECONDS
    return col(c).cast("timestamp_ntz") + F.make_dt_interval(F.lit(30), F.lit(10), F.lit(29), F.lit(6))


def month_end(c) -> Column:
    """C11."""
    return F.last_day(col(c))


def days_in_month(c) -> Column:
    return F.dayofmonth(F.last_day(col(c)))


def month_start(c) -> Column:
    return F.trunc(col(c), "MM")


def fin_year(c) -> Column:
    """April-start financial year as ``YYYY/YYYY``."""
    y = F.year(col(c))
    start = F.when(F.month(col(c)) >= 4, y).otherwise(y - 1)
    return F.concat(start.cast("string"), F.lit("/"), (start + 1).cast("string"))


def fin_year_start(c) -> Column:
    y = F.year(col(c))
    return F.when(F.month(col(c)) >= 4, y).otherwise(y - 1)


def edition(year) -> Column:
    """``prev/cur`` edition string from a year."""
    y = col(year).cast("int")
    return F.concat((y - 1).cast("string"), F.lit("/"), y.cast("string"))


def short_edition(ed) -> Column:
    """``2020/2021`` -> ``20/21``."""
    return F.concat(F.substring(col(ed), 3, 2), F.lit("/"), F.substring(col(ed), 8, 2))


def week_ending_sunday(c) -> Column:
    """W13 label: the Sunday on or after the date."""
    return F.next_day(F.date_sub(col(c), 1), "SU")


def date_or_sentinel(c, fmt: str = "yyyy-MM-dd", sentinel: str = "1900-01-01") -> Column:
    """Valid date -> itself, else a sentinel date."""
    d = F.try_to_date(col(c).cast("string"), fmt)
    return F.coalesce(d, F.lit(sentinel).cast("date"))


# ---------------------------------------------------------------- strings
def norm_status(c, mapping: Mapping[str, str] | None = None) -> Column:
    """C14: upper-case, then exact re-labelling."""
    u = F.upper(F.trim(col(c)))
    if not mapping:
        return u
    out = None
    for k, v in mapping.items():
        out = F.when(u == k.upper(), F.lit(v)) if out is None else out.when(u == k.upper(), F.lit(v))
    return out.otherwise(u)


def prefix(c, n: int = 3) -> Column:
    """Leading ``n`` characters."""
    return F.substring(col(c), 1, n)


NBSP = " "


def strip_nbsp(c) -> Column:
    """Remove non-breaking spaces."""
    return F.translate(col(c), NBSP, "")


def regex_replace(c, pattern: str, repl: str) -> Column:
    """C17: Java-regex replace of every match."""
    return F.regexp_replace(col(c), pattern, repl)


def sentence_case(c) -> Column:
    """``camelCaseName`` -> ``Camel case name`` (str.capitalize semantics)."""
    spaced = F.regexp_replace(col(c), r"(\w)([A-Z])", "$1 $2")
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substring(spaced, 2, 1 << 30)))


def first_segment(c, sep: str = "/") -> Column:
    """Text before the first separator."""
    return F.substring_index(col(c), sep, 1)


def has_digit(c) -> Column:
    """C23."""
    return col(c).rlike(r"\d")


def year_token(c, year, sep: str = " ") -> Column:
    """The last whitespace token containing ``year``, ``_`` -> ``/``.

    Falls back to the first token when no token contains the year.
    """
    toks = F.split(col(c), sep)
    y = F.lit(str(year)) if isinstance(year, (int, str)) else year.cast("string")
    hits = F.filter(toks, lambda t: F.contains(t, y))
    pick = F.when(F.size(hits) > 0, F.element_at(hits, -1)).otherwise(F.element_at(toks, 1))
    return F.translate(pick, "_", "/")


def strip_leading(c, n: int = 3) -> Column:
    """Drop the first ``n`` characters."""
    return F.substring(col(c), n + 1, 1 << 30)


def normalise_header(name: str, rules: Sequence[str] = ("strip",)) -> str:
    """P5: header text normalisation (metadata only)."""
    out = name
    for r in rules:
        if r == "strip":
            out = out.strip()
        elif r == "rstrip":
            out = out.rstrip()
        elif r == "lower":
            out = out.lower()
        elif r == "upper":
            out = out.upper()
        elif r == "dash_to_underscore":
            out = out.replace("-", "_")
        elif r == "space_to_underscore":
            out = out.replace(" ", "_")
        elif r == "nbsp":
            out = out.replace(NBSP, "")
    return out
