"""Projection and column-set operators.

Header operators (P5-P8) only touch the schema: they are metadata changes
that Catalyst folds into the scan's projection.
"""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from strata.functions.columns import col, normalise_header


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P2."""
    return df.withColumnsRenamed(dict(mapping))


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop by list (missing names are ignored, like ``errors='ignore'``)."""
    return df.drop(*cols)


def with_literal(df: DataFrame, name: str, value, position: int | None = None) -> DataFrame:
    """Insert a constant column, optionally at an ordinal position."""
    out = df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    if position is None:
        return out
    cols = [x for x in df.columns if x != name]
    cols.insert(position, name)
    return out.select(*cols)


def normalise_headers(df: DataFrame, rules: Sequence[str] = ("strip",)) -> DataFrame:
    """P5: apply header text rules to every column name."""
    return df.toDF(*[normalise_header(c, rules) for c in df.columns])


def drop_matching(df: DataFrame, pattern: str = r"^unnamed|deprecated") -> DataFrame:
    """Drop columns whose name matches a case-insensitive regex."""
    rx = re.compile(pattern, re.IGNORECASE)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not rx.search(c)])


def canonicalise(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rename a column to ``name`` when its upper-cased header contains
    ``keyword``; the first matching rule wins per column."""
    out = []
    for c in df.columns:
        new = c
        for kw, name in rules:
            if kw.upper() in c.upper():
                new = name
                break
        out.append(new)
    return df.toDF(*out)


def rename_at(df: DataFrame, positions: Mapping[int, str]) -> DataFrame:
    """Rename by ordinal."""
    names = list(df.columns)
    for i, n in positions.items():
        names[i] = n
    return df.toDF(*names)


def round_all(df: DataFrame, dp: int = 0) -> DataFrame:
    """Half-even rounding of every floating column."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            out.append(F.bround(F.col(f"`{f.name}`"), dp).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def with_row_id(df: DataFrame, order: Sequence, name: str = "Unique_ID", start: int = 0) -> DataFrame:
    """Dense surrogate key 0..n-1 following a total ``order``.

    Numbered inside range buckets, plus the rows of the buckets before: lazy, without a checkpoint, and never a
    single-partition window over the table. ``order`` must be a total order (add a unique tiebreak column).
    """
    from strata.operators.ordered import numbered

    return numbered(df, order, name, start)
