"""Registered queries: name -> Spark callable, plus the independent SQL oracle."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans.standins import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def deliver(df: DataFrame) -> DataFrame:
    """Sink contract of the registered queries: dates and timestamps are
    delivered as ISO text (as in the reference's CSV outputs)."""
    out = []
    changed = False
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("date", "timestamp", "timestamp_ntz"):
            out.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
            changed = True
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out) if changed else df


def query(name: str, oracle: str | None = None, dates: tuple[str, ...] | list[str] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL over the driver tables; stand-in views it names
    are inlined as CTEs. ``dates`` lists the oracle's date/timestamp output
    columns, rendered as text like the Spark side's :func:`deliver`.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return deliver(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            sql = with_views(oracle)
            if dates:
                rep = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
                sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"
            ORACLE[name] = sql
        return fn

    return deco


def load_catalog() -> None:
    import importlib
    import pkgutil

    import strata.plans.catalog as cat

    for m in sorted(pkgutil.iter_modules(cat.__path__), key=lambda m: m.name):
        importlib.import_module(f"strata.plans.catalog.{m.name}")
