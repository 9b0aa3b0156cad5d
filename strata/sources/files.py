"""Readers and sinks for dated data drops.

Layout convention: a feed root holds one sub-folder per drop,
``<root>/snapshot_date=YYYY-MM-DD/``. Spark discovers ``snapshot_date`` as
a partition column. The dates come from the folder names and the commit log (one entry per drop,
no row is read), and only the folders of the drops that are asked for are scanned.
"""
from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from strata.sources import commits

SNAP = "snapshot_date"


# ---------------------------------------------------------------- snapshots
def _folder(d: dt.date) -> str:
    return f"{SNAP}={d.isoformat()}"


def _dates(names) -> list[dt.date]:
    return sorted(dt.date.fromisoformat(n.removeprefix(f"{SNAP}=")) for n in names if re.fullmatch(SNAP + r"=\d{4}-\d{2}-\d{2}", n))


def snapshot_dates(spark: SparkSession, root: str) -> list[dt.date]:
    """The drop dates, oldest first. Under a root with a commit log only drops that are committed and whole; else
    those of all folders."""
    log = commits.committed(spark, root)
    if log is None:
        return _dates(n for n, size in commits.entries(spark, root).items() if size < 0)
    return [d for d in _dates(log) if commits.is_whole(spark, root, _folder(d), log[_folder(d)])]


def latest_date(spark: SparkSession, root: str) -> dt.date | None:
    """The newest of ``snapshot_dates``; of a commit log only the newest drops are looked at, until one is whole."""
    log = commits.committed(spark, root)
    if log is None:
        return (snapshot_dates(spark, root) or [None])[-1]
    return next((d for d in reversed(_dates(log)) if commits.is_whole(spark, root, _folder(d), log[_folder(d)])), None)


def _read_drops(spark: SparkSession, root: str, dates: Sequence[dt.date], fmt: str, schema: StructType | None, options: Mapping[str, str] | None) -> DataFrame:
    r = spark.read.format(fmt).options(**(options or {})).option("basePath", root)
    if schema is not None:
        r = r.schema(schema)
    return r.load([f"{root.rstrip('/')}/{_folder(d)}" for d in dates]) if dates else r.load(root).filter(F.lit(False))


def read_snapshots(spark: SparkSession, root: str, fmt: str = "parquet", schema: StructType | None = None,
                   options: Mapping[str, str] | None = None) -> DataFrame:
    """All drops that ``snapshot_dates`` lists."""
    return _read_drops(spark, root, snapshot_dates(spark, root), fmt, schema, options)


def read_latest(spark: SparkSession, root: str, fmt: str = "parquet", schema: StructType | None = None,
                options: Mapping[str, str] | None = None) -> DataFrame:
    """The newest drop only."""
    newest = latest_date(spark, root)
    return _read_drops(spark, root, [] if newest is None else [newest], fmt, schema, options)


def list_snapshots(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Every drop date, newest first."""
    dates = [(d,) for d in snapshot_dates(spark, root)]
    return spark.createDataFrame(dates, f"{SNAP} date").orderBy(F.col(SNAP).desc())


def read_month_end_snapshots(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """S3: the last drop of every calendar month, all its rows, with the drop date as a column."""
    last = {(d.year, d.month): d for d in snapshot_dates(spark, root)}
    return _read_drops(spark, root, list(last.values()), fmt, None, None)


def write_snapshot(df: DataFrame, root: str, run_date: str | Column | None = None, fmt: str = "parquet") -> None:
    """Write under ``snapshot_date=<run_date>`` (or the frame's own ``snapshot_date`` column), replacing only the
    drops written. The rows are written aside, the drops put in place, and all of them committed in one entry of the
    commit log; whatever fails before leaves readers with committed drops only."""
    spark, root = df.sparkSession, root.rstrip("/")
    out = df if run_date is None else df.withColumn(SNAP, run_date if isinstance(run_date, Column) else F.lit(run_date).cast("date"))
    if run_date is None:
        out = out.repartition(SNAP)  # a drop's rows in few files, not one from every task
    aside = f"{root}/_aside-{uuid.uuid4().hex}"
    out.write.format(fmt).partitionBy(SNAP).save(aside)
    folders = [_folder(d) for d in _dates(commits.entries(spark, aside))]
    for f in folders:
        commits.replace(spark, f"{aside}/{f}", f"{root}/{f}")
    if folders:
        commits.commit(spark, root, folders)


def with_snapshot_date(df: DataFrame, source: str = "path", pattern: str = r"(\d{4}-\d{2}-\d{2})", fmt: str = "yyyy-MM-dd",
                       text_col: str | None = None, fix_future: bool = False, today: str | None = None, name: str = SNAP) -> DataFrame:
    """Stamp a drop date taken from the file path, or from a text column.

    ``fix_future`` moves a date after ``today`` back one year (a month name
    without a year read as the current year)."""
    src = F.input_file_name() if source == "path" else F.col(text_col)
    d = F.try_to_date(F.regexp_extract(src, pattern, 1), fmt)
    if fix_future:
        d = F.when(d > F.lit(today).cast("date"), F.add_months(d, -12)).otherwise(d)
    return df.withColumn(name, d)


# ---------------------------------------------------------------- files
def read_matching(spark: SparkSession, root: str, glob: str, fmt: str = "csv", schema: StructType | None = None,
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """Every drop under ``root`` whose name matches ``glob`` (a Hadoop
    path glob on the entries of ``root``; files inside matching folders are read)."""
    r = spark.read.format(fmt).option("recursiveFileLookup", "true").options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    return r.load(f"{root.rstrip('/')}/{glob}")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, encoding: str = "UTF-8",
             columns: Sequence[str] | None = None, header: bool = True) -> DataFrame:
    """CSV with header, explicit schema (never inferred at scale), encoding
    and a column subset (pruned before parsing)."""
    r = spark.read.option("header", header).option("encoding", encoding).option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    return df.select(*columns) if columns else df


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet with column projection (footer-level pruning)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_folder_union(spark: SparkSession, folder: str, fmt: str = "csv", schema: StructType | None = None,
                      options: Mapping[str, str] | None = None) -> DataFrame:
    """All files of a folder appended (one scan, not a Python loop)."""
    r = spark.read.format(fmt).options(**{"header": "true", **(options or {})})
    if schema is not None:
        r = r.schema(schema)
    return r.load(folder)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV sink (one folder of part files)."""
    df.write.mode("overwrite").option("header", header).csv(path)


# ---------------------------------------------------------------- nested JSON and pages
def flatten_json(df: DataFrame, c: str, schema: StructType | ArrayType | str, array_path: str | None = None,
                 fields: Mapping[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Parse a JSON text column with an explicit schema, explode an
    array of records (``array_path``), and lift nested fields
    (``{output: 'dotted.path'}``) to columns."""
    parsed = df.select(*keep, F.from_json(F.col(c), schema).alias("_j"))
    base = "_j"
    if array_path:
        parsed = parsed.select(*keep, F.explode(F.col(f"_j.{array_path}") if array_path != "." else F.col("_j")).alias("_r"))
        base = "_r"
    return parsed.select(*keep, *[F.col(f"{base}.{p}").alias(o) for o, p in (fields or {}).items()])


def page_numbers(html: Column, strip: str = ",%()") -> Column:
    """Integers of a page's visible text in order of appearance, after
    removing thousands separators and ``% ( )``."""
    text = F.regexp_replace(html, r"<[^>]*>", " ")
    text = F.translate(text, strip, "")
    toks = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    return F.filter(toks, lambda t: t.rlike(r"^[0-9]+$"))


def extract_page_numbers(pages: DataFrame, html: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Map the i-th integer of each page to the i-th measure name."""
    nums = page_numbers(F.col(html))
    return pages.select(*keep, *[F.try_element_at(nums, F.lit(i + 1)).try_cast("long").alias(n) for i, n in enumerate(names)])


def page_as_of(pages: DataFrame, html: str, phrase: str = "current as of", keep: Sequence[str] = (), name: str = "As_Of") -> DataFrame:
    """The date that follows ``phrase`` in a page's visible text (``5 January
    2024``, ``05/01/2024`` or ``2024-01-05``), null if there is none."""
    text = F.regexp_replace(F.col(html), r"<[^>]*>", " ")
    found = F.regexp_extract(text, rf"(?i){re.escape(phrase)}\s+(\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}/\d{{1,2}}/\d{{4}}|\d{{1,2}} [A-Za-z]+ \d{{4}})", 1)
    day = F.coalesce(F.try_to_date(found, "yyyy-MM-dd"), F.try_to_date(found, "d/M/yyyy"), F.try_to_date(found, "d MMMM yyyy"))
    return pages.select(*keep, day.alias(name))


def page_links(pages: DataFrame, html: str, substring: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every ``href`` of a page containing ``substring`` (one row each)."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]*)"'), 1)
    return pages.select(*keep, F.explode(F.filter(hrefs, lambda h: h.contains(substring))).alias("href"))


def paged_union(pages: Sequence[DataFrame]) -> DataFrame:
    """Fetched pages of one result set appended into one table."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


# ---------------------------------------------------------------- tables
def read_table(spark: SparkSession, name: str, jdbc: Mapping[str, str] | None = None, query: str | None = None) -> DataFrame:
    """A catalog table, or a JDBC table/query when connection options are
    given (``partitionColumn``/``numPartitions`` options parallelise it)."""
    if jdbc is None:
        return spark.table(name)
    r = spark.read.format("jdbc").options(**jdbc)
    return r.option("query", query).load() if query else r.option("dbtable", name).load()


def write_table(df: DataFrame, name: str, mode: str = "overwrite", jdbc: Mapping[str, str] | None = None,
                path: str | None = None) -> None:
    """Write a DataFrame to a catalog table (or JDBC with options).

    ``path`` makes the catalog table external, stored in that (shared) folder."""
    if jdbc is not None:
        df.write.mode(mode).format("jdbc").options(**jdbc).option("dbtable", name).save()
        return
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Session temp views for SQL builders."""
    for n, d in views.items():
        d.createOrReplaceTempView(n)


def ctas(spark: SparkSession, name: str, sql: str, path: str) -> DataFrame:
    """``CREATE TABLE name AS sql``, stored in the (shared) folder ``path``, and return it."""
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}' AS {sql}")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget the table (an external table's files stay)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bundle(path: str, tables: Mapping[str, DataFrame], fmt: str = "parquet") -> None:
    """Several named result tables delivered together, one sub-folder each; committed once all are written."""
    for n in tables:
        if not re.fullmatch(r"[A-Za-z0-9_]+", n):
            raise ValueError(f"bad table name {n!r}")
    for n, d in tables.items():
        d.write.mode("overwrite").format(fmt).save(f"{path}/table={n}")
    if tables:
        commits.commit(next(iter(tables.values())).sparkSession, path, [f"table={n}" for n in tables])


def read_bundle(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The delivered tables back as one frame keyed by ``table`` (columns of the different tables are merged by
    name). A bundle that isn't committed, or of which a file is missing, is refused."""
    log = commits.committed(spark, path) or {}
    if not log or not all(commits.is_whole(spark, path, f, size) for f, size in log.items()):
        raise FileNotFoundError(f"no whole bundle at {path}")
    return spark.read.format(fmt).option("mergeSchema", "true").option("basePath", path).load([f"{path}/{f}" for f in sorted(log)])


def json_string_schema(fields: Sequence[str]) -> StructType:
    """A flat all-string schema for JSON records."""
    return StructType([StructField(f, StringType()) for f in fields])
