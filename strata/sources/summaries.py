"""A history in folders with a summary of every file, so that a merge reads only the files that may hold a key.

A summary row has a file's smallest and largest key and bitmaps of 32,768 bits of the key's hash (``buckets`` of them; a full one only
lets more files be read). Files are known by folder and name, which Spark never uses twice; a file without a summary, as a
broken write leaves it, is always read. Only file names come to the driver, as with any listing.
"""
from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import commits

SUMMARY = "_summary"
FOLDER = "folder"  # its values are text; all columns of the rows stay in the files, with their types
BITS = 32_768  # fixed value: the size of Spark's bitmaps


def _name(uri: str) -> str:
    return "/".join(uri.rsplit("/", 2)[1:])


def _read(spark: SparkSession, root: str, files: Sequence[str] = ()) -> DataFrame:
    return spark.read.option("basePath", root).parquet(*([unquote(f) for f in files] or [root]))


def _files(spark: SparkSession, root: str) -> list[str]:
    full = any(n.startswith(f"{FOLDER}=") for n in commits.entries(spark, root))
    return list(_read(spark, root).inputFiles()) if full else []


def _place(keys: Sequence[str], buckets: int) -> Column:
    """Place of a key's bit in all bitmaps, null if a part of the key is null (such a key equals none)."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, F.pmod(F.xxhash64(*keys), F.lit(BITS * buckets)))


def _summaries(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    place, key = _place(keys, buckets), F.struct(*keys)
    known = rows.select(F.substring_index("_metadata.file_path", "/", -2).alias("file"), place.alias("_place"),
                        F.when(place.isNotNull(), key).alias("_key"))
    return known.groupBy("file", F.floor(F.col("_place") / BITS).cast("int").alias("bucket")).agg(
        F.min("_key").alias("lo"), F.max("_key").alias("hi"),
        F.bitmap_construct_agg(F.pmod("_place", F.lit(BITS))).alias("bits"))


def write_summarised(df: DataFrame, root: str, by: Column, keys: Sequence[str], buckets: int = 1) -> None:
    """Write ``df`` in one folder for each value of ``by`` (as text), replacing the folders that it holds and no other; then summarise
    the new files, and only those, by ``keys``."""
    spark = df.sparkSession
    before = set(_files(spark, root))
    out = df.withColumn(FOLDER, by.cast("string")).repartition(FOLDER)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(FOLDER).parquet(root)
    new = [f for f in _files(spark, root) if f not in before]
    if new:
        _summaries(_read(spark, root, new), keys, buckets).coalesce(1).write.mode("append").parquet(f"{root}/{SUMMARY}")


def files_that_may_hold(spark: SparkSession, root: str, wanted: DataFrame, keys: Sequence[str], buckets: int = 1) -> list[str]:
    """The history's files but for those whose summary rules out every key of ``wanted``. ``keys`` and ``buckets`` are those of
    the writer. Of ``wanted`` only the places of its bits are gathered, at most 32,768 times ``buckets`` numbers."""
    files = _files(spark, root)
    if not files or SUMMARY not in commits.entries(spark, root):
        return files
    place, key = _place(keys, buckets), F.struct(*keys)
    asked = wanted.where(place.isNotNull()).agg(F.struct(
        F.collect_set(place).alias("places"), F.min(key).alias("lo"), F.max(key).alias("hi")).alias("asked")).scalar()
    byte = lambda p: F.conv(F.hex(F.substring(F.col("bits"), F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    inside = F.filter("asked.places", lambda p: F.floor(p / BITS) == F.col("bucket"))
    bit = F.exists(F.transform(inside, lambda p: F.pmod(p, F.lit(BITS))), lambda p: F.getbit(byte(p), F.pmod(p, F.lit(8)).cast("int")) == 1)
    may = F.coalesce((F.col("lo") <= F.col("asked.hi")) & (F.col("hi") >= F.col("asked.lo")) & bit, F.lit(False))
    held = spark.read.parquet(f"{root}/{SUMMARY}").withColumn("asked", asked).groupBy("file").agg(F.max(may).alias("may"))
    ruled_out = {r["file"] for r in held.where(~F.col("may")).select("file").collect()}
    return [f for f in files if _name(f) not in ruled_out]


def read_for(spark: SparkSession, root: str, wanted: DataFrame, keys: Sequence[str], buckets: int = 1) -> DataFrame:
    """The rows of the history whose file may hold a key of ``wanted``; all rows that do hold one are among them. Of a
    history that has no file yet, no row, and the key columns only."""
    files = files_that_may_hold(spark, root, wanted, keys, buckets)
    if files:
        return _read(spark, root, files).drop(FOLDER)
    return _read(spark, root).drop(FOLDER).where(F.lit(False)) if _files(spark, root) else wanted.select(*keys).where(F.lit(False))


def unseen(batch: DataFrame, root: str, keys: Sequence[str], buckets: int = 1) -> DataFrame:
    """Rows of ``batch`` whose key no history row has (J13, U6); equal rows are all kept, a key with a null is unseen."""
    held = read_for(batch.sparkSession, root, batch, keys, buckets)
    return batch.join(held.select(*keys), list(keys), "left_anti").select(*[F.col(f"`{c}`") for c in batch.columns])


def append_unless_header(batch: DataFrame, root: str, keys: Sequence[str], order: Sequence[str], buckets: int = 1) -> DataFrame:
    """The rows to append, all of ``batch`` or, where a history row equals its first row (along ``order``) in ``keys``, none."""
    header = batch.orderBy(*order).limit(1).select(*keys)
    held = read_for(batch.sparkSession, root, header, keys, buckets)
    return batch.where(~held.join(header, list(keys), "left_semi").select(F.count(F.lit(1)) > 0).scalar())
