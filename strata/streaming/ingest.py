"""Incremental landing-zone ingest with Structured Streaming.

New files in the landing folder are picked up exactly once (the file source tracks them in the checkpoint), and a
file that is sent again, under whatever name, is recognised as a file: a ledger beside the history keeps
each file's fingerprint (row count and two order-free sums of row hashes). Rows are never compared, so equal rows
of one file or of several are all kept.

Which periods are new is decided once per run, from the ledger as it stood before the run, so the result does not
depend on how files fall into micro-batches. Every micro-batch writes its own ``_epoch`` folder of the history, then
its periods, then its files into the ledger; the last of these commits it. A batch that broke off in between is
run again with the same decision and replaces its folders; readers see committed epochs only. A micro-batch reads
its own files and the ledger (one row per file), neither the history nor earlier batches.

``trigger(availableNow=True)`` processes the backlog in bounded micro-batches and stops — the scheduled-drop
equivalent of the reference's per-file notebook runs. History, ledger and checkpoint live in the shared
folder, so a restarted or re-scheduled job resumes where it stopped.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

EPOCH = "_epoch"
FILE = "_file"  # the landing file of a row, within a run
PRINT = ["_rows", "_sum_a", "_sum_b"]  # a file's fingerprint


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None only if there is no such path, any other failure surfaces."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _files(history_path: str) -> str:
    return f"{history_path}-ledger/files"


def _periods(history_path: str) -> str:
    return f"{history_path}-ledger/periods"


def _last_epoch(spark: SparkSession, history_path: str) -> int | None:
    """The last committed epoch. A history without a ledger counts as committed."""
    for path in (_files(history_path), history_path):
        if (table := _read(spark, path)) is not None and EPOCH in table.columns:
            last = table.agg(F.max(EPOCH)).first()[0]
            return None if last is None else int(last)
    return None


def read_history(spark: SparkSession, history_path: str) -> DataFrame:
    """The rows of all committed epochs."""
    history = spark.read.parquet(history_path)
    if EPOCH not in history.columns:
        return history
    last = _last_epoch(spark, history_path)
    return (history if last is None else history.where(F.col(EPOCH) <= last)).drop(EPOCH)


def _first_epoch(spark: SparkSession, history_path: str, checkpoint: str) -> int:
    """The run's first epoch. A run that broke off left its marker: its successor goes on with the same one."""
    marker = _read(spark, f"{checkpoint}-run")
    row = marker.first() if marker is not None else None
    if row is not None and not row["done"]:
        return row["first_epoch"]
    last = _last_epoch(spark, history_path)
    return 0 if last is None else last + 1


def _mark(spark: SparkSession, checkpoint: str, first_epoch: int, done: bool) -> None:
    spark.createDataFrame([(first_epoch, done)], "first_epoch long, done boolean").coalesce(1).write.mode("overwrite").parquet(
        f"{checkpoint}-run")


def seen_periods(spark: SparkSession, history_path: str, period: str, first_epoch: int) -> DataFrame | None:
    """The periods of the epochs before ``first_epoch`` (column ``_seen``), from the ledger; from the history itself only
    if that is older than the ledger."""
    table = _read(spark, _periods(history_path))
    if table is None:
        table = _read(spark, history_path)
    if table is None:
        return None
    before = table.where(F.col(EPOCH) < first_epoch) if EPOCH in table.columns else table
    return before.select(F.col(period).alias("_seen")).distinct()


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def fingerprints(batch: DataFrame) -> DataFrame:
    """(FILE, PRINT) of every file of ``batch``: the same for equal rows in any order, and only for those."""
    columns = [c for c in batch.columns if c != FILE]
    plain = [F.to_json(F.struct(F.col(c))) if _has_map(batch.schema[c].dataType) else F.col(c) for c in columns]
    # a hash passes over nulls, so which columns are null goes in too
    nulls = F.concat(F.lit(""), *(F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns))
    total = lambda h: F.sum(h.cast("decimal(20,0)"))

    def sums(seed: int) -> Column:
        return total(F.xxhash64(F.lit(seed), nulls, *plain))

    return batch.groupBy(FILE).agg(F.count(F.lit(1)).alias("_rows"), sums(1).alias("_sum_a"), sums(2).alias("_sum_b"))


def append_new(history_path: str, period: str, first_epoch: int):
    """foreachBatch writer: rows of files that the ledger doesn't know, of periods that were not in the history before
    ``first_epoch``. Of equal files in one batch the one with the smallest name is taken.

    A batch without ``FILE`` is one file, and its rows count as sent once each."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        columns = [c for c in batch.columns if c != FILE]
        if FILE not in batch.columns:
            batch = batch.dropDuplicates().withColumn(FILE, F.lit(""))
        prints = fingerprints(batch).groupBy(*PRINT).agg(F.min(FILE).alias(FILE))
        known = _read(spark, _files(history_path))
        if known is not None:
            known = known.where(F.col(EPOCH) < epoch_id)
            prints = prints.join(known.select(*PRINT).distinct(), PRINT, "left_anti")
        taken = spark.createDataFrame(prints.collect(), prints.schema)  # one row per file, at most max_files_per_trigger
        names = [r[FILE] for r in taken.collect()]
        if names:
            fresh = batch.where(F.col(FILE).isin(names))
            seen = seen_periods(spark, history_path, period, first_epoch)
            if seen is not None:
                fresh = fresh.join(seen, F.col(period).eqNullSafe(F.col("_seen")), "left_anti")
            at = f"{history_path}/{EPOCH}={epoch_id}"
            fresh.select(*columns).write.mode("overwrite").parquet(at)
            brought = spark.read.schema(batch.select(*columns).schema).parquet(at).select(period).distinct()
            brought.write.mode("overwrite").parquet(f"{_periods(history_path)}/{EPOCH}={epoch_id}")
        taken.coalesce(1).write.mode("overwrite").parquet(f"{_files(history_path)}/{EPOCH}={epoch_id}")

    return run


def incremental_ingest(spark: SparkSession, landing: str, schema: StructType | str, history_path: str,
                       checkpoint: str, period: str, fmt: str = "parquet", max_files_per_trigger: int = 100,
                       transform=None) -> None:
    """Drain the landing folder into the history (blocks until done).

    ``max_files_per_trigger`` bounds the memory of a micro-batch and nothing else. Every row of a
    file that comes for the first time is kept; ``transform`` must keep the column ``_file`` for that.
    """
    first_epoch = _first_epoch(spark, history_path, checkpoint)
    _mark(spark, checkpoint, first_epoch, done=False)
    stream = (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).load(landing)
              .withColumn(FILE, F.col("_metadata.file_path")))
    if transform is not None:
        stream = transform(stream)
    if FILE not in stream.columns:
        raise ValueError(f"transform must keep the column {FILE}")
    q = (stream.writeStream.foreachBatch(append_new(history_path, period, first_epoch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    _mark(spark, checkpoint, first_epoch, done=True)


def period_of(ts_col: str, name: str = "Period"):
    return lambda df: df.withColumn(name, F.to_date(F.col(ts_col)))
