"""Idempotent history maintenance (I1-I11): ``(history, batch) -> history'``.

Every rule decides with semi/anti joins or scalar subqueries evaluated on
the executors — the key lists are never collected to the driver. Merging the
newest batch twice is a no-op under every rule. ``append_if_max_differs`` keeps
the reference's plain ``!=``: a batch older than the history is appended each time
it comes (``append_max_in_set`` is the rule that refuses it). The result is a lazy DataFrame;
write it with :func:`strata.sources.files.write_snapshot` (dynamic partition
overwrite) or :func:`write_history`.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (
    "append_if_new",
    "append_if_max_differs",
    "replace_if_new",
    "upsert",
    "append_unless_all",
    "append_max_in_set",
    "fingerprint",
    "preagg_append",
    "fanout",
    "overwrite",
)


def _union(hist: DataFrame, batch: DataFrame) -> DataFrame:
    return hist.unionByName(batch, allowMissingColumns=True)


def _scalar_bool(df: DataFrame) -> Column:
    return df.scalar()


def _present(hist: DataFrame, key: str, value: Column) -> Column:
    """Scalar: does any history row carry ``value`` in ``key``?"""
    return _scalar_bool(hist.filter(F.col(key) == value).select(F.count(F.lit(1)) > 0))


def merge_history(
    hist: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str],
    rule: str = "append_if_new",
    *,
    columns: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
    measures: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``batch`` into ``hist`` under one of :data:`RULES`.

    key           period column (``upsert``/``fingerprint``: key columns)
    columns       ``fingerprint``: the columns compared with the header row
    order         ``fingerprint``: total order that defines the header row
    measures      ``preagg_append``: measures summed to key grain first
    partition_by  ``fanout``: entity-type column(s); ``append_if_new`` is
                  decided per entity type
    """
    keys = [key] if isinstance(key, str) else list(key)
    k = keys[0]
    if rule == "append_if_new":
        # the batch's first period (explicitly: its minimum) decides
        first = batch.select(F.min(k)).scalar()
        return _union(hist, batch.filter(~_present(hist, k, first)))
    if rule == "append_if_max_differs":
        new = batch.select(F.max(k)).scalar() != hist.select(F.max(k)).scalar()
        return _union(hist, batch.filter(F.coalesce(new, F.lit(True))))
    if rule == "replace_if_new":
        is_new = ~_present(hist, k, batch.select(F.max(k)).scalar())
        return _union(hist.filter(~is_new), batch.filter(is_new))
    if rule == "upsert":
        # batch rows win for keys present in both; everything else is kept
        return _union(hist.join(batch.select(*keys).distinct(), keys, "left_anti"), batch)
    if rule == "append_unless_all":
        missing = batch.select(*keys).distinct().join(hist.select(*keys), keys, "left_anti")
        any_missing = missing.select(F.count(F.lit(1)) > 0).scalar()
        return _union(hist, batch.filter(any_missing))
    if rule == "append_max_in_set":
        # append unless the batch's latest period is already in the history
        return _union(hist, batch.filter(~_present(hist, k, batch.select(F.max(k)).scalar())))
    if rule == "fingerprint":
        cols = list(columns or keys)
        ordk = F.struct(*[F.col(c) for c in (order or cols)])
        header = batch.agg(F.min_by(F.struct(*[F.col(c) for c in cols]), ordk).alias("_h")).select("_h.*")
        hfp = header.withColumn("_fp", F.xxhash64(*cols))
        cand = hist.select(*cols).na.drop(subset=cols).withColumn("_fp", F.xxhash64(*cols))
        # hash prefilter, then exact equality on every column (no false positives)
        hit = cand.join(hfp, ["_fp", *cols], "left_semi")
        exists = hit.select(F.count(F.lit(1)) > 0).scalar()
        return _union(hist, batch.filter(~exists))
    if rule == "preagg_append":
        grain = [c for c in batch.columns if c not in (measures or [])]
        agg = batch.groupBy(*grain).agg(*[F.sum(m).alias(m) for m in (measures or [])])
        return merge_history(hist, agg, k, "append_if_new")
    if rule == "fanout":
        parts = list(partition_by or [])
        firsts = batch.groupBy(*parts).agg(F.min(k).alias(k))
        seen = firsts.join(hist.select(*parts, k).distinct(), [*parts, k], "left_semi").select(*parts)
        return _union(hist, batch.join(seen, parts, "left_anti"))
    if rule == "overwrite":
        return batch
    raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")


def write_history(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", whole: bool = True) -> None:
    """Persist a merged history. ``whole``: ``df`` is the whole history and
    replaces what is there, stale partitions too (what ``replace_if_new`` and
    ``overwrite`` need). Else only the partitions present in ``df`` are
    replaced (dynamic partition overwrite). ``path`` must not be one that ``df`` reads."""
    w = df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "static" if whole else "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
