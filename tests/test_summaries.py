"""Histories with file summaries: fewer files are read, and no key is missed."""
import datetime as dt

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources import summaries as H

SCHEMA = "day date, org string, n int"


def month():
    return F.date_format("day", "yyyy-MM")


def frame(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, o, n) for d, o, n in rows], SCHEMA)


def year(spark):
    return frame(spark, [(f"2023-{m:02d}-{d:02d}", f"o{m * 100 + d}", m) for m in range(1, 13) for d in (1, 11, 21)])


def wanted(spark, *days):
    return frame(spark, [(d, "x", 0) for d in days])


def test_only_files_that_may_hold_a_period_are_read(spark):
    root = scratch_path(spark, "summaries")
    H.write_summarised(year(spark), root, month(), ["day"])
    assert len(H.files_that_may_hold(spark, root, wanted(spark, "2024-01-01"), ["day"])) == 0
    assert len(H.files_that_may_hold(spark, root, wanted(spark, "2023-05-11"), ["day"])) == 1
    plan = H.read_for(spark, root, wanted(spark, "2023-05-11", "2023-07-01", None), ["day"])
    assert sorted(f.split("folder=")[1][:7] for f in plan.inputFiles()) == ["2023-05", "2023-07"]
    assert plan.columns == ["day", "org", "n"] and dict(plan.dtypes)["day"] == "date"
    batch = wanted(spark, "2023-05-11", "2023-05-12", "2024-01-01", "2024-01-01", None)
    out = H.unseen(batch, root, ["day"])
    assert sorted(str(r.day) for r in out.collect()) == ["2023-05-12", "2024-01-01", "2024-01-01", "None"]


def test_replaced_and_unsummarised_files(spark):
    """A replaced folder answers by its new files; files that no summary knows are always read."""
    root = scratch_path(spark, "summaries")
    H.write_summarised(year(spark), root, month(), ["day"])
    H.write_summarised(frame(spark, [("2023-05-30", "new", 1)]), root, month(), ["day"])  # May anew
    assert H.unseen(wanted(spark, "2023-05-11"), root, ["day"]).count() == 1
    assert H.unseen(wanted(spark, "2023-05-30", "2023-06-11"), root, ["day"]).count() == 0
    late = frame(spark, [("2024-02-02", "late", 1)])
    late.withColumn(H.FOLDER, month()).write.mode("append").partitionBy(H.FOLDER).parquet(root)  # broke off before its summary
    assert H.unseen(wanted(spark, "2024-02-02"), root, ["day"]).count() == 0


def test_no_history_null_keys_and_empty_batches(spark):
    root = scratch_path(spark, "summaries")
    assert H.unseen(wanted(spark, "2023-05-11"), root, ["day"]).count() == 1
    H.write_summarised(frame(spark, []), root, month(), ["day"])
    assert H.unseen(wanted(spark, "2023-05-11"), root, ["day"]).count() == 1
    H.write_summarised(frame(spark, [(None, "a", 1), ("2023-01-01", "a", 1)]), root, month(), ["day"])
    assert H.unseen(wanted(spark, None, "2023-01-01"), root, ["day"]).collect() == [(None, "x", 0)]
    assert H.unseen(frame(spark, []), root, ["day"]).count() == 0


def test_header_of_several_columns(spark):
    root = scratch_path(spark, "summaries")
    H.write_summarised(year(spark), root, month(), ["org", "n"], buckets=2)
    known = frame(spark, [("2024-01-01", "o511", 5), ("2024-01-02", "zz", 1)])
    new = frame(spark, [("2024-01-01", "o511", 6), ("2024-01-02", "zz", 1)])
    assert H.append_unless_header(known, root, ["org", "n"], ["day"], buckets=2).count() == 0
    assert H.append_unless_header(new, root, ["org", "n"], ["day"], buckets=2).count() == 2


def test_full_bitmaps_miss_nothing(spark):
    """Far more keys than bits: every key is still found, and the range still rules files out."""
    root = scratch_path(spark, "summaries")
    rows = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("part"))
    H.write_summarised(rows, root, F.col("part"), ["k"])
    assert H.unseen(spark.range(0, 200_000, 997).withColumnRenamed("id", "k"), root, ["k"]).count() == 0
    assert H.files_that_may_hold(spark, root, spark.range(200_000, 200_010).withColumnRenamed("id", "k"), ["k"]) == []
