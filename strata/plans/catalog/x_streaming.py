"""Incremental landing-zone ingest (Structured Streaming)."""
from pyspark.sql import functions as F

from strata.plans.registry import query
from strata.session import scratch_path
from strata.sources.tables import table
from strata.streaming.ingest import incremental_ingest, period_of, read_history

SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING"


@query("x1_incremental_ingest", oracle="""
SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS Period FROM events""", dates=["ts", "Period"])
def x1(spark, sf):
    """Every day spans several files in several micro-batches; the drop is sent again under other
    names in the same run, and one day of it in a second run."""
    base = scratch_path(spark, "x1")
    ev = table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    ev.repartition(6, "event_id").write.parquet(f"{base}/landing/drop1")
    ev.repartition(6, "event_id").write.parquet(f"{base}/landing/drop1_resend")
    _drain(spark, base)
    ev.filter(F.to_date("ts") == F.lit("2024-01-05").cast("date")).write.parquet(f"{base}/landing/drop2_resend")
    _drain(spark, base)
    return read_history(spark, f"{base}/history")


def _drain(spark, base):
    incremental_ingest(spark, f"{base}/landing/*", SCHEMA, f"{base}/history", f"{base}/checkpoint", "Period",
                       max_files_per_trigger=2, transform=period_of("ts"))


@query("x1_equal_rows", oracle="""
SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS Period FROM events
UNION ALL SELECT event_id, ts, user_id, event_type, CAST(ts AS DATE) AS Period FROM events WHERE event_type = 'click'""", dates=["ts", "Period"])
def x1_equal_rows(spark, sf):
    """Rows of one event type come in a second file of the same drop, equal in all columns: they are kept. That file
    is sent again under another name, and not kept again."""
    base = scratch_path(spark, "x1-equal")
    ev = table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    ev.repartition(6, "event_id").write.parquet(f"{base}/landing/drop1")
    for name in ("more", "more_resend"):
        ev.filter("event_type = 'click'").repartition(3, "event_id").write.parquet(f"{base}/landing/{name}")
    _drain(spark, base)
    return read_history(spark, f"{base}/history")
