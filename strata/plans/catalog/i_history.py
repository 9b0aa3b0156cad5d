"""History maintenance rules (I1-I11) on history/batch stand-ins."""
from pyspark.sql import functions as F

from strata.operators.history import merge_history
from strata.plans.registry import query
from strata.plans.standins import view
from strata.session import scratch_path
from strata.sources.summaries import append_unless_header, write_summarised

COLS = "o_orderkey, o_custkey, Period, o_orderstatus, o_totalprice"


def _hb(spark, sf, batch="v_batch"):
    return view(spark, sf, "v_hist"), view(spark, sf, batch)


@query("i1_append_if_new", oracle=f"""
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch_new WHERE NOT EXISTS (SELECT 1 FROM v_hist WHERE Period = (SELECT min(Period) FROM v_batch_new))""",
       dates=["Period"])
def i1(spark, sf):
    h, b = _hb(spark, sf, "v_batch_new")
    return merge_history(h, b, "Period", "append_if_new")


@query("i1_append_if_new_overlap", oracle=f"""
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch WHERE NOT EXISTS (SELECT 1 FROM v_hist WHERE Period = (SELECT min(Period) FROM v_batch))""",
       dates=["Period"])
def i1b(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "append_if_new")


@query("i2_append_if_max_differs", oracle=f"""
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch WHERE (SELECT max(Period) FROM v_batch) <> (SELECT max(Period) FROM v_hist)""", dates=["Period"])
def i2(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "append_if_max_differs")


@query("i3_replace_if_new", oracle=f"""
SELECT {COLS} FROM v_hist WHERE EXISTS (SELECT 1 FROM v_hist WHERE Period = (SELECT max(Period) FROM v_batch))
UNION ALL
SELECT {COLS} FROM v_batch WHERE NOT EXISTS (SELECT 1 FROM v_hist WHERE Period = (SELECT max(Period) FROM v_batch))""",
       dates=["Period"])
def i3(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "replace_if_new")


@query("i4_upsert", oracle=f"""
SELECT {COLS} FROM v_hist WHERE o_orderkey NOT IN (SELECT o_orderkey FROM v_batch) UNION ALL SELECT {COLS} FROM v_batch""",
       dates=["Period"])
def i4(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "o_orderkey", "upsert")


@query("i5_append_unless_all", oracle=f"""
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch WHERE EXISTS (SELECT 1 FROM v_batch WHERE Period NOT IN (SELECT Period FROM v_hist))""", dates=["Period"])
def i5(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "append_unless_all")


@query("i6_append_max_in_set", oracle=f"""
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch WHERE (SELECT max(Period) FROM v_batch) NOT IN (SELECT Period FROM v_hist)""", dates=["Period"])
def i6(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "append_max_in_set")


@query("i7_fingerprint", oracle=f"""
WITH hdr AS (SELECT o_custkey, o_orderstatus FROM v_batch ORDER BY o_orderkey LIMIT 1)
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch WHERE NOT EXISTS (
  SELECT 1 FROM v_hist h, hdr WHERE h.o_custkey = hdr.o_custkey AND h.o_orderstatus = hdr.o_orderstatus)""", dates=["Period"])
def i7(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "fingerprint", columns=["o_custkey", "o_orderstatus"], order=["o_orderkey"])


@query("i7_fingerprint_new", oracle=f"""
WITH hdr AS (SELECT o_custkey, o_orderstatus, o_totalprice FROM v_batch_new ORDER BY o_orderkey LIMIT 1)
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch_new WHERE NOT EXISTS (
  SELECT 1 FROM v_hist h, hdr WHERE h.o_custkey = hdr.o_custkey AND h.o_orderstatus = hdr.o_orderstatus AND h.o_totalprice = hdr.o_totalprice)""",
       dates=["Period"])
def i7b(spark, sf):
    h, b = _hb(spark, sf, "v_batch_new")
    return merge_history(h, b, "Period", "fingerprint", columns=["o_custkey", "o_orderstatus", "o_totalprice"], order=["o_orderkey"])


@query("i7_fingerprint_pruned", oracle=f"""
WITH hdr AS (SELECT o_custkey, o_orderstatus, o_totalprice FROM v_batch_new ORDER BY o_orderkey LIMIT 1)
SELECT {COLS} FROM v_batch_new WHERE NOT EXISTS (
  SELECT 1 FROM v_hist h, hdr WHERE h.o_custkey = hdr.o_custkey AND h.o_orderstatus = hdr.o_orderstatus AND h.o_totalprice = hdr.o_totalprice)""",
       dates=["Period"])
def i7c(spark, sf):
    """The rows to append; of the history only the files are read that may hold the batch's header row."""
    h, b = _hb(spark, sf, "v_batch_new")
    root, keys = scratch_path(spark, "history"), ["o_custkey", "o_orderstatus", "o_totalprice"]
    write_summarised(h, root, F.date_format("Period", "yyyy-MM"), keys, buckets=4)
    return append_unless_header(b, root, keys, ["o_orderkey"], buckets=4)


_PRE = "(SELECT Period, o_custkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS Price FROM {v} GROUP BY ALL)"


@query("i8_preagg_append", oracle=f"""
SELECT * FROM {_PRE.format(v='v_hist')} UNION ALL
SELECT * FROM {_PRE.format(v='v_batch_new')} b WHERE NOT EXISTS (SELECT 1 FROM v_hist WHERE Period = (SELECT min(Period) FROM v_batch_new))""",
       dates=["Period"])
def i8(spark, sf):
    h, b = _hb(spark, sf, "v_batch_new")
    price = F.floor("o_totalprice").cast("long").alias("Price")
    hist = h.groupBy("Period", "o_custkey").agg(F.sum(price).cast("long").alias("Price"))
    return merge_history(hist, b.select("Period", "o_custkey", price), "Period", "preagg_append", measures=["Price"])


@query("i10_fanout", oracle=f"""
WITH firsts AS (SELECT o_orderstatus, min(Period) AS Period FROM v_batch GROUP BY o_orderstatus),
     seen AS (SELECT f.o_orderstatus FROM firsts f WHERE EXISTS (SELECT 1 FROM v_hist h WHERE h.o_orderstatus = f.o_orderstatus AND h.Period = f.Period))
SELECT {COLS} FROM v_hist UNION ALL
SELECT {COLS} FROM v_batch WHERE o_orderstatus NOT IN (SELECT o_orderstatus FROM seen)""", dates=["Period"])
def i10(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "fanout", partition_by=["o_orderstatus"])


@query("i11_overwrite", oracle=f"SELECT {COLS} FROM v_batch", dates=["Period"])
def i11(spark, sf):
    h, b = _hb(spark, sf)
    return merge_history(h, b, "Period", "overwrite")
