"""Filters and predicates."""
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import filters as FL
from strata.plans.registry import query
from strata.plans.standins import view
from strata.sources.tables import table


@query("f1_eq", oracle="""
SELECT event_id, Date, OdsCode, Provider, JumpOff, Clicks FROM v_clicks
WHERE (Provider = 'P1' AND JumpOff IN ('viewCarePlans', 'clickCarePlans')) OR Provider = 'P2Cie'""", dates=["Date"])
def f1(spark, sf):
    p, j = F.col("Provider"), F.col("JumpOff")
    return FL.keep(view(spark, sf, "v_clicks"), ((p == "P1") & j.isin("viewCarePlans", "clickCarePlans")) | (p == "P2Cie"))


@query("f2_isin", oracle="""
SELECT o_orderkey, Supplier FROM v_weekly WHERE NOT coalesce(Supplier IN ('EMIS', 'TPP'), false)""")
def f2(spark, sf):
    return FL.isin(view(spark, sf, "v_weekly").select("o_orderkey", "Supplier"), "Supplier", ["EMIS", "TPP"], negate=True)


@query("f3_rlike", oracle="""
SELECT o_orderkey, Supplier FROM v_weekly WHERE NOT regexp_matches(Supplier, '^[0-9]')""")
def f3(spark, sf):
    return FL.contains(view(spark, sf, "v_weekly").select("o_orderkey", "Supplier"), "Supplier", "^[0-9]", negate=True)


@query("f3_rlike_ack", oracle="""
SELECT l_orderkey, l_linenumber, workflow FROM v_acks WHERE regexp_matches(workflow, 'ACK')""")
def f3b(spark, sf):
    return FL.contains(view(spark, sf, "v_acks").select("l_orderkey", "l_linenumber", "workflow"), "workflow", "ACK")


@query("f4_cutoff", oracle="SELECT event_id, Date, Clicks FROM v_clicks WHERE Date >= DATE '2024-01-15'", dates=["Date"])
def f4(spark, sf):
    return FL.on_or_after(view(spark, sf, "v_clicks").select("event_id", "Date", "Clicks"), "Date", "2024-01-15")


F5_BUCKETS = [
    (None, "1997-09", ["Standards Met", "Standards Exceeded"]),
    ("1997-10", "1999-08", ["Standards Met", "STANDARDS MET (19-20)"]),
    ("1999-09", None, ["Standards Exceeded"]),
]


@query("f5_bucketed", oracle="""
SELECT o_orderkey, Period, Status FROM (SELECT o_orderkey, strftime(Snapshot_Date, '%Y-%m') AS Period, Status FROM v_status) t
WHERE (Period <= '1997-09' AND Status IN ('Standards Met', 'Standards Exceeded'))
   OR (Period >= '1997-10' AND Period <= '1999-08' AND Status IN ('Standards Met', 'STANDARDS MET (19-20)'))
   OR (Period >= '1999-09' AND Status IN ('Standards Exceeded'))""")
def f5(spark, sf):
    v = view(spark, sf, "v_status").select("o_orderkey", F.date_format("Snapshot_Date", "yyyy-MM").alias("Period"), "Status")
    return FL.bucketed_status(v, "Period", "Status", F5_BUCKETS)


@query("f6_null", oracle="""
SELECT c.c_custkey FROM customer c LEFT JOIN
  (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-03-01') o
  ON c.c_custkey = o.o_custkey WHERE o.o_custkey IS NULL""")
def f6(spark, sf):
    o = table(spark, sf, "orders").filter(
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1996-03-01").cast("timestamp_ntz"))
    ).select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("_hit")).distinct()
    j = table(spark, sf, "customer", ["c_custkey"]).join(o, "c_custkey", "left")
    return FL.nulls(j, "_hit").select("c_custkey")


@query("f7_sanity", oracle="""
SELECT Daily, Ratio FROM (SELECT Daily, CAST(Open AS DOUBLE) / nullif(Fulfilled, 0) AS Ratio FROM v_monthly) t
WHERE NOT coalesce(Ratio > 1, false)""", dates=["Daily"])
def f7(spark, sf):
    v = view(spark, sf, "v_monthly").select("Daily", F.try_divide(F.col("Open").cast("double"), F.col("Fulfilled")).alias("Ratio"))
    return FL.not_gt_keep_null(v, "Ratio", 1)


@query("f8_latest_rows", oracle="""
SELECT o_orderkey, Code, Snapshot_Date, Status FROM v_status WHERE Snapshot_Date = (SELECT max(Snapshot_Date) FROM v_status)""",
       dates=["Snapshot_Date"])
def f8(spark, sf):
    return FL.latest_rows(view(spark, sf, "v_status").select("o_orderkey", "Code", "Snapshot_Date", "Status"), "Snapshot_Date")


@query("f9_latest_per_month", oracle="""
SELECT o_orderkey, Location, Date FROM v_answers
WHERE Date IN (SELECT max(Date) FROM v_answers GROUP BY date_trunc('month', Date))""", dates=["Date"])
def f9(spark, sf):
    return FL.latest_per_month(view(spark, sf, "v_answers").select("o_orderkey", "Location", "Date"), "Date")


@query("f9_latest_per_month_of_year", oracle="""
SELECT o_orderkey, Location, Date FROM v_answers
WHERE Date IN (SELECT max(Date) FROM v_answers GROUP BY month(Date))""", dates=["Date"])
def f9b(spark, sf):
    return FL.latest_per_month(view(spark, sf, "v_answers").select("o_orderkey", "Location", "Date"), "Date", period="month_of_year")


@query("f10_active", oracle="""
SELECT Code, Name, Open_Date, Close_Date FROM v_org
WHERE (Close_Date IS NULL OR Close_Date > DATE '2000-06-30') AND Open_Date < DATE '2000-06-30'""", dates=["Open_Date", "Close_Date"])
def f10(spark, sf):
    return FL.active_as_of(view(spark, sf, "v_org").select("Code", "Name", "Open_Date", "Close_Date"), "2000-06-30")


@query("f11_incomplete", oracle="""
SELECT Month, Discharges FROM (SELECT strftime(Discharge_Date, '%Y-%m') AS Month, CAST(sum(Discharges) AS BIGINT) AS Discharges
  FROM v_denominator GROUP BY 1) t WHERE Month < '2001-07'""")
def f11(spark, sf):
    m = A.monthly_sum(view(spark, sf, "v_denominator"), "Discharge_Date", ["Discharges"], name="Month")
    return FL.drop_incomplete(m, "Month", run_date="2001-07-15")


@query("f11_incomplete_max", oracle="""
SELECT Month, Discharges FROM (SELECT strftime(Discharge_Date, '%Y-%m') AS Month, CAST(sum(Discharges) AS BIGINT) AS Discharges
  FROM v_denominator GROUP BY 1) t WHERE Month < (SELECT max(strftime(Discharge_Date, '%Y-%m')) FROM v_denominator)""")
def f11b(spark, sf):
    m = A.monthly_sum(view(spark, sf, "v_denominator"), "Discharge_Date", ["Discharges"], name="Month")
    return FL.drop_incomplete(m, "Month", mode="max")


@query("f12_report_cap", oracle="""
SELECT o_orderkey, Snapshot_Date FROM v_status WHERE Snapshot_Date <= DATE '1999-12-31'""", dates=["Snapshot_Date"])
def f12(spark, sf):
    return FL.cap_to_report_month(view(spark, sf, "v_status").select("o_orderkey", "Snapshot_Date"), "Snapshot_Date", "2000-01-15")


@query("f13_age", oracle="""
SELECT Pop_Id, Area_Code, Age, Size FROM v_pop WHERE TRY_CAST(regexp_replace(Age, '\\+$', '') AS INTEGER) > 17""")
def f13(spark, sf):
    return FL.adult_population(view(spark, sf, "v_pop").select("Pop_Id", "Area_Code", "Age", "Size"), "Age", 17)


@query("f14_dropna", oracle="""
SELECT * FROM (SELECT o_orderkey, Practice_Code, Supplier FROM v_weekly) t WHERE Supplier IS NOT NULL AND Practice_Code IS NOT NULL""")
def f14(spark, sf):
    return FL.dropna(view(spark, sf, "v_weekly").select("o_orderkey", "Practice_Code", "Supplier"))


@query("f15_totals", oracle="""
SELECT Id, Name_Dirty FROM v_text WHERE NOT (coalesce(contains(Name_Dirty, 'Grand Total'), false) OR coalesce(Name_Dirty = 'nan', false))""")
def f15(spark, sf):
    return FL.drop_totals(view(spark, sf, "v_text").select("Id", "Name_Dirty"), "Name_Dirty")


@query("f17_split", oracle="""
SELECT Daily, Fulfilled % 4 AS Measure, CASE WHEN Fulfilled % 4 = 0 THEN 'zero' ELSE 'positive' END AS Part
FROM v_monthly WHERE Fulfilled % 4 >= 0""", dates=["Daily"])
def f17(spark, sf):
    v = view(spark, sf, "v_monthly").select("Daily", (F.col("Fulfilled") % 4).alias("Measure"))
    zero, pos = FL.split_by_zero(v, "Measure")
    return zero.withColumn("Part", F.lit("zero")).unionByName(pos.withColumn("Part", F.lit("positive")))
