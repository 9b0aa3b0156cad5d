"""Set operations, de-duplication, ordering (U1-U6, O1-O3) and header/projection operators."""
from pyspark.sql import functions as F

from strata.operators import projection as P
from strata.operators import sets as U
from strata.plans.registry import query
from strata.plans.standins import view
from strata.sources.tables import table


@query("u1_union", oracle="""
SELECT o_orderkey, Period, o_orderstatus, o_totalprice FROM v_hist
UNION ALL SELECT o_orderkey, Period, NULL AS o_orderstatus, o_totalprice FROM v_batch_new""", dates=["Period"])
def u1(spark, sf):
    h = view(spark, sf, "v_hist").select("o_orderkey", "Period", "o_orderstatus", "o_totalprice")
    b = view(spark, sf, "v_batch_new").select("o_orderkey", "Period", "o_totalprice")
    return U.union_all(h, b)


@query("u3_distinct", oracle="SELECT DISTINCT Location, Type FROM v_answers")
def u3(spark, sf):
    return U.distinct(view(spark, sf, "v_answers").select("Location", "Type"))


@query("u4_dedup_first", oracle="""
SELECT Location, o_orderkey, Date, Answer FROM (
  SELECT *, row_number() OVER (PARTITION BY Location ORDER BY Date, o_orderkey) AS rn FROM v_answers) t WHERE rn = 1""", dates=["Date"])
def u4(spark, sf):
    return U.dedup_first(view(spark, sf, "v_answers").select("Location", "o_orderkey", "Date", "Answer"), ["Location"], ["Date", "o_orderkey"])


@query("u5_dedup_last", oracle="""
SELECT Location, Type, o_orderkey, Date, Answer FROM (
  SELECT *, row_number() OVER (PARTITION BY Location, Type ORDER BY Date DESC, o_orderkey DESC) AS rn FROM v_answers) t WHERE rn = 1""",
       dates=["Date"])
def u5(spark, sf):
    v = view(spark, sf, "v_answers").select("Location", "Type", "o_orderkey", "Date", "Answer")
    return U.dedup_last(v, ["Location", "Type"], ["Date", "o_orderkey"])


@query("u6_all_present", oracle="""
SELECT CAST(count(*) AS BIGINT) AS Missing_Periods, count(*) = 0 AS All_Present FROM
  (SELECT DISTINCT Period FROM v_batch WHERE Period NOT IN (SELECT Period FROM v_hist)) t""")
def u6(spark, sf):
    b, h = view(spark, sf, "v_batch"), view(spark, sf, "v_hist")
    return U.missing_from(b, h, ["Period"]).agg(F.count(F.lit(1)).cast("long").alias("Missing_Periods")).withColumn(
        "All_Present", F.col("Missing_Periods") == 0)


@query("o1_sort", oracle="SELECT o_orderkey, o_orderdate, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey", dates=["o_orderdate"])
def o1(spark, sf):
    return U.sort(table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_custkey"]), ["o_orderdate", "o_orderkey"])


@query("o2_tail", oracle="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""", dates=["o_orderdate"])
def o2(spark, sf):
    return U.tail(table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"]), ["o_orderdate", "o_orderkey"], 10)


@query("o3_first_last", oracle="""
SELECT o_orderstatus, min(Period) AS first, max(Period) AS last FROM v_batch GROUP BY o_orderstatus""", dates=["first", "last"])
def o3(spark, sf):
    return U.first_last(view(spark, sf, "v_batch"), "Period", keys="o_orderstatus")


# ---------------------------------------------------------------- P2-P9
@query("p2_rename", oracle="SELECT Date, OdsCode AS Practice_code, Clicks AS Number_of_clicks FROM v_clicks", dates=["Date"])
def p2(spark, sf):
    v = view(spark, sf, "v_clicks").select("Date", "OdsCode", "Clicks")
    return P.rename(v, {"OdsCode": "Practice_code", "Clicks": "Number_of_clicks"})


@query("p3_drop", oracle="SELECT event_id, Date, OdsCode, Clicks FROM v_clicks", dates=["Date"])
def p3(spark, sf):
    return P.drop_cols(view(spark, sf, "v_clicks"), ["Provider", "JumpOff", "Not_There"])


@query("p4_literal", oracle="""
SELECT event_id, 'Clicks' AS Metric, DATE '2024-02-01' AS Run_Date, Clicks FROM v_clicks""", dates=["Run_Date"])
def p4(spark, sf):
    v = view(spark, sf, "v_clicks").select("event_id", "Clicks")
    v = P.with_literal(v, "Run_Date", F.lit("2024-02-01").cast("date"), position=1)
    return P.with_literal(v, "Metric", "Clicks", position=1)


_MESSY = ['" Code "', '"Status-Raw "', '"Organisation Name"']


@query("p5_headers", oracle="""
SELECT Code AS code, Status AS status_raw, Name AS organisation_name FROM (SELECT c_custkey AS Code, c_mktsegment AS Status, c_name AS Name FROM customer)""")
def p5(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias(" Code "), F.col("c_mktsegment").alias("Status-Raw "), F.col("c_name").alias("Organisation Name"))
    return P.normalise_headers(c, ["strip", "lower", "dash_to_underscore", "space_to_underscore"])


@query("p6_drop_matching", oracle="SELECT c_custkey AS Code, c_name AS Name FROM customer")
def p6(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Code"), F.lit(None).cast("string").alias("Unnamed: 0"),
        F.col("c_name").alias("Name"), F.col("c_acctbal").alias("deprecated_balance"), F.col("c_mktsegment").alias("Old UNNAMED col"))
    return P.drop_matching(c, r"^unnamed|unnamed|deprecated")


@query("p7_canonical", oracle="""
SELECT c_mktsegment AS "Primary Sector", c_custkey AS Code, c_name AS Organisation_Name, c_nationkey AS Status_Raw FROM customer""")
def p7(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("PRIMARY SECTOR (GP)"), F.col("c_custkey").alias("Org code"),
        F.col("c_name").alias("ORGANISATION NAME"), F.col("c_nationkey").alias("Latest status"))
    return P.canonicalise(c, [("PRIMARY", "Primary Sector"), ("CODE", "Code"), ("ORGANISATION", "Organisation_Name"), ("STATUS", "Status_Raw")])


@query("p8_positional", oracle="SELECT o_orderkey AS Code, o_custkey, o_orderdate AS Period FROM orders", dates=["Period"])
def p8(spark, sf):
    return P.rename_at(table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]), {0: "Code", 2: "Period"})


@query("p9_unique_id", oracle="""
SELECT Date, OdsCode, Clicks, CAST(row_number() OVER (ORDER BY Date, OdsCode) - 1 AS BIGINT) AS Unique_ID FROM
  (SELECT Date, OdsCode, CAST(coalesce(sum(Clicks), 0) AS BIGINT) AS Clicks FROM v_clicks GROUP BY ALL) t""", dates=["Date"])
def p9(spark, sf):
    from strata.operators.aggregates import sum_by
    return P.with_row_id(sum_by(view(spark, sf, "v_clicks"), ["Date", "OdsCode"], "Clicks"), ["Date", "OdsCode"])
