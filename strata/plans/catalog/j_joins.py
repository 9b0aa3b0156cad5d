"""Joins (J1-J17)."""
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregates as A
from strata.operators import joins as J
from strata.operators import timeseries as W
from strata.plans.registry import query
from strata.plans.standins import view
from strata.session import scratch_path
from strata.sources.summaries import unseen, write_summarised
from strata.sources.tables import table


@query("j1_left", oracle="""
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def j1(spark, sf):
    c = table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = table(spark, sf, "nation", ["n_nationkey", "n_name"])
    return J.join_on(c, n, "c_nationkey", "n_nationkey", "left").select("c_custkey", "c_name", "n_name")


_FIELD_SUMS = """(SELECT Report_Period_End, Practice_Code, CAST(sum(Value) AS DOUBLE) AS {name} FROM v_field
  WHERE Field = '{field}' GROUP BY ALL)"""


def _field_sum(spark, sf, field, name):
    v = view(spark, sf, "v_field").filter(F.col("Field") == field)
    return v.groupBy("Report_Period_End", "Practice_Code").agg(F.sum("Value").alias(name))


@query("j2_left_composite", oracle=f"""
SELECT r.Report_Period_End, r.Practice_Code, r.Returned, n.Normal FROM {_FIELD_SUMS.format(name='Returned', field='R')} r
LEFT JOIN {_FIELD_SUMS.format(name='Normal', field='N')} n
  ON r.Report_Period_End = n.Report_Period_End AND r.Practice_Code = n.Practice_Code""", dates=["Report_Period_End"])
def j2(spark, sf):
    return J.join_on(_field_sum(spark, sf, "R", "Returned"), _field_sum(spark, sf, "N", "Normal"),
                     ["Report_Period_End", "Practice_Code"], how="left")


_MONTH_DISCH = "(SELECT strftime(Discharge_Date, '%Y-%m') AS Month, CAST(sum(Discharges) AS BIGINT) AS Discharges FROM v_denominator GROUP BY 1)"
_MONTH_ACKS = "(SELECT strftime(_time, '%Y-%m') AS Month, CAST(count(*) AS BIGINT) AS Acks FROM v_acks GROUP BY 1)"
_MONTH_REV = "(SELECT strftime(Daily, '%Y-%m') AS Month, CAST(sum(Revenue) AS BIGINT) AS Revenue FROM v_monthly GROUP BY 1)"


def _month_disch(spark, sf):
    return A.monthly_sum(view(spark, sf, "v_denominator"), "Discharge_Date", ["Discharges"], null_sum=None)


def _month_acks(spark, sf):
    v = view(spark, sf, "v_acks").withColumn("Month", F.date_format("_time", "yyyy-MM"))
    return A.count_by(v, ["Month"], name="Acks")


def _month_rev(spark, sf):
    return A.monthly_sum(view(spark, sf, "v_monthly"), "Daily", ["Revenue"], null_sum=None)


@query("j3_inner", oracle=f"SELECT d.Month, d.Discharges, r.Revenue FROM {_MONTH_DISCH} d JOIN {_MONTH_REV} r ON d.Month = r.Month")
def j3(spark, sf):
    return J.join_on(_month_disch(spark, sf), _month_rev(spark, sf), "Month", how="inner")


@query("j4_full", oracle=f"""
SELECT coalesce(a.Month, d.Month) AS Month, a.Acks, d.Discharges FROM {_MONTH_ACKS} a FULL OUTER JOIN {_MONTH_DISCH} d ON a.Month = d.Month""")
def j4(spark, sf):
    return J.full_join(_month_acks(spark, sf), _month_disch(spark, sf), "Month")


@query("j5_outer_fold", oracle=f"""
SELECT coalesce(a.Month, d.Month, r.Month) AS Month, a.Acks, d.Discharges, r.Revenue
FROM {_MONTH_ACKS} a FULL OUTER JOIN {_MONTH_DISCH} d ON a.Month = d.Month
FULL OUTER JOIN {_MONTH_REV} r ON coalesce(a.Month, d.Month) = r.Month""")
def j5(spark, sf):
    return J.outer_merge_all([_month_acks(spark, sf), _month_disch(spark, sf), _month_rev(spark, sf)], "Month")


@query("j6_scaffold", oracle="""
SELECT o.OdsCode, CAST(d.Date AS DATE) AS Date FROM (SELECT DISTINCT OdsCode FROM v_clicks) o
CROSS JOIN (SELECT unnest(generate_series((SELECT min(Date) FROM v_clicks), (SELECT max(Date) FROM v_clicks), INTERVAL 1 DAY)) AS Date) d""",
       dates=["Date"])
def j6(spark, sf):
    v = view(spark, sf, "v_clicks")
    lo, hi = v.select(F.min("Date")).scalar(), v.select(F.max("Date")).scalar()
    return J.scaffold(v.select("OdsCode"), lo, hi, "1 day", "Date")


@query("j7_zip", oracle=f"""
SELECT d.Month, d.Discharges, a.Month AS Ack_Month, a.Acks FROM
  (SELECT *, row_number() OVER (ORDER BY Month) AS rn FROM {_MONTH_DISCH}) d LEFT JOIN
  (SELECT *, row_number() OVER (ORDER BY Month) AS rn FROM (SELECT * FROM {_MONTH_ACKS} x)) a ON d.rn = a.rn""")
def j7(spark, sf):
    acks = _month_acks(spark, sf).withColumnRenamed("Month", "Ack_Month")
    return J.zip_join(_month_disch(spark, sf), acks, ["Month"], ["Ack_Month"])


EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


@query("j8_widen", oracle="""
SELECT s.Date, s.OdsCode, """ + ", ".join(
    f"CAST((SELECT count(*) FROM v_usage u WHERE u.Date = s.Date AND u.OdsCode = s.OdsCode AND u.Measure = '{t}') AS BIGINT) AS n_{t}"
    for t in EVENT_TYPES) + """
FROM (SELECT DISTINCT Date, OdsCode FROM v_usage WHERE Measure = 'view') s""", dates=["Date"])
def j8(spark, sf):
    u = view(spark, sf, "v_usage")
    spine = u.filter(F.col("Measure") == "view").select("Date", "OdsCode").distinct()
    feeds = {}
    for t in EVENT_TYPES:
        feeds[f"n_{t}"] = (A.count_by(u.filter(F.col("Measure") == t), ["Date", "OdsCode"], name="n"), "n")
    out = J.widen(spine, feeds, ["Date", "OdsCode"])
    return out.na.fill(0, subset=list(feeds))


@query("j9_month_offset", oracle="""
SELECT a.Location, a.Month, a.Answers, b.Beds FROM
  (SELECT Location, CAST(date_trunc('month', Date) AS DATE) AS Month, CAST(count(*) AS BIGINT) AS Answers FROM v_answers GROUP BY ALL) a
LEFT JOIN
  (SELECT Location, strftime(Date, '%Y-%m') AS ym, CAST(sum(Beds) AS BIGINT) AS Beds FROM v_answers GROUP BY ALL) b
ON a.Location = b.Location AND strftime(a.Month + INTERVAL 1 MONTH, '%Y-%m') = b.ym""", dates=["Month"])
def j9(spark, sf):
    v = view(spark, sf, "v_answers")
    a = v.groupBy("Location", F.trunc("Date", "MM").alias("Month")).agg(F.count(F.lit(1)).cast("long").alias("Answers"))
    b = v.groupBy("Location", F.trunc("Date", "MM").alias("BMonth")).agg(F.sum("Beds").cast("long").alias("Beds"))
    return J.join_month_offset(a, b, "Location", "Month", "BMonth", 1).drop("BMonth")


@query("j10_state_as_of", oracle="""
SELECT p.Location, p.Month,
       max(CASE WHEN a.Answer = 'Yes' THEN 1 ELSE 0 END) AS Ever_Yes,
       CAST(count(a.Location) AS BIGINT) AS Answers_To_Date
FROM v_panel p LEFT JOIN v_answers a ON a.Location = p.Location AND a.Date <= last_day(p.Month)
GROUP BY p.Location, p.Month""", dates=["Month"])
def j10(spark, sf):
    panel = view(spark, sf, "v_panel")
    ans = view(spark, sf, "v_answers")
    return J.state_as_of(panel, ans, "Location", "Month", "Date", {
        "Ever_Yes": (F.when(F.col("Answer") == "Yes", 1).otherwise(0), "max"),
        "Answers_To_Date": (F.lit(1).cast("long"), "sum"),
    })


@query("j11_scalar", oracle="""
SELECT Area_Code, Adults, (SELECT sum(Size) FROM v_pop WHERE TRY_CAST(regexp_replace(Age, '\\+$', '') AS INTEGER) > 17) AS All_Adults,
       CAST(round_even(CAST(Adults AS DOUBLE) / (SELECT sum(Size) FROM v_pop WHERE TRY_CAST(regexp_replace(Age, '\\+$', '') AS INTEGER) > 17), 4) AS DOUBLE) AS Share
FROM (SELECT Area_Code, CAST(sum(Size) AS BIGINT) AS Adults FROM v_pop
      WHERE TRY_CAST(regexp_replace(Age, '\\+$', '') AS INTEGER) > 17 GROUP BY Area_Code) t""")
def j11(spark, sf):
    from strata.operators.filters import adult_population
    adults = adult_population(view(spark, sf, "v_pop"), "Age", 17)
    per = A.sum_by(adults, ["Area_Code"], ["Size"], names={"Size": "Adults"})
    out = J.with_scalar(per, "All_Adults", adults.select(F.sum("Size")))
    return out.withColumn("Share", C.ratio("Adults", "All_Adults", 4))


@query("j12_num_den", oracle="""
SELECT Report_Period_End, Practice_Code, CAST(sum(Value) FILTER (WHERE Field = 'R') AS DOUBLE) AS Numerator,
       CAST(sum(Value) FILTER (WHERE Field = 'N') AS DOUBLE) AS Denominator
FROM v_field WHERE Field IN ('R', 'N') GROUP BY ALL""", dates=["Report_Period_End"])
def j12(spark, sf):
    return J.num_den(view(spark, sf, "v_field"), ["Report_Period_End", "Practice_Code"], "Field", "Value", "R", "N")


@query("j13_semi", oracle="SELECT o_orderkey, Period FROM v_batch b WHERE Period IN (SELECT Period FROM v_hist)", dates=["Period"])
def j13(spark, sf):
    return J.exists_in(view(spark, sf, "v_batch").select("o_orderkey", "Period"), view(spark, sf, "v_hist"), ["Period"])


@query("j13_anti", oracle="SELECT o_orderkey, Period FROM v_batch b WHERE Period NOT IN (SELECT Period FROM v_hist)", dates=["Period"])
def j13b(spark, sf):
    return J.exists_in(view(spark, sf, "v_batch").select("o_orderkey", "Period"), view(spark, sf, "v_hist"), ["Period"], negate=True)


@query("j13_anti_pruned", oracle="SELECT o_orderkey, Period FROM v_batch b WHERE Period NOT IN (SELECT Period FROM v_hist)", dates=["Period"])
def j13c(spark, sf):
    """The same against a history in folders, of which only the files are read that may hold a period of the batch."""
    root = scratch_path(spark, "history")
    write_summarised(view(spark, sf, "v_hist"), root, F.date_format("Period", "yyyy-MM"), ["Period"])
    return unseen(view(spark, sf, "v_batch").select("o_orderkey", "Period"), root, ["Period"])


@query("j14_scaffold_fill", oracle="""
WITH cum AS (SELECT Date, OdsCode, CAST(sum(Clicks) OVER (PARTITION BY OdsCode ORDER BY Date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Cum_Clicks
             FROM (SELECT Date, OdsCode, sum(Clicks) AS Clicks FROM v_clicks GROUP BY ALL) t),
     ref AS (SELECT OdsCode, CAST(count(*) AS BIGINT) AS Events, max(Date) AS Snapshot FROM v_clicks GROUP BY OdsCode),
     grid AS (SELECT d.Date, r.OdsCode, r.Events, r.Snapshot FROM (SELECT DISTINCT Date FROM cum) d CROSS JOIN ref r)
SELECT coalesce(c.Date, g.Date) AS Date, coalesce(c.OdsCode, g.OdsCode) AS OdsCode, coalesce(c.Cum_Clicks, 0) AS Cum_Clicks,
       coalesce(g.Events, 0) AS Events, coalesce(g.Snapshot, (SELECT max(Snapshot) FROM ref)) AS Snapshot
FROM cum c FULL OUTER JOIN grid g ON c.Date = g.Date AND c.OdsCode = g.OdsCode""", dates=["Date", "Snapshot"])
def j14(spark, sf):
    v = view(spark, sf, "v_clicks")
    cum = W.cumsum_by(v, "OdsCode", "Date", "Clicks", name="Cum_Clicks")
    ref = v.groupBy("OdsCode").agg(F.count(F.lit(1)).cast("long").alias("Events"), F.max("Date").alias("Snapshot"))
    dates = cum.select("Date").distinct()
    grid = J.scaffold_dates(ref, dates, "Date")
    return J.scaffold_fill(cum.drop("Clicks"), grid, ["Date", "OdsCode"], ["Cum_Clicks", "Events"], {"Snapshot": "Snapshot"})


@query("j15_coverage", oracle="""
WITH m AS (SELECT s.Edition, c.c_nationkey AS ICB FROM v_status s JOIN customer c ON s.Code = c.c_custkey),
     cnt AS (SELECT Edition, ICB, CAST(count(*) AS BIGINT) AS n FROM m GROUP BY ALL)
SELECT g.Edition, g.ICB, coalesce(cnt.n, 0) AS n FROM
  ((SELECT DISTINCT Edition FROM m) e CROSS JOIN (SELECT n_nationkey AS ICB FROM nation) n2) g
  LEFT JOIN cnt ON g.Edition = cnt.Edition AND g.ICB = cnt.ICB""")
def j15(spark, sf):
    s = view(spark, sf, "v_status").select("Code", "Edition")
    c = table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    members = J.join_on(s, c, "Code", "c_custkey", "inner").select("Edition", F.col("c_nationkey").alias("ICB"))
    groups = table(spark, sf, "nation", ["n_nationkey"]).withColumnRenamed("n_nationkey", "ICB")
    return J.coverage_by_group(members, groups, "Edition", "ICB")


@query("j15_coverage_share", oracle="""
WITH m AS (SELECT s.Edition, s.Code, c.c_nationkey AS ICB FROM v_status s JOIN customer c ON s.Code = c.c_custkey),
     cnt AS (SELECT Edition, ICB, CAST(count(DISTINCT Code) AS BIGINT) AS n FROM m GROUP BY ALL),
     size AS (SELECT n.n_nationkey AS ICB, CAST(count(c.c_custkey) AS BIGINT) AS Members FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey GROUP BY 1)
SELECT e.Edition, s.ICB, s.Members, coalesce(cnt.n, 0) AS n, CAST(round_even(CAST(coalesce(cnt.n, 0) AS DOUBLE) / nullif(s.Members, 0), 4) AS DOUBLE) AS Share
FROM (SELECT DISTINCT Edition FROM m) e CROSS JOIN size s LEFT JOIN cnt ON cnt.Edition = e.Edition AND cnt.ICB = s.ICB""")
def j15b(spark, sf):
    """Submitted members beside all members of every group, per snapshot."""
    s = view(spark, sf, "v_status").select("Code", "Edition").distinct()
    c = table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    members = J.join_on(s, c, "Code", "c_custkey", "inner").select("Edition", F.col("c_nationkey").alias("ICB"))
    n = table(spark, sf, "nation", ["n_nationkey"]).withColumnRenamed("n_nationkey", "ICB")
    size = n.join(c.withColumnRenamed("c_nationkey", "ICB"), "ICB", "left").groupBy("ICB").agg(F.count("c_custkey").alias("Members"))
    from strata.functions import columns as C

    return J.coverage_by_group(members, size, "Edition", "ICB", size="Members").withColumn("Share", C.ratio("n", "Members", 4))


@query("j16_fiscal", oracle="""
WITH f AS (SELECT o_custkey % 10 AS Org, CASE WHEN month(o_orderdate) >= 4 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END AS fy,
                  CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS Activity FROM orders GROUP BY ALL),
     p AS (SELECT c_custkey % 10 AS Org, CAST(year(o.d) AS INTEGER) AS pyear, CAST(count(*) AS BIGINT) AS Population
           FROM customer c JOIN (SELECT o_custkey, min(o_orderdate) AS d FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
           GROUP BY ALL),
     p2 AS (SELECT Org, pyear AS fy, Population FROM p)
SELECT coalesce(f.Org, p2.Org) AS Org, f.Activity, p2.Population, coalesce(f.fy, p2.fy) AS FY_Start
FROM f FULL OUTER JOIN p2 ON f.Org = p2.Org AND f.fy = p2.fy""")
def j16(spark, sf):
    o = table(spark, sf, "orders")
    facts = o.groupBy((F.col("o_custkey") % 10).alias("Org"), C.fin_year_start("o_orderdate").alias("FY_Start")).agg(
        F.sum(F.floor(F.col("o_totalprice") / 1000)).cast("long").alias("Activity"))
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("d"))
    cust = table(spark, sf, "customer", ["c_custkey"]).join(first, F.col("c_custkey") == F.col("o_custkey"))
    # population extracts are dated 1 April of the year of each cohort's first order
    pop = cust.groupBy((F.col("c_custkey") % 10).alias("Org"), F.year("d").alias("y")).agg(
        F.count(F.lit(1)).cast("long").alias("Population")).withColumn("Extract_Date", F.make_date("y", F.lit(4), F.lit(1)))
    facts = facts.withColumn("Fact_Date", F.make_date("FY_Start", F.lit(6), F.lit(1)))
    out = J.join_fiscal_year(facts.drop("FY_Start"), pop.drop("y"), "Org", "Fact_Date", "Extract_Date", how="full")
    fy = F.coalesce(C.fin_year_start("Fact_Date"), C.fin_year_start("Extract_Date"))
    return out.select("Org", "Activity", "Population", fy.alias("FY_Start"))


@query("j17_hierarchy", oracle="""
SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name FROM supplier s
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def j17(spark, sf):
    s = table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = table(spark, sf, "region", ["r_regionkey", "r_name"])
    out = J.map_hierarchy(s, [(n, "s_nationkey", "n_nationkey"), (r, "n_regionkey", "r_regionkey")])
    return out.select("s_suppkey", "s_name", "n_name", "r_name")
