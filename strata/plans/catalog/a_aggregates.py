"""Aggregations."""
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import filters as FL
from strata.plans.registry import query
from strata.plans.standins import view

ACK_CATS = ["TOC_FHIR_EC_DISCH_ACK", "TOC_FHIR_IP_DISCH_ACK", "TOC_FHIR_MH_DISCH_ACK", "TOC_FHIR_OP_ATTEN_ACK"]


@query("a1_sum_by", oracle="""
SELECT Date, OdsCode, CAST(coalesce(sum(Clicks), 0) AS BIGINT) AS Clicks FROM v_clicks
WHERE Date IS NOT NULL AND OdsCode IS NOT NULL GROUP BY Date, OdsCode""", dates=["Date"])
def a1(spark, sf):
    return A.sum_by(view(spark, sf, "v_clicks"), ["Date", "OdsCode"], "Clicks")


@query("a2_monthly_sum", oracle="""
SELECT strftime(Daily, '%Y-%m') AS Month, CAST(coalesce(sum(Revenue), 0) AS BIGINT) AS Revenue,
       CAST(coalesce(sum(Orders), 0) AS BIGINT) AS Orders, CAST(coalesce(sum(Open), 0) AS BIGINT) AS Open
FROM v_monthly WHERE Daily IS NOT NULL GROUP BY 1""")
def a2(spark, sf):
    return A.monthly_sum(view(spark, sf, "v_monthly"), "Daily", ["Revenue", "Orders", "Open"])


@query("a3_count_by", oracle="""
SELECT Edition, Status, CAST(count(*) AS BIGINT) AS n FROM v_status WHERE Edition IS NOT NULL AND Status IS NOT NULL GROUP BY ALL""")
def a3(spark, sf):
    return A.count_by(view(spark, sf, "v_status"), ["Edition", "Status"], name="n")


@query("a4_mixed", oracle="""
SELECT Practice_Code, CAST(coalesce(sum(Submissions), 0) AS BIGINT) AS Submissions, max(Practice_Population) AS Population,
       CAST(count(Supplier) AS BIGINT) AS With_Supplier, CAST(count(*) AS BIGINT) AS Weeks
FROM v_weekly WHERE Practice_Code IS NOT NULL GROUP BY Practice_Code""")
def a4(spark, sf):
    return A.agg_by(view(spark, sf, "v_weekly"), ["Practice_Code"], [
        ("sum", "Submissions", "Submissions"), ("max", "Practice_Population", "Population"),
        ("count", "Supplier", "With_Supplier"), ("size", "Practice_Code", "Weeks")])


@query("a5_cond_counts", oracle="""
SELECT Type, Year, Yes, No, Answered, CAST(round_even(CAST(Yes AS DOUBLE) / nullif(Answered, 0), 4) AS DOUBLE) AS Pct_Yes FROM (
  SELECT Type, year(Date) AS Year, CAST(count_if(Answer = 'Yes') AS BIGINT) AS Yes, CAST(count_if(Answer = 'No') AS BIGINT) AS No,
         CAST(count(Answer) AS BIGINT) AS Answered FROM v_answers GROUP BY Type, year(Date)) t""")
def a5(spark, sf):
    v = view(spark, sf, "v_answers").withColumn("Year", F.year("Date"))
    return A.cond_counts(v, ["Type", "Year"], "Answer", {"Yes": "Yes", "No": "No"}, answered="Answered",
                         pct={"Pct_Yes": ("Yes", "Answered")})


@query("a6_coverage", oracle="""
SELECT ICB_Name, Total, Connected, CAST(round_even(CAST(Connected AS DOUBLE) / Total, 4) AS DOUBLE) AS Percent FROM (
  SELECT ICB_Name, CAST(count(*) AS BIGINT) AS Total, CAST(sum(CASE WHEN Close_Date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS Connected
  FROM v_org GROUP BY ICB_Name) t""")
def a6(spark, sf):
    v = view(spark, sf, "v_org").withColumn("open_flag", F.when(F.col("Close_Date").isNull(), 1).otherwise(0))
    return A.coverage(v, ["ICB_Name"], "open_flag")


@query("a7_headline", oracle="""
SELECT 'Customer' AS Org_Type, '2001-06' AS Period, CAST(count(*) AS BIGINT) AS Orgs,
       CAST(count_if(Close_Date IS NULL) AS BIGINT) AS Active,
       CAST(round_even(CAST(count_if(Close_Date IS NULL) AS DOUBLE) / count(*), 4) AS DOUBLE) AS Pct_Active FROM v_org""")
def a7(spark, sf):
    act = F.count_if(F.col("Close_Date").isNull())
    return A.headline_row(view(spark, sf, "v_org"), [
        F.count(F.lit(1)).cast("long").alias("Orgs"), act.cast("long").alias("Active"),
        F.bround(act / F.count(F.lit(1)), 4).alias("Pct_Active")], {"Org_Type": "Customer", "Period": "2001-06"})


@query("a8_two_level", oracle="""
SELECT workflow, Month, CAST(sum(floor(n / 2)) AS BIGINT) AS Pairs FROM (
  SELECT strftime(_time, '%Y-%m') AS Month, workflow, senderOdsCode, recipientOdsCode, count(*) AS n
  FROM v_acks WHERE regexp_matches(workflow, 'ACK') GROUP BY ALL) t GROUP BY workflow, Month""")
def a8(spark, sf):
    v = FL.contains(view(spark, sf, "v_acks"), "workflow", "ACK").withColumn("Month", F.date_format("_time", "yyyy-MM"))
    return A.paired_ack_count(v, ["Month", "workflow", "senderOdsCode", "recipientOdsCode"], ["workflow", "Month"], name="Pairs")


@query("a9_share", oracle="""
SELECT Edition, Status, n, CAST(round_even(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY Edition), 4) AS DOUBLE) AS share FROM (
  SELECT Edition, Status, CAST(count(*) AS BIGINT) AS n FROM v_status GROUP BY ALL) t""")
def a9(spark, sf):
    return A.share_within(view(spark, sf, "v_status"), ["Edition"], ["Status"], name="n")


@query("a10_distinct", oracle="""
SELECT Date, CAST(count(DISTINCT OdsCode) AS BIGINT) AS n_unique FROM v_clicks GROUP BY Date""", dates=["Date"])
def a10(spark, sf):
    return A.n_unique(view(spark, sf, "v_clicks"), "OdsCode", keys=["Date"])


@query("a11_scalar", oracle="""
SELECT min(Clicks) AS min_Clicks, max(Clicks) AS max_Clicks, CAST(sum(Clicks) AS BIGINT) AS sum_Clicks,
       CAST(count(Clicks) AS BIGINT) AS count_Clicks FROM v_clicks""")
def a11(spark, sf):
    return A.scalar_agg(view(spark, sf, "v_clicks"), "Clicks")


@query("a12_column_totals", oracle="""
SELECT * FROM (SELECT CAST(sum(Orders) AS DOUBLE) AS Orders, CAST(sum(Revenue) AS DOUBLE) AS Revenue,
  CAST(sum(Fulfilled) AS DOUBLE) AS Fulfilled, CAST(sum(Open) AS DOUBLE) AS Open, CAST(sum(Pending) AS DOUBLE) AS Pending FROM v_monthly)
UNPIVOT (total FOR "column" IN (Orders, Revenue, Fulfilled, Open, Pending))""")
def a12(spark, sf):
    return A.column_totals(view(spark, sf, "v_monthly"), ["Orders", "Revenue", "Fulfilled", "Open", "Pending"])


@query("a13_pivot", oracle="""
SELECT Date, coalesce(P0, 0) AS P0, coalesce(P1, 0) AS P1, coalesce(P2, 0) AS P2, coalesce(P9, 0) AS P9 FROM (
  SELECT Date, CAST(sum(Clicks) FILTER (WHERE Provider = 'P0') AS BIGINT) AS P0,
         CAST(sum(Clicks) FILTER (WHERE Provider = 'P1') AS BIGINT) AS P1,
         CAST(sum(Clicks) FILTER (WHERE Provider = 'P2') AS BIGINT) AS P2,
         CAST(sum(Clicks) FILTER (WHERE Provider = 'P9') AS BIGINT) AS P9
  FROM v_clicks WHERE Date IS NOT NULL GROUP BY Date) t""", dates=["Date"])
def a13(spark, sf):
    return A.pivot_sum(view(spark, sf, "v_clicks"), ["Date"], "Provider", "Clicks", ["P0", "P1", "P2", "P9"])


@query("a14_pivot_multi", oracle="""
SELECT Date, coalesce(Clicks_P1, 0) AS Clicks_P1, coalesce(Events_P1, 0) AS Events_P1,
       coalesce(Clicks_P2, 0) AS Clicks_P2, coalesce(Events_P2, 0) AS Events_P2 FROM (
  SELECT Date, CAST(sum(Clicks) FILTER (WHERE Provider = 'P1') AS BIGINT) AS Clicks_P1,
         CAST(sum(1) FILTER (WHERE Provider = 'P1') AS BIGINT) AS Events_P1,
         CAST(sum(Clicks) FILTER (WHERE Provider = 'P2') AS BIGINT) AS Clicks_P2,
         CAST(sum(1) FILTER (WHERE Provider = 'P2') AS BIGINT) AS Events_P2
  FROM v_clicks GROUP BY Date) t""", dates=["Date"])
def a14(spark, sf):
    v = view(spark, sf, "v_clicks").withColumn("Events", F.lit(1).cast("long"))
    return A.pivot_multi(v, ["Date"], "Provider", ["Clicks", "Events"], ["P1", "P2"])


@query("a15_pivot_mean", oracle="""
SELECT Date, avg(Clicks) FILTER (WHERE JumpOff = 'viewCarePlans') AS viewCarePlans,
       avg(Clicks) FILTER (WHERE JumpOff = 'clickCarePlans') AS clickCarePlans
FROM v_clicks GROUP BY Date""", dates=["Date"])
def a15(spark, sf):
    return A.pivot_sum(view(spark, sf, "v_clicks"), ["Date"], "JumpOff", "Clicks", ["viewCarePlans", "clickCarePlans"],
                       fill=None, agg="mean")


@query("a16_duplicates", oracle="""
SELECT a.Location, a.Date, a.o_orderkey, d.n FROM v_answers a JOIN
  (SELECT Location, Date, CAST(count(*) AS BIGINT) AS n FROM v_answers GROUP BY ALL HAVING count(*) > 1) d
  ON a.Location = d.Location AND a.Date = d.Date""", dates=["Date"])
def a16(spark, sf):
    return A.duplicates(view(spark, sf, "v_answers").select("Location", "Date", "o_orderkey"), ["Location", "Date"])


@query("a17_impute", oracle="""
SELECT Reporting_Period_Start, Primary_Level, Measure_Value_Str,
       CASE WHEN Measure_Value_Str = '*' THEN
         ((SELECT sum(Measure_Value) FROM v_mh WHERE Breakdown = 'England') -
          (SELECT sum(TRY_CAST(Measure_Value_Str AS DOUBLE)) FROM v_mh WHERE Breakdown = 'Provider' AND Measure_Value_Str <> '*')) /
          (SELECT count(*) FROM v_mh WHERE Breakdown = 'Provider' AND Measure_Value_Str = '*')
       ELSE TRY_CAST(Measure_Value_Str AS DOUBLE) END AS Value
FROM v_mh WHERE Breakdown = 'Provider'""", dates=["Reporting_Period_Start"])
def a17(spark, sf):
    v = view(spark, sf, "v_mh")
    national = v.filter(F.col("Breakdown") == "England").select(F.sum("Measure_Value").cast("double")).scalar()
    prov = v.filter(F.col("Breakdown") == "Provider").select("Reporting_Period_Start", "Primary_Level", "Measure_Value_Str")
    return A.impute_suppressed(prov, "Measure_Value_Str", national, name="Value")


@query("a18_flag", oracle="""
SELECT DISTINCT Report_Period_End, Practice_Code, System_Supplier,
       CASE WHEN contains(System_Supplier, 'EMIS') THEN 1 ELSE 0 END AS flag FROM v_field""", dates=["Report_Period_End"])
def a18(spark, sf):
    return A.supplier_flag(view(spark, sf, "v_field"), ["Report_Period_End", "Practice_Code"], "System_Supplier", "EMIS")


@query("a19_totals", oracle="""
SELECT OdsCode, max(Clicks) AS Peak_Clicks, CAST(sum(Clicks) AS BIGINT) AS Clicks FROM v_clicks GROUP BY OdsCode""")
def a19(spark, sf):
    v = view(spark, sf, "v_clicks").withColumn("Peak_Clicks", F.col("Clicks"))
    return A.totals_by_org(v, ["OdsCode"], stock=["Peak_Clicks"], flow=["Clicks"])


@query("a20_month_wide", oracle="""
SELECT CAST(date_trunc('month', Discharge_Date) AS DATE) AS Month, Provider_Code, CAST(sum(Discharges) AS BIGINT) AS Discharges
FROM v_denominator GROUP BY Month, Provider_Code""", dates=["Month"])
def a20(spark, sf):
    return A.month_wide(view(spark, sf, "v_denominator"), "Discharge_Date", ["Provider_Code"], ["Discharges"])
