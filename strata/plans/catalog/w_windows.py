"""Time-series, window and resampling operators."""
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregates as A
from strata.operators import ordered as R
from strata.operators import timeseries as W
from strata.plans.registry import query
from strata.plans.standins import view
from strata.sources.tables import table

_MONTH_REV = "(SELECT strftime(Daily, '%Y-%m') AS Month, CAST(sum(Revenue) AS BIGINT) AS Revenue FROM v_monthly GROUP BY 1)"


@query("w1_rolling", oracle="""
SELECT Daily, Open, CASE WHEN count(Open) OVER w = 3 THEN avg(Open) OVER w END AS Open_Rolling_3 FROM v_monthly
WINDOW w AS (ORDER BY Daily ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", dates=["Daily"])
def w1(spark, sf):
    return W.rolling_mean(view(spark, sf, "v_monthly").select("Daily", "Open"), ["Daily"], "Open", 3, name="Open_Rolling_3")


@query("w1_rolling_rows", oracle="""
SELECT o_orderkey, o_totalprice, CASE WHEN count(o_totalprice) OVER w = 7 THEN avg(o_totalprice) OVER w END AS Mean_7 FROM orders
WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def w1_rows(spark, sf):
    """The rolling mean over all rows of a table, not one row per period: blocks with a halo."""
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return R.rolling(o, ["o_orderdate", "o_orderkey"], "o_totalprice", 7, "Mean_7").drop("o_orderdate")


@query("w3_cumsum_rows", oracle="""
SELECT o_orderkey, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Cum FROM orders""")
def w3_rows(spark, sf):
    """The global running sum over all rows: two levels, no single-partition window over the rows."""
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    return R.running(o, ["o_orderdate", "o_orderkey"], {"Cum": F.floor("o_totalprice").cast("long")}).select("o_orderkey", "Cum")


@query("w4_cumsum_rows", oracle="""
SELECT o_orderkey, o_orderstatus, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
  ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Cum FROM orders""")
def w4_rows(spark, sf):
    """Running sums of three entities that hold all rows: an entity spans as many buckets as its rows fill."""
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice"])
    out = R.running(o, ["o_orderdate", "o_orderkey"], {"Cum": F.floor("o_totalprice").cast("long")}, partition=["o_orderstatus"])
    return out.select("o_orderkey", "o_orderstatus", "Cum")


@query("w2_floor_fill", oracle="""
SELECT Daily, CAST(coalesce(floor(CASE WHEN count(Open) OVER w = 3 THEN avg(Open) OVER w END), 0) AS BIGINT) AS Open_SMA
FROM v_monthly WINDOW w AS (ORDER BY Daily ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", dates=["Daily"])
def w2(spark, sf):
    r = W.rolling_mean(view(spark, sf, "v_monthly").select("Daily", "Open"), ["Daily"], "Open", 3, name="r")
    return r.select("Daily", C.floor_fill("r").alias("Open_SMA"))


@query("w3_cumsum", oracle=f"""
SELECT Month, Revenue, CAST(sum(Revenue) OVER (ORDER BY Month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Cum_Revenue FROM {_MONTH_REV}""")
def w3(spark, sf):
    m = A.monthly_sum(view(spark, sf, "v_monthly"), "Daily", ["Revenue"])
    return W.cumsum(m, ["Month"], ["Revenue"], names={"Revenue": "Cum_Revenue"})


@query("w4_cumsum_by", oracle="""
SELECT OdsCode, Date, Clicks, CAST(sum(Clicks) OVER (PARTITION BY OdsCode ORDER BY Date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Cum_Clicks
FROM (SELECT OdsCode, Date, CAST(coalesce(sum(Clicks), 0) AS BIGINT) AS Clicks FROM v_clicks GROUP BY ALL) t""", dates=["Date"])
def w4(spark, sf):
    return W.cumsum_by(view(spark, sf, "v_clicks"), "OdsCode", "Date", "Clicks", name="Cum_Clicks")


@query("w5_dense_cumsum", oracle="""
WITH d AS (SELECT OdsCode, Date, sum(Clicks) AS Clicks FROM v_clicks GROUP BY ALL),
     s AS (SELECT OdsCode, min(Date) AS first FROM d GROUP BY OdsCode),
     g AS (SELECT s.OdsCode, CAST(unnest(generate_series(s.first, (SELECT max(Date) FROM d), INTERVAL 1 DAY)) AS DATE) AS Date FROM s)
SELECT g.OdsCode, g.Date, CAST(sum(coalesce(d.Clicks, 0)) OVER (PARTITION BY g.OdsCode ORDER BY g.Date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS Cum_Clicks
FROM g LEFT JOIN d ON g.OdsCode = d.OdsCode AND g.Date = d.Date""", dates=["Date"])
def w5(spark, sf):
    v = view(spark, sf, "v_clicks")
    return W.dense_cumsum(v, "OdsCode", "Date", "Clicks", name="Cum_Clicks")


@query("w6_group_count", oracle="""
SELECT o_orderkey, Location, CAST(count(Answer) OVER (PARTITION BY Location) AS BIGINT) AS Answered FROM v_answers""")
def w6(spark, sf):
    return W.n_in_group(view(spark, sf, "v_answers").select("o_orderkey", "Location", "Answer"), ["Location"], "Answer", "Answered").drop("Answer")


@query("w7_any_flag", oracle="""
SELECT o_orderkey, Location, Month, max(CASE WHEN Answer = 'Yes' THEN 1 ELSE 0 END) OVER (PARTITION BY Location, Month) AS Any_Yes
FROM (SELECT *, CAST(date_trunc('month', Date) AS DATE) AS Month FROM v_answers) t""", dates=["Month"])
def w7(spark, sf):
    v = view(spark, sf, "v_answers").select("o_orderkey", "Location", F.trunc("Date", "MM").alias("Month"), "Answer")
    return W.any_flag(v, ["Location", "Month"], F.col("Answer") == "Yes", "Any_Yes").drop("Answer")


@query("w8_latest_flag", oracle="""
SELECT o_orderkey, Location, Date, CASE WHEN Date = max(Date) OVER (PARTITION BY Location) THEN 1 ELSE 0 END AS Latest FROM v_answers""",
       dates=["Date"])
def w8(spark, sf):
    return W.latest_flag(view(spark, sf, "v_answers").select("o_orderkey", "Location", "Date"), ["Location"], "Date", "Latest")


@query("w9_last_per", oracle="""
SELECT Location, o_orderkey, Date, Type, Answer FROM (
  SELECT *, row_number() OVER (PARTITION BY Location ORDER BY Date DESC, o_orderkey DESC) AS rn FROM v_answers) t WHERE rn = 1""",
       dates=["Date"])
def w9(spark, sf):
    v = view(spark, sf, "v_answers").select("Location", "o_orderkey", "Date", "Type", "Answer")
    return W.last_per(v, ["Location"], ["Date", "o_orderkey"])


@query("w10_two_stage", oracle="""
WITH s1 AS (SELECT * FROM (SELECT Location, Type, Date, o_orderkey, Answer,
              row_number() OVER (PARTITION BY Location, Type ORDER BY Date DESC, o_orderkey DESC) AS rn FROM v_answers) t WHERE rn = 1)
SELECT Location, Type, Date, o_orderkey, Answer FROM (SELECT *, row_number() OVER (PARTITION BY Location
  ORDER BY Answer DESC NULLS FIRST, Date DESC, o_orderkey DESC) AS rn2 FROM s1) t WHERE rn2 = 1""", dates=["Date"])
def w10(spark, sf):
    v = view(spark, sf, "v_answers").select("Location", "Type", "Date", "o_orderkey", "Answer")
    return W.reduce_answers(v, "Location", "Type", "Date", "Answer", tiebreak=["o_orderkey"])


def _resample_sql(freq_label: str, step: str, src: str, measures: list[str], date: str, name: str):
    sums = ", ".join(f"sum({m}) AS {m}" for m in measures)
    cols = ", ".join(f"CAST(coalesce(a.{m}, 0) AS BIGINT) AS {m}" for m in measures)
    return f"""
WITH a AS (SELECT {freq_label.format(d=date)} AS p, {sums} FROM {src} WHERE {date} IS NOT NULL GROUP BY 1),
     c AS (SELECT CAST(unnest(generate_series((SELECT min(p) FROM a), (SELECT max(p) FROM a), INTERVAL {step})) AS DATE) AS p)
SELECT c.p AS {name}, {cols} FROM c LEFT JOIN a ON c.p = a.p"""


@query("w11_month_start", oracle=_resample_sql("CAST(date_trunc('month', {d}) AS DATE)", "1 MONTH", "v_monthly",
                                               ["Revenue", "Open"], "Daily", "Month"), dates=["Month"])
def w11(spark, sf):
    return W.resample(view(spark, sf, "v_monthly"), "Daily", ["Revenue", "Open"], "MS", name="Month")


@query("w12_month_end", oracle="""
WITH a AS (SELECT last_day(Daily) AS p, sum(Revenue) AS Revenue FROM v_monthly WHERE Daily IS NOT NULL GROUP BY 1),
     c AS (SELECT last_day(CAST(unnest(generate_series((SELECT date_trunc('month', min(p)) FROM a), (SELECT date_trunc('month', max(p)) FROM a), INTERVAL 1 MONTH)) AS DATE)) AS p)
SELECT c.p AS Month_End, CAST(coalesce(a.Revenue, 0) AS BIGINT) AS Revenue FROM c LEFT JOIN a ON c.p = a.p""", dates=["Month_End"])
def w12(spark, sf):
    return W.resample(view(spark, sf, "v_monthly"), "Daily", ["Revenue"], "ME", name="Month_End")


@query("w13_week", oracle=_resample_sql("CAST({d} + ((7 - isodow({d})) % 7) * INTERVAL 1 DAY AS DATE)", "7 DAY", "v_clicks",
                                        ["Clicks"], "Date", "Week_Ending"), dates=["Week_Ending"])
def w13(spark, sf):
    return W.resample(view(spark, sf, "v_clicks"), "Date", ["Clicks"], "W", name="Week_Ending")


@query("w14_day", oracle=_resample_sql("CAST({d} AS DATE)", "1 DAY", "(SELECT _time, 1 AS Acks FROM v_acks)", ["Acks"], "_time", "Day"),
       dates=["Day"])
def w14(spark, sf):
    v = view(spark, sf, "v_acks").select("_time", F.lit(1).alias("Acks"))
    return W.resample(v, "_time", ["Acks"], "D", name="Day")


@query("w15_bucket_last", oracle="""
SELECT least(last_day(CAST(_time AS DATE)), (SELECT CAST(max(_time) AS DATE) FROM v_acks)) AS Date, workflow, CAST(sum(1) AS BIGINT) AS Messages
FROM v_acks GROUP BY ALL""", dates=["Date"])
def w15(spark, sf):
    v = view(spark, sf, "v_acks").withColumn("Messages", F.lit(1).cast("long"))
    return W.month_bucket_truncated_last(v, "_time", ["workflow"], ["Messages"], name="Date")


_FIRST_MONTH = """(SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS m FROM orders GROUP BY o_custkey)"""


@query("w16_fill_months", oracle=f"""
WITH a AS (SELECT m AS Month, CAST(count(*) AS BIGINT) AS New_Customers FROM {_FIRST_MONTH} f GROUP BY m),
     c AS (SELECT CAST(unnest(generate_series((SELECT min(Month) FROM a), (SELECT max(Month) FROM a), INTERVAL 1 MONTH)) AS DATE) AS Month)
SELECT c.Month, coalesce(a.New_Customers, 0) AS New_Customers FROM c LEFT JOIN a ON c.Month = a.Month""", dates=["Month"])
def w16(spark, sf):
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.trunc(F.min("o_orderdate"), "MM").alias("Month"))
    return W.fill_months(A.count_by(first, ["Month"], name="New_Customers"), "Month", ["New_Customers"])


@query("w17_new_cum", oracle=f"""
WITH a AS (SELECT m AS Month, CAST(count(*) AS BIGINT) AS new FROM {_FIRST_MONTH} f GROUP BY m),
     c AS (SELECT CAST(unnest(generate_series((SELECT min(Month) FROM a), (SELECT max(Month) FROM a), INTERVAL 1 MONTH)) AS DATE) AS Month)
SELECT c.Month, coalesce(a.new, 0) AS new, CAST(sum(coalesce(a.new, 0)) OVER (ORDER BY c.Month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative
FROM c LEFT JOIN a ON c.Month = a.Month""", dates=["Month"])
def w17(spark, sf):
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("First_Order"))
    return W.new_and_cumulative(first, "First_Order")
