"""Usage and channel metric families."""
from pyspark.sql import functions as F

from strata.plans import families as fam
from strata.plans.registry import query
from strata.plans.standins import view

_COERCE = "coalesce(TRY_CAST({c} AS DOUBLE), 0.0)"


@query("m01_daily_measure", oracle=f"""
SELECT Date, Practice_code, Logins, CAST(row_number() OVER (ORDER BY Date, Practice_code) - 1 AS BIGINT) AS Unique_ID FROM
 (SELECT Date, OdsCode AS Practice_code, coalesce(sum({_COERCE.format(c='Logins')}), 0) AS Logins FROM v_usage_wide
  WHERE Date IS NOT NULL AND OdsCode IS NOT NULL GROUP BY ALL) t""", dates=["Date"])
def m01(spark, sf):
    return fam.daily_measure(view(spark, sf, "v_usage_wide"), "Logins")


@query("m02_cum_by_org", oracle=f"""
SELECT OdsCode, Date, P9NewAppUsers, sum(P9NewAppUsers) OVER (PARTITION BY OdsCode ORDER BY Date ROWS UNBOUNDED PRECEDING) AS Cumulative FROM
 (SELECT OdsCode, Date, coalesce(sum({_COERCE.format(c='P9NewAppUsers')}), 0) AS P9NewAppUsers FROM v_usage_wide GROUP BY ALL) t""",
       dates=["Date"])
def m02(spark, sf):
    return fam.cum_by_org(view(spark, sf, "v_usage_wide"), "P9NewAppUsers")


@query("m03_dense_cum", oracle=f"""
WITH d AS (SELECT OdsCode, Date, sum({_COERCE.format(c='Prescriptions')}) AS v FROM v_usage_wide GROUP BY ALL),
     s AS (SELECT OdsCode, min(Date) AS first FROM d GROUP BY OdsCode),
     g AS (SELECT s.OdsCode, CAST(unnest(generate_series(s.first, (SELECT max(Date) FROM d), INTERVAL 1 DAY)) AS DATE) AS Date FROM s)
SELECT g.OdsCode, g.Date, sum(coalesce(d.v, 0)) OVER (PARTITION BY g.OdsCode ORDER BY g.Date ROWS UNBOUNDED PRECEDING) AS Cumulative
FROM g LEFT JOIN d ON g.OdsCode = d.OdsCode AND g.Date = d.Date""", dates=["Date"])
def m03(spark, sf):
    return fam.dense_cum(view(spark, sf, "v_usage_wide"), "Prescriptions")


@query("m04_uptake_scaffold", oracle=f"""
WITH cum AS (SELECT Date, OdsCode AS Practice, sum(v) OVER (PARTITION BY OdsCode ORDER BY Date ROWS UNBOUNDED PRECEDING) AS Cumulative FROM
               (SELECT Date, OdsCode, coalesce(sum({_COERCE.format(c='P9NewAppUsers')}), 0) AS v FROM v_usage_wide GROUP BY ALL) t),
     ref AS (SELECT GP_Practice_Code AS Practice, CAST(sum(Size) AS BIGINT) AS Population, max(Effective_Snapshot_Date) AS Snapshot
             FROM v_gp_pop WHERE TRY_CAST(regexp_replace(AGE, '\\+$', '') AS INTEGER) > 12 GROUP BY 1),
     grid AS (SELECT d.Date, r.* FROM (SELECT DISTINCT Date FROM cum) d CROSS JOIN ref r)
SELECT coalesce(c.Date, g.Date) AS Date, coalesce(c.Practice, g.Practice) AS Practice, coalesce(c.Cumulative, 0) AS Cumulative,
       coalesce(g.Population, 0) AS Population, coalesce(g.Snapshot, (SELECT max(Snapshot) FROM ref)) AS Snapshot
FROM cum c FULL OUTER JOIN grid g ON c.Date = g.Date AND c.Practice = g.Practice""", dates=["Date", "Snapshot"])
def m04(spark, sf):
    return fam.uptake_scaffold(view(spark, sf, "v_usage_wide"), view(spark, sf, "v_gp_pop"), "P9NewAppUsers")


@query("m05_weekly_pct", oracle=f"""
WITH a AS (SELECT CAST(Date + ((7 - isodow(Date)) % 7) * INTERVAL 1 DAY AS DATE) AS p, sum({_COERCE.format(c='Logins')}) AS v
           FROM v_usage_wide GROUP BY 1),
     c AS (SELECT CAST(unnest(generate_series((SELECT min(p) FROM a), (SELECT max(p) FROM a), INTERVAL 7 DAY)) AS DATE) AS p),
     w AS (SELECT c.p AS Week_Ending, coalesce(a.v, 0) AS v FROM c LEFT JOIN a ON c.p = a.p),
     den AS (SELECT CAST(sum(Size) AS BIGINT) AS d FROM v_gp_pop WHERE Effective_Snapshot_Date = (SELECT max(Effective_Snapshot_Date) FROM v_gp_pop)
             AND TRY_CAST(regexp_replace(AGE, '\\+$', '') AS INTEGER) > 17)
SELECT Week_Ending, sum(v) OVER (ORDER BY Week_Ending ROWS UNBOUNDED PRECEDING) AS Users, (SELECT d FROM den) AS Adult_Population,
       CAST(round_even(sum(v) OVER (ORDER BY Week_Ending ROWS UNBOUNDED PRECEDING) / (SELECT d FROM den), 4) AS DOUBLE) AS Share FROM w""",
       dates=["Week_Ending"])
def m05(spark, sf):
    return fam.weekly_pct(view(spark, sf, "v_usage_wide"), view(spark, sf, "v_gp_pop"), "Logins")


_PROV, _SERV = ["P1", "P1Cie", "P3"], ["viewCarePlans", "clickMedicalRecord"]


@query("m06_clicks", oracle="""
SELECT Provider, Date, OdsCode, CAST(sum(Clicks) AS BIGINT) AS Clicks FROM v_clicks
WHERE Provider IN ('P1', 'P1Cie', 'P3') AND JumpOff IN ('viewCarePlans', 'clickMedicalRecord') GROUP BY ALL
HAVING Date >= DATE '2024-01-08'""", dates=["Date"])
def m06(spark, sf):
    return fam.clicks(view(spark, sf, "v_clicks"), _PROV, _SERV, cutoff="2024-01-08")


@query("m06_clicks_uncut", oracle="""
SELECT Provider, Date, OdsCode, CAST(sum(Clicks) AS BIGINT) AS Clicks FROM v_clicks
WHERE Provider IN ('P1', 'P1Cie', 'P3') AND JumpOff IN ('viewCarePlans', 'clickMedicalRecord') GROUP BY ALL""", dates=["Date"])
def m06b(spark, sf):
    return fam.clicks(view(spark, sf, "v_clicks"), _PROV, _SERV, cutoff="2024-01-08", apply_cutoff=False)


@query("m07_clicks_dynamic", oracle="""
WITH x AS (SELECT Date, OdsCode, replace(Provider, 'Cie', '') AS Provider, JumpOff, sum(Clicks) AS Clicks FROM v_clicks GROUP BY ALL),
     y AS (SELECT *, regexp_replace(JumpOff, '(\\w)([A-Z])', '\\1 \\2', 'g') AS s FROM x)
SELECT least(last_day(Date), (SELECT max(Date) FROM v_clicks)) AS Date, OdsCode, Provider,
       upper(substr(s, 1, 1)) || lower(substr(s, 2)) AS Service, CAST(sum(Clicks) AS BIGINT) AS Clicks FROM y GROUP BY ALL""",
       dates=["Date"])
def m07(spark, sf):
    return fam.clicks_dynamic(view(spark, sf, "v_clicks"))


@query("m08_downloads", oracle="SELECT Date AS Week_Date, Type AS Device, CAST(Count AS BIGINT) AS Downloads FROM v_downloads",
       dates=["Week_Date"])
def m08(spark, sf):
    return fam.typed_passthrough(view(spark, sf, "v_downloads"), {"Date": "Week_Date", "Type": "Device", "Count": "Downloads"},
                                 {"Downloads": "long"})


@query("m09_month_rollup", oracle="""
SELECT strftime(Daily, '%Y-%m') AS Month, CAST(coalesce(sum(Revenue), 0) AS BIGINT) AS Revenue FROM v_monthly GROUP BY 1""")
def m09(spark, sf):
    return fam.month_rollup(view(spark, sf, "v_monthly"), "Daily", ["Revenue"])


@query("m10_month_combined", oracle="""
SELECT Month, Fulfilled, Open, Pending, coalesce(Fulfilled, 0) + coalesce(Open, 0) + coalesce(Pending, 0) AS Total,
       Fulfilled + Open AS Fulfilled_Plus_Open FROM
 (SELECT strftime(Daily, '%Y-%m') AS Month, CAST(sum(Fulfilled) AS BIGINT) AS Fulfilled, CAST(sum(Open) AS BIGINT) AS Open,
         CAST(sum(Pending) AS BIGINT) AS Pending FROM v_monthly GROUP BY 1) t""")
def m10(spark, sf):
    return fam.month_combined(view(spark, sf, "v_monthly"), "Daily", ["Fulfilled", "Open", "Pending"], strict="Fulfilled_Plus_Open")


@query("m11_month_project", oracle="""
SELECT Daily AS Date, Orders AS Total_Orders, coalesce(Open, 0) AS Open FROM v_monthly""", dates=["Date"])
def m11(spark, sf):
    return fam.month_project(view(spark, sf, "v_monthly"), ["Daily", "Orders", "Open"], {"Daily": "Date", "Orders": "Total_Orders"}, ["Open"])


@query("m12_month_ratio", oracle="""
SELECT Month, Fulfilled, Orders, CAST(round_even(CAST(Fulfilled AS DOUBLE) / nullif(Orders, 0), 4) AS DOUBLE) AS Ratio FROM
 (SELECT strftime(Daily, '%Y-%m') AS Month, CAST(coalesce(sum(Fulfilled), 0) AS BIGINT) AS Fulfilled,
         CAST(coalesce(sum(Orders), 0) AS BIGINT) AS Orders FROM v_monthly GROUP BY 1) t""")
def m12(spark, sf):
    return fam.month_ratio(view(spark, sf, "v_monthly"), "Daily", "Fulfilled", "Orders")


@query("m13_channel_shift", oracle="""
WITH a AS (SELECT strftime(Daily, '%Y-%m') AS Month, CAST(coalesce(sum(Fulfilled), 0) AS BIGINT) AS App FROM v_monthly GROUP BY 1),
     t0 AS (SELECT last_day(Discharge_Date) AS p, sum(Discharges) AS v FROM v_denominator GROUP BY 1),
     c AS (SELECT last_day(CAST(unnest(generate_series((SELECT date_trunc('month', min(p)) FROM t0), (SELECT date_trunc('month', max(p)) FROM t0), INTERVAL 1 MONTH)) AS DATE)) AS p),
     t AS (SELECT strftime(c.p, '%Y-%m') AS Month, CAST(coalesce(t0.v, 0) AS BIGINT) AS "All" FROM c LEFT JOIN t0 ON c.p = t0.p)
SELECT a.Month, a.App, t."All", t."All" - a.App AS Offline,
       CAST(round_even(CASE WHEN t."All" = 0 AND a.App <> 0 THEN 0.0 ELSE CAST(a.App AS DOUBLE) / nullif(t."All", 0) END, 4) AS DOUBLE) AS App_Share
FROM a JOIN t ON a.Month = t.Month""")
def m13(spark, sf):
    return fam.channel_shift(view(spark, sf, "v_monthly"), view(spark, sf, "v_denominator"), "Daily", "Fulfilled",
                             "Discharge_Date", "Discharges")


@query("m14_month_start", oracle="""
WITH a AS (SELECT CAST(date_trunc('month', Daily) AS DATE) AS p, sum(Revenue) AS v FROM v_monthly GROUP BY 1),
     c AS (SELECT CAST(unnest(generate_series((SELECT min(p) FROM a), (SELECT max(p) FROM a), INTERVAL 1 MONTH)) AS DATE) AS p)
SELECT c.p AS Month, CAST(coalesce(a.v, 0) AS BIGINT) AS Revenue, 44715443.0 AS Population,
       CAST(round_even(coalesce(a.v, 0) / 44715443.0, 4) AS DOUBLE) AS Share FROM c LEFT JOIN a ON c.p = a.p""", dates=["Month"])
def m14(spark, sf):
    return fam.month_start_pct(view(spark, sf, "v_monthly"), "Daily", "Revenue", 44715443.0)


@query("m15_actuals", oracle="""
WITH m AS (SELECT strftime(Daily, '%Y-%m') AS Month, CAST(sum(Revenue) AS BIGINT) AS Revenue FROM v_monthly GROUP BY 1),
     d AS (SELECT strftime(Discharge_Date, '%Y-%m') AS Month, CAST(sum(Discharges) AS BIGINT) AS Discharges FROM v_denominator GROUP BY 1),
     g AS (SELECT strftime(Date, '%Y-%m') AS Month, CAST(sum(Count) AS BIGINT) AS Messages FROM v_messages GROUP BY 1)
SELECT coalesce(m.Month, d.Month, g.Month) AS Month, m.Revenue, d.Discharges, g.Messages
FROM m FULL OUTER JOIN d ON m.Month = d.Month FULL OUTER JOIN g ON coalesce(m.Month, d.Month) = g.Month""")
def m15(spark, sf):
    m = fam.month_rollup(view(spark, sf, "v_monthly"), "Daily", ["Revenue"]).withColumn("deprecated_Revenue", F.col("Revenue"))
    d = fam.month_rollup(view(spark, sf, "v_denominator"), "Discharge_Date", ["Discharges"])
    g = fam.month_rollup(view(spark, sf, "v_messages"), "Date", ["Count"]).withColumnRenamed("Count", "Messages").withColumn(
        "Unnamed: 0", F.lit(0))
    return fam.actuals([m, d, g])


_EXCL = ["S0"]
_NOTIF = ["Appointment", "Prescription", "Message", "Unknown"]


@query("m16_messages", oracle="""
SELECT Date, """ + ", ".join(
    f"CAST(coalesce(sum(Count) FILTER (WHERE Push_Notification = '{n}'), 0) AS BIGINT) AS Count_{n}, "
    f"CAST(coalesce(sum(Read_By) FILTER (WHERE Push_Notification = '{n}'), 0) AS BIGINT) AS Read_By_{n}" for n in _NOTIF) + """
FROM v_messages WHERE NOT coalesce(Supplier IN ('S0'), false) AND Read_By > 0 GROUP BY Date""", dates=["Date"])
def m16(spark, sf):
    return fam.messages(view(spark, sf, "v_messages"), _EXCL, _NOTIF)


@query("m17_notifications", oracle="""
SELECT Date, CAST(coalesce(sum(Count), 0) AS BIGINT) AS Count FROM v_messages
WHERE NOT coalesce(Supplier IN ('S0'), false) AND Read_By = 0 GROUP BY Date""", dates=["Date"])
def m17(spark, sf):
    return fam.notifications_only(view(spark, sf, "v_messages"), _EXCL)
