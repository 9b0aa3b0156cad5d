"""Ingestion families (M62-M72): cleaning, appending by period, snapshots."""
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregates as A
from strata.operators import filters as FL
from strata.operators import joins as J
from strata.operators import timeseries as W
from strata.operators.history import merge_history
from strata.operators.projection import canonicalise, rename, rename_at, with_literal
from strata.operators.sets import union_all
from strata.plans.registry import query
from strata.plans.standins import view
from strata.session import scratch_path
from strata.sources import files as S
from strata.sources.tables import table


@query("m62_partners", oracle="""
WITH x AS (SELECT For_Month, ICB_Code, Org_Type, CASE WHEN Connected = 'Connected' THEN 1 ELSE 0 END AS flag FROM v_partners
           WHERE NOT coalesce(Name = 'nan', false)),
     c AS (SELECT For_Month, ICB_Code, Org_Type, CAST(count(*) AS BIGINT) AS Total, CAST(sum(flag) AS BIGINT) AS Connected FROM x GROUP BY ALL)
SELECT *, CAST(round_even(CAST(Connected AS DOUBLE) / Total, 4) AS DOUBLE) AS Percent,
       CASE WHEN For_Month = max(For_Month) OVER (PARTITION BY ICB_Code, Org_Type) THEN 1 ELSE 0 END AS Latest FROM c""", dates=["For_Month"])
def m62(spark, sf):
    p = view(spark, sf, "v_partners")
    parts = []
    for t in ["Acute", "Community"]:  # one workbook sheet per organisation type
        sheet = rename_at(p.filter(F.col("Org_Type") == t).select("For_Month", "ICB_Code", "ODS_Code", "Name", "Connected"),
                          {4: "Connected_Text"}).withColumn("Org_Type", F.lit(t))
        parts.append(FL.drop_totals(sheet, "Name", tokens=()))
    u = union_all(*parts).withColumn("flag", C.value_map("Connected_Text", {"Connected": 1}, default=0))
    cov = A.coverage(u, ["For_Month", "ICB_Code", "Org_Type"], "flag")
    return W.latest_flag(cov, ["ICB_Code", "Org_Type"], "For_Month", "Latest")


@query("m63_new_cumulative", oracle="""
WITH r AS (SELECT o_custkey, 'github' AS host FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, 'gitlab' FROM orders WHERE o_orderstatus <> 'F'),
     f AS (SELECT split_part('grp' || CAST(r.o_custkey % 5 AS VARCHAR) || '/' || CAST(r.o_custkey AS VARCHAR), '/', 1) AS Owner, r.host, r.o_custkey, min(o.o_orderdate) AS created
           FROM r JOIN orders o ON r.o_custkey = o.o_custkey GROUP BY ALL),
     m AS (SELECT Owner, CAST(date_trunc('month', created) AS DATE) AS Month, CAST(count(*) AS BIGINT) AS new FROM f GROUP BY ALL),
     b AS (SELECT Owner, min(Month) AS lo, max(Month) AS hi FROM m GROUP BY Owner),
     g AS (SELECT Owner, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS Month FROM b)
SELECT g.Owner, g.Month, coalesce(m.new, 0) AS new,
       CAST(sum(coalesce(m.new, 0)) OVER (PARTITION BY g.Owner ORDER BY g.Month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative
FROM g LEFT JOIN m ON g.Owner = m.Owner AND g.Month = m.Month""", dates=["Month"])
def m63(spark, sf):
    o = table(spark, sf, "orders", ["o_custkey", "o_orderstatus", "o_orderdate"])
    first = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("created"))
    gh = o.filter(F.col("o_orderstatus") == "F").select("o_custkey").withColumn("host", F.lit("github"))
    gl = o.filter(F.col("o_orderstatus") != "F").select("o_custkey").withColumn("host", F.lit("gitlab"))
    r = union_all(gh, gl).join(first, "o_custkey")
    path = F.concat(F.lit("grp"), (F.col("o_custkey") % 5).cast("string"), F.lit("/"), F.col("o_custkey").cast("string"))
    repos = r.withColumn("Owner", C.first_segment(path, "/")).groupBy("Owner", "host", "o_custkey").agg(F.min("created").alias("created"))
    return W.new_and_cumulative(repos, "created", keys=["Owner"])


@query("m64_service_users", oracle="""
SELECT o_orderkey, 'home_care' AS Source, coalesce(CAST(TRY_STRPTIME(Date_Text, '%Y-%m-%d') AS DATE), DATE '1900-01-01') AS Date,
       1 AS IsDomcare, coalesce(Users, 0) AS ServiceUserCount FROM
  (SELECT o.o_orderkey, d.Date_Text, CASE WHEN o.o_totalprice > 300000 THEN NULL ELSE CAST(floor(o.o_totalprice / 1000) AS BIGINT) END AS Users, o.o_orderstatus
   FROM orders o JOIN v_datetext d ON o.o_orderkey = d.Id) t WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, 'care_home', coalesce(CAST(TRY_STRPTIME(Date_Text, '%Y-%m-%d') AS DATE), DATE '1900-01-01'), 0, coalesce(Users, 0) FROM
  (SELECT o.o_orderkey, d.Date_Text, CASE WHEN o.o_totalprice > 300000 THEN NULL ELSE CAST(floor(o.o_totalprice / 1000) AS BIGINT) END AS Users, o.o_orderstatus
   FROM orders o JOIN v_datetext d ON o.o_orderkey = d.Id) t WHERE o_orderstatus <> 'F'""", dates=["Date"])
def m64(spark, sf):
    o = table(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_orderstatus"])
    d = view(spark, sf, "v_datetext").select(F.col("Id").alias("o_orderkey"), "Date_Text")
    x = o.join(d, "o_orderkey").withColumn("Users", F.when(F.col("o_totalprice") <= 300000, F.floor(F.col("o_totalprice") / 1000).cast("long")))
    out = []
    home = F.col("o_orderstatus") == "F"
    for src, mine, dom in [("home_care", home, 1), ("care_home", ~home, 0)]:
        s = with_literal(x.filter(mine), "Source", src)
        out.append(s.select("o_orderkey", "Source", C.date_or_sentinel("Date_Text").alias("Date"), F.lit(dom).alias("IsDomcare"),
                            C.fill("Users", 0).alias("ServiceUserCount")))
    return union_all(*out)


@query("m65_fingerprint_find", oracle="""
WITH hdr AS (SELECT o_custkey, o_orderstatus FROM v_batch ORDER BY o_orderkey LIMIT 1)
SELECT h.o_orderkey, h.o_custkey, h.o_orderstatus FROM v_hist h, hdr WHERE h.o_custkey = hdr.o_custkey AND h.o_orderstatus = hdr.o_orderstatus""")
def m65(spark, sf):
    h, b = view(spark, sf, "v_hist"), view(spark, sf, "v_batch")
    cols = ["o_custkey", "o_orderstatus"]
    hdr = b.agg(F.min_by(F.struct(*cols), F.col("o_orderkey")).alias("_h")).select("_h.*")
    return FL.dropna(h.select("o_orderkey", *cols), cols).join(hdr, cols, "left_semi")


_TOOLKIT_RULES = [("PRIMARY", "Primary Sector"), ("CODE", "Code"), ("ORGANISATION", "Organisation_Name"), ("STATUS", "Status_Raw")]


def _toolkit(spark, sf, year, file_name):
    raw = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("PRIMARY SECTOR"), F.col("c_custkey").alias("Org Code"), F.col("c_name").alias("ORGANISATION NAME"),
        F.col("c_nationkey").cast("string").alias("Latest Status"))
    x = FL.contains(canonicalise(raw, _TOOLKIT_RULES), "Primary Sector", "MACHINERY")
    x = x.withColumn("DSPT_Edition", C.edition(F.lit(year))).withColumn("Snapshot_Date", C.year_token(F.lit(file_name), year))
    return x.select("Code", "Organisation_Name", "DSPT_Edition", "Snapshot_Date", "Status_Raw")


@query("m66_toolkit_ingest", oracle="""
SELECT c_custkey AS Code, c_name AS Organisation_Name, e.ed AS DSPT_Edition, e.snap AS Snapshot_Date, CAST(c_nationkey AS VARCHAR) AS Status_Raw
FROM customer, (SELECT '2019/2020' AS ed, '2020/03' AS snap UNION ALL SELECT '2020/2021', '2021/06') e
WHERE contains(c_mktsegment, 'MACHINERY')""")
def m66(spark, sf):
    hist = _toolkit(spark, sf, 2020, "DSPT 2020_03 snapshot")
    once = merge_history(hist, _toolkit(spark, sf, 2021, "DSPT 2021_06 snapshot"), "DSPT_Edition", "append_if_new")
    return merge_history(once, _toolkit(spark, sf, 2021, "DSPT 2021_06 snapshot"), "DSPT_Edition", "append_if_new")


@query("m67_survey_ingest", oracle="""
SELECT Practice_Code AS Practice, M090_num + M091_num AS Answered_Online, M090_den AS Base, CAST(Year AS BIGINT) AS Year
FROM v_survey""")
def m67(spark, sf):
    path = scratch_path(spark, "survey_csv")
    S.write_csv(view(spark, sf, "v_survey"), path)
    raw = S.read_csv(spark, path, schema="Practice_Code LONG, Year INT, M090_num LONG, M091_num LONG, M090_den LONG",
                     columns=["Practice_Code", "Year", "M090_num", "M091_num", "M090_den"])
    x = raw.withColumn("Answered_Online", C.add(["M090_num", "M091_num"])).drop("M090_num", "M091_num")
    x = rename(x, {"Practice_Code": "Practice", "M090_den": "Base"}).withColumn("Year", F.col("Year").cast("long"))
    hist = x.filter(F.col("Year") < 1999)
    return merge_history(hist, x.filter(F.col("Year") >= 1999), "Year", "append_unless_all")


_TITLES = ["viewCarePlans", "clickCarePlans"]


def _logins(v):
    long = v.select(F.date_format(F.date_trunc("week", "Date"), "yyyy-MM-dd").alias("week_commencing"), "JumpOff", "Clicks")
    return A.pivot_sum(long, ["week_commencing"], "JumpOff", "Clicks", _TITLES, fill=None, agg="mean")


@query("m68_login_upsert", oracle="""
SELECT strftime(date_trunc('week', Date), '%Y-%m-%d') AS week_commencing,
       avg(Clicks) FILTER (WHERE JumpOff = 'viewCarePlans') AS viewCarePlans, avg(Clicks) FILTER (WHERE JumpOff = 'clickCarePlans') AS clickCarePlans
FROM v_clicks WHERE Date < DATE '2024-01-15' GROUP BY 1
HAVING strftime(date_trunc('week', Date), '%Y-%m-%d') NOT IN (SELECT strftime(date_trunc('week', Date), '%Y-%m-%d') FROM v_clicks WHERE Date >= DATE '2024-01-10')
UNION ALL
SELECT strftime(date_trunc('week', Date), '%Y-%m-%d'), avg(Clicks) FILTER (WHERE JumpOff = 'viewCarePlans'), avg(Clicks) FILTER (WHERE JumpOff = 'clickCarePlans')
FROM v_clicks WHERE Date >= DATE '2024-01-10' GROUP BY 1""")
def m68(spark, sf):
    v = view(spark, sf, "v_clicks")
    # the history has weeks that the batch lacks, the batch a week that it replaces, and new ones
    hist = _logins(v.filter(F.col("Date") < F.lit("2024-01-15").cast("date")))
    batch = _logins(v.filter(F.col("Date") >= F.lit("2024-01-10").cast("date")))
    return merge_history(hist, batch, "week_commencing", "upsert")


@query("m69_practice_list", oracle="""
SELECT c_custkey AS PRACTICE_CODE, c_name AS PRACTICE_NAME, CAST(e.d AS DATE) AS EXTRACT_DATE,
       CASE WHEN month(e.d) >= 4 THEN CAST(year(e.d) AS VARCHAR) || '/' || CAST(year(e.d) + 1 AS VARCHAR)
            ELSE CAST(year(e.d) - 1 AS VARCHAR) || '/' || CAST(year(e.d) AS VARCHAR) END AS FY
FROM customer, (SELECT DATE '2020-03-31' AS d UNION ALL SELECT DATE '2020-04-01') e""", dates=["EXTRACT_DATE"])
def m69(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("PRACTICE_CODE"), F.col("c_name").alias("PRACTICE_NAME"))
    a = c.withColumn("EXTRACT_DATE", F.lit("2020-03-31").cast("date")).withColumn("FY", C.fin_year("EXTRACT_DATE"))
    b = c.withColumn("EXTRACT_DATE", F.lit("2020-04-01").cast("date")).withColumn("FY", C.fin_year("EXTRACT_DATE"))
    return merge_history(merge_history(a, b, "FY", "append_if_new"), a, "FY", "append_if_new")


@query("m70_direct_load", oracle="""
SELECT Id, coalesce(CAST(TRY_STRPTIME(Date_Text, '%Y-%m-%d') AS DATE), CAST(TRY_STRPTIME(Date_Text, '%d/%m/%Y') AS DATE)) AS Go_Live,
       coalesce(CASE WHEN Id % 2 = 0 THEN Date END, Date) AS Effective_Date FROM v_datetext""", dates=["Go_Live", "Effective_Date"])
def m70(spark, sf):
    d = view(spark, sf, "v_datetext")
    x = d.select("Id", C.parse_date("Date_Text", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("Go_Live"), "Date",
                 F.when(F.col("Id") % 2 == 0, F.col("Date")).alias("Revised"))
    x = x.select("Id", "Go_Live", C.override("Date", "Revised").alias("Effective_Date"))
    return merge_history(view(spark, sf, "v_datetext"), x, "Id", "overwrite")


@query("m71_channel_fold", oracle="""
WITH a AS (SELECT Daily, Orders, Revenue FROM v_monthly),
     b AS (SELECT Discharge_Date AS Daily, CAST(sum(Discharges) AS BIGINT) AS Discharges FROM v_denominator GROUP BY 1),
     c AS (SELECT CAST(_time AS DATE) AS Daily, CAST(count(*) AS BIGINT) AS Acks FROM v_acks GROUP BY 1)
SELECT coalesce(a.Daily, b.Daily, c.Daily) AS Daily, a.Orders, a.Revenue, b.Discharges, c.Acks
FROM a FULL OUTER JOIN b ON a.Daily = b.Daily FULL OUTER JOIN c ON coalesce(a.Daily, b.Daily) = c.Daily""", dates=["Daily"])
def m71(spark, sf):
    a = view(spark, sf, "v_monthly").select("Daily", "Orders", "Revenue")
    b = A.sum_by(view(spark, sf, "v_denominator"), ["Discharge_Date"], ["Discharges"]).withColumnRenamed("Discharge_Date", "Daily")
    c = A.count_by(view(spark, sf, "v_acks").withColumn("Daily", C.parse_date(F.date_format("_time", "dd-MM-yyyy"), ["dd-MM-yyyy"])),
                   ["Daily"], name="Acks")
    return merge_history(a, J.outer_merge_all([a, b, c], "Daily"), "Daily", "overwrite")


@query("m72_usage_ingest", oracle="""
SELECT strftime(Date, '%Y-%m-%d') AS Date, OdsCode, Logins, DATE '2024-02-01' AS snapshot_date FROM v_usage_wide""", dates=["snapshot_date"])
def m72(spark, sf):
    """Weekly usage drops land as CSV folders; the matching drops are read,
    dates normalised, appended to the history by period, and the complete
    history written as today's snapshot, then read back."""
    landing = scratch_path(spark, "usage_landing")
    u = view(spark, sf, "v_usage_wide").select(F.date_format("Date", "dd/MM/yyyy").alias("Date"), "OdsCode", "Logins")
    S.write_csv(u.filter(F.col("Date").startswith("0")), f"{landing}/usage_week1")
    S.write_csv(u.filter(~F.col("Date").startswith("0")), f"{landing}/usage_week2")
    S.write_csv(u.limit(0), f"{landing}/jumpoff_week2")
    drop = S.read_matching(spark, landing, "usage_*", schema="Date STRING, OdsCode LONG, Logins STRING", options={"header": "true"})
    drop = drop.withColumn("Date", C.fmt_date(C.parse_date("Date", ["dd/MM/yyyy"]), "yyyy-MM-dd"))
    hist = drop.filter(F.col("Date") < "2024-01-10")
    merged = merge_history(hist, drop.filter(F.col("Date") >= "2024-01-10"), "Date", "append_if_new")
    root = scratch_path(spark, "usage_history")
    S.write_snapshot(merged, root, "2024-02-01")
    return S.read_latest(spark, root)
