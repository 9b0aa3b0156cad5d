"""Security-toolkit status, digital-record and reference families."""
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import aggregates as A
from strata.operators import filters as FL
from strata.operators import joins as J
from strata.operators import sets as U
from strata.operators import timeseries as W
from strata.operators.projection import rename, rename_at
from strata.plans import families as fam
from strata.plans.registry import query
from strata.plans.standins import view
from strata.sources.files import flatten_json
from strata.sources.tables import table

MET = ["Standards Met", "Standards Exceeded", "STANDARDS MET (19-20)"]


@query("m41_status_snapshot", oracle="""
WITH l AS (SELECT Code, Status FROM v_status WHERE Snapshot_Date = (SELECT max(Snapshot_Date) FROM v_status))
SELECT o.Code, o.Name, coalesce(l.Status, 'Not Published') AS Status,
       CASE WHEN coalesce(l.Status, 'Not Published') = 'Standards Exceeded' THEN 1 ELSE 0 END AS Exceeded,
       CASE WHEN coalesce(l.Status, 'Not Published') IN ('Standards Met', 'Standards Exceeded', 'STANDARDS MET (19-20)') THEN 1 ELSE 0 END AS Met_Or_Exceeded,
       CASE WHEN coalesce(l.Status, 'Not Published') = 'Not Published' THEN 1 ELSE 0 END AS Not_Submitted
FROM v_org o LEFT JOIN l ON o.Code = l.Code""")
def m41(spark, sf):
    latest = FL.latest_rows(view(spark, sf, "v_status"), "Snapshot_Date").select("Code", "Status")
    j = J.join_on(view(spark, sf, "v_org").select("Code", "Name"), latest, "Code", how="left")
    j = j.withColumn("Status", C.fill("Status", "Not Published"))
    return j.select("Code", "Name", "Status", C.eq_flag("Status", "Standards Exceeded").alias("Exceeded"),
                    C.in_flag("Status", MET).alias("Met_Or_Exceeded"), C.eq_flag("Status", "Not Published").alias("Not_Submitted"))


@query("m42_status_history", oracle="""
SELECT s.o_orderkey, s.Code, substr(s.Edition, 3, 2) || '/' || substr(s.Edition, 8, 2) AS Short_Edition,
       CASE upper(trim(s.Status)) WHEN 'STANDARDS MET (19-20)' THEN 'STANDARDS MET' WHEN 'NONE' THEN 'NOT SUBMITTED' ELSE upper(trim(s.Status)) END AS Status_Norm,
       CASE WHEN (CASE upper(trim(s.Status)) WHEN 'STANDARDS MET (19-20)' THEN 'STANDARDS MET' WHEN 'NONE' THEN 'NOT SUBMITTED' ELSE upper(trim(s.Status)) END)
            IN ('STANDARDS MET', 'STANDARDS EXCEEDED') THEN 1 ELSE 0 END AS Met_Or_Exceeded, o.ICB_Name
FROM v_status s LEFT JOIN v_org o ON s.Code = o.Code""")
def m42(spark, sf):
    s = view(spark, sf, "v_status")
    s = s.select("o_orderkey", "Code", C.short_edition("Edition").alias("Short_Edition"),
                 C.norm_status("Status", {"STANDARDS MET (19-20)": "STANDARDS MET", "NONE": "NOT SUBMITTED"}).alias("Status_Norm"))
    s = s.withColumn("Met_Or_Exceeded", C.in_flag("Status_Norm", ["STANDARDS MET", "STANDARDS EXCEEDED"]))
    return J.join_on(s, view(spark, sf, "v_org").select("Code", "ICB_Name"), "Code", how="left")


@query("m43_headline", oracle="""
WITH a AS (SELECT Code, Name, Role FROM v_org WHERE (Close_Date IS NULL OR Close_Date > DATE '2000-06-30') AND Open_Date < DATE '2000-06-30'),
     l AS (SELECT Code, Status FROM (SELECT *, row_number() OVER (PARTITION BY Code ORDER BY Snapshot_Date DESC, o_orderkey DESC) AS rn FROM v_status) t WHERE rn = 1),
     j AS (SELECT coalesce(a.Code, l.Code) AS Code, a.Name, a.Role, l.Status FROM a FULL OUTER JOIN l ON a.Code = l.Code),
     k AS (SELECT * FROM j WHERE NOT regexp_matches(Name, '0000001') AND NOT coalesce(Role IN ('BUILDING'), false))
SELECT 'Trust' AS Org_Type, CAST(count(*) AS BIGINT) AS Orgs, CAST(count_if(Status IN ('Standards Met', 'Standards Exceeded', 'STANDARDS MET (19-20)')) AS BIGINT) AS Met,
       CAST(round_even(CAST(count_if(Status IN ('Standards Met', 'Standards Exceeded', 'STANDARDS MET (19-20)')) AS DOUBLE) / count(*), 4) AS DOUBLE) AS Pct_Met FROM k""")
def m43(spark, sf):
    act = FL.active_as_of(view(spark, sf, "v_org"), "2000-06-30").select("Code", "Name", "Role")
    last = W.last_per(view(spark, sf, "v_status"), ["Code"], ["Snapshot_Date", "o_orderkey"]).select("Code", "Status")
    j = J.full_join(act, last, "Code")
    j = FL.isin(FL.contains(j, "Name", "0000001", negate=True), "Role", ["BUILDING"], negate=True)
    met = F.count_if(F.col("Status").isin(MET))
    return A.headline_row(j, [F.count(F.lit(1)).cast("long").alias("Orgs"), met.cast("long").alias("Met"),
                              F.bround(met / F.count(F.lit(1)), 4).alias("Pct_Met")], {"Org_Type": "Trust"})


# The trusts that the mix counts, its statuses from the oldest edition on, and the publication date behind which the oldest is out.
M44_ROLES, M44_STATUSES, M44_SWITCH = ["BUILDING", "MACHINERY"], ["STANDARDS MET (19-20)", "Approaching Standards", "Standards Exceeded", "Standards Met"], "1999-08-31"


# By folder: the outer join with the reference, code exclusion, organisation types, the status list that depends on the
# newest publication date, totals by area and by area and status (notebook lines 160-242).
@query("m44_status_mix", oracle="""
WITH s AS (SELECT * FROM v_status WHERE Snapshot_Date IN (SELECT max(Snapshot_Date) FROM v_status GROUP BY date_trunc('month', Snapshot_Date))
             AND Snapshot_Date <= DATE '2001-05-31'),
     j AS (SELECT s.Snapshot_Date, o.ICB_Code AS ICB, s.Status, s.Snapshot_Date AS Published FROM s JOIN v_org o ON s.Code = o.Code
           WHERE NOT regexp_matches(o.Name, '0000001') AND o.Role IN ('BUILDING', 'MACHINERY')),
     p AS (SELECT Snapshot_Date, max(Published) AS newest FROM j GROUP BY Snapshot_Date),
     k AS (SELECT j.* FROM j JOIN p USING (Snapshot_Date) WHERE Status IN ('Approaching Standards', 'Standards Exceeded', 'Standards Met')
             OR (Status = 'STANDARDS MET (19-20)' AND NOT coalesce(newest > DATE '1999-08-31', false))),
     t AS (SELECT Snapshot_Date, ICB, CAST(count(*) AS BIGINT) AS total FROM k GROUP BY ALL),
     g AS (SELECT Snapshot_Date, ICB, Status, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY ALL)
SELECT g.*, t.total FROM t JOIN g USING (Snapshot_Date, ICB)""", dates=["Snapshot_Date"])
def m44(spark, sf):
    s = FL.latest_per_month(view(spark, sf, "v_status"), "Snapshot_Date")
    s = FL.cap_to_report_month(s, "Snapshot_Date", "2001-06-15").select("Code", "Status", "Snapshot_Date", F.col("Snapshot_Date").alias("Published"))
    o = view(spark, sf, "v_org").select("Code", "Name", "Role", F.col("ICB_Code").alias("ICB"))
    o = FL.isin(FL.contains(o, "Name", "0000001", negate=True), "Role", M44_ROLES)
    j = J.join_on(s, o, "Code", how="inner")
    return fam.status_mix(j, "Snapshot_Date", "ICB", "Status", "Published", M44_STATUSES, outdated=1, switch=M44_SWITCH)


# Statuses that count as met or exceeded, by month of the register.
M45_BUCKETS = [(None, "1997-09", MET[:2]), ("1997-10", "1999-08", ["Standards Met", "STANDARDS MET (19-20)"]), ("1999-09", None, ["Standards Exceeded"])]


# Counts by date and status, three windows, sum by date, share of all of the date (notebook lines 82-131).
@query("m45_bucketed_pct", oracle="""
WITH c AS (SELECT strftime(Snapshot_Date, '%Y-%m') AS Date, Status, count(*) AS n FROM v_status WHERE Status IS NOT NULL GROUP BY ALL),
     k AS (SELECT Date, CAST(sum(n) AS BIGINT) AS Met_Or_Exceeded FROM c
           WHERE (Date <= '1997-09' AND Status IN ('Standards Met', 'Standards Exceeded'))
              OR (Date >= '1997-10' AND Date < '1999-09' AND Status IN ('Standards Met', 'STANDARDS MET (19-20)'))
              OR (Date >= '1999-09' AND Status = 'Standards Exceeded') GROUP BY Date),
     t AS (SELECT Date, CAST(sum(n) AS BIGINT) AS Total FROM c GROUP BY Date)
SELECT k.Date, Met_Or_Exceeded, Total, CAST(round_even(CAST(Met_Or_Exceeded AS DOUBLE) / Total, 4) AS DOUBLE) AS Pct FROM k LEFT JOIN t USING (Date)""")
def m45(spark, sf):
    s = view(spark, sf, "v_status").select(F.date_format("Snapshot_Date", "yyyy-MM").alias("Date"), "Status")
    return fam.met_by_date(s, "Date", "Status", M45_BUCKETS)


# The statuses that the area table keeps, and its first month.
M46_STATUSES, M46_FROM = ["Approaching Standards", "Standards Exceeded", "Standards Met", "None"], "1998-01"


# Kept statuses from a first month on, totals by date and area, month ends up to the report month (notebook lines 160-218).
@query("m46_status_by_icb", oracle="""
WITH s AS (SELECT strftime(s.Snapshot_Date, '%Y-%m') AS d, o.ICB_Code AS ICB, s.Status FROM v_status s JOIN v_org o ON s.Code = o.Code
           WHERE s.Status IN ('Approaching Standards', 'Standards Exceeded', 'Standards Met', 'None')),
     k AS (SELECT * FROM s WHERE d >= '1998-01'),
     t AS (SELECT d, ICB, CAST(count(*) AS BIGINT) AS total FROM k GROUP BY ALL),
     g AS (SELECT d, ICB, Status, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY ALL)
SELECT last_day(CAST(d || '-01' AS DATE)) AS Month_End, ICB, Status, n, total FROM g JOIN t USING (d, ICB)
WHERE last_day(CAST(d || '-01' AS DATE)) <= DATE '2001-05-31'""", dates=["Month_End"])
def m46(spark, sf):
    s = view(spark, sf, "v_status").filter(F.date_format("Snapshot_Date", "yyyy-MM") >= M46_FROM)
    s = s.select(C.month_end("Snapshot_Date").alias("Month_End"), "Code", "Status")
    s = FL.cap_to_report_month(s, "Month_End", "2001-06-15")
    j = J.join_on(s, view(spark, sf, "v_org").select("Code", F.col("ICB_Code").alias("ICB")), "Code", how="left")
    return fam.status_mix(j, "Month_End", "ICB", "Status", None, M46_STATUSES)


# Every response counts, by month, type and place; a response without a place falls out of the grouping (notebook lines 200-294).
@query("m47_cond_counts", oracle="""
SELECT strftime(a.Date, '%m-%Y') AS Month_Year, a.Type, o.ICB_Name, o.Region_Name, CAST(count(*) FILTER (WHERE a.Answer = 'Yes') AS BIGINT) AS PIR_YES,
  CAST(count(*) FILTER (WHERE a.Answer = 'No') AS BIGINT) AS PIR_NO, CAST(count(a.Answer) AS BIGINT) AS PIR_COUNT,
  CAST(count(*) FILTER (WHERE a.Answer = 'Yes') AS DOUBLE) / nullif(count(*) FILTER (WHERE a.Answer = 'Yes') + count(*) FILTER (WHERE a.Answer = 'No'), 0) AS PIR_PERCENTAGE
FROM v_answers a LEFT JOIN v_org o ON a.Location = o.Code WHERE a.Type IS NOT NULL AND o.ICB_Name IS NOT NULL AND o.Region_Name IS NOT NULL GROUP BY ALL""")
def m47(spark, sf):
    places = view(spark, sf, "v_org").select("Code", "ICB_Name", "Region_Name")
    return fam.responses_by_month(view(spark, sf, "v_answers"), places, "Location", "Code", "Date", ["Type"], ["ICB_Name", "Region_Name"], "Answer")


# Locations of the latest register; of each (location, type) the last response, of those the last by answer with missing
# answers behind "Yes"; PIRm_n counts all answers of the location (notebook lines 112-212).
_COLLATED = """
WITH spine AS (SELECT Code AS Location, ICB_Name, Region_Name, CAST(date_trunc('month', (SELECT max(Date) FROM v_answers)) AS DATE) AS monthly_date
               FROM v_org WHERE Close_Date IS NULL),
     n AS (SELECT Location, CAST(count(Answer) AS BIGINT) AS PIRm_n FROM v_answers GROUP BY Location),
     s1 AS (SELECT * FROM (SELECT Location, Type, Date, o_orderkey, Answer,
              row_number() OVER (PARTITION BY Location, Type ORDER BY Date DESC, o_orderkey DESC) AS rn FROM v_answers) t WHERE rn = 1),
     s2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Location ORDER BY Answer DESC NULLS FIRST, Date DESC, o_orderkey DESC) AS rn2
              FROM s1) t WHERE rn2 = 1),
     unit AS (SELECT s2.Location, s2.Type, s2.Date, s2.Answer, n.PIRm_n FROM s2 JOIN n ON s2.Location = n.Location)"""


def _spine(spark, sf):
    """The latest register: locations that are not closed, with the month of the newest drop."""
    month = view(spark, sf, "v_answers").select(F.trunc(F.max("Date"), "MM")).scalar()
    return view(spark, sf, "v_org").filter("Close_Date IS NULL").select(
        F.col("Code").alias("Location"), "ICB_Name", "Region_Name", month.alias("monthly_date"))


def _unit(spark, sf):
    """One response of each location, and how many of all its responses have an answer."""
    a = view(spark, sf, "v_answers").select("Location", "Type", "Date", "o_orderkey", "Answer")
    one = W.reduce_answers(a, "Location", "Type", "Date", "Answer", tiebreak=["o_orderkey"]).select("Location", "Type", "Date", "Answer")
    n = a.groupBy("Location").agg(F.count("Answer").alias("PIRm_n"))
    return one.join(n, "Location")


@query("m48_collated", oracle=_COLLATED + """
SELECT spine.*, unit.Type, unit.Date, unit.Answer, unit.PIRm_n FROM spine LEFT JOIN unit ON spine.Location = unit.Location""", dates=["monthly_date", "Date"])
def m48(spark, sf):
    return _spine(spark, sf).join(_unit(spark, sf), "Location", "left")


# Service-user rows of the average month (30 days 10:29:06) before the register's month, then the response (notebook lines 214-262).
@query("m49_offset_join", oracle=_COLLATED + """,
     b AS (SELECT Location, strftime(CAST(Date AS TIMESTAMP) + INTERVAL '30 days 10 hours 29 minutes 6 seconds', '%Y-%m') AS join_date, Beds
           FROM v_answers WHERE Beds IS NOT NULL)
SELECT spine.*, b.Beds, unit.Type, unit.Date, unit.Answer, unit.PIRm_n
FROM spine LEFT JOIN b ON spine.Location = b.Location AND strftime(spine.monthly_date, '%Y-%m') = b.join_date
LEFT JOIN unit ON spine.Location = unit.Location""", dates=["monthly_date", "Date"])
def m49(spark, sf):
    beds = view(spark, sf, "v_answers").filter("Beds IS NOT NULL").select(
        "Location", F.date_format(C.add_avg_month("Date"), "yyyy-MM").alias("join_date"), "Beds")
    spine = _spine(spark, sf).withColumn("join_date", F.date_format("monthly_date", "yyyy-MM"))
    return spine.join(beds, ["Location", "join_date"], "left").join(_unit(spark, sf), "Location", "left").drop("join_date")


# Every location and month of the register: answers up to the month's end, yes and no apart; "None" without either
# (notebook lines 226-292).
@query("m50_state_to_date", oracle="""
SELECT p.Location, last_day(p.Month) AS Month_End, CAST(count(*) FILTER (WHERE a.Answer = 'Yes') AS BIGINT) AS YEStodate, CAST(count(*) FILTER (WHERE a.Answer = 'No') AS BIGINT) AS NOtodate,
  CASE WHEN count(*) FILTER (WHERE a.Answer = 'Yes') >= 1 THEN 'Yes' WHEN count(*) FILTER (WHERE a.Answer = 'No') >= 1 THEN 'No' ELSE 'None' END AS PIR_todate
FROM v_panel p LEFT JOIN v_answers a ON a.Location = p.Location AND a.Date <= last_day(p.Month) GROUP BY p.Location, p.Month""", dates=["Month_End"])
def m50(spark, sf):
    one = lambda answer: F.when(F.col("Answer") == answer, 1).otherwise(0).cast("long")
    s = J.state_as_of(view(spark, sf, "v_panel"), view(spark, sf, "v_answers"), "Location", "Month", "Date", {
        "YEStodate": (one("Yes"), "sum"), "NOtodate": (one("No"), "sum")})
    return s.select("Location", C.month_end("Month").alias("Month_End"), "YEStodate", "NOtodate",
                    C.case([(F.col("YEStodate") >= 1, "Yes"), (F.col("NOtodate") >= 1, "No")], default="None").alias("PIR_todate"))


@query("m50_states_by_month", oracle="""
WITH s AS (SELECT p.Location, p.Month, count(*) FILTER (WHERE a.Answer = 'Yes') AS y, count(*) FILTER (WHERE a.Answer = 'No') AS n
           FROM v_panel p LEFT JOIN v_answers a ON a.Location = p.Location AND a.Date <= last_day(p.Month) GROUP BY p.Location, p.Month)
SELECT Month, CAST(count_if(y >= 1) AS BIGINT) AS Yes, CAST(count_if(y = 0 AND n >= 1) AS BIGINT) AS No, CAST(count_if(y + n = 0) AS BIGINT) AS "None"
FROM s GROUP BY Month""", dates=["Month"])
def m50_states(spark, sf):
    """M50 summed by month: swept over the changes of state, without a row for each location and month."""
    return J.state_sweep(view(spark, sf, "v_answers"), "Location", "Date", "Answer", ["Yes", "No"], "None", "Month")


@query("m51_adoption", oracle="""
WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Location, Answer ORDER BY Date, o_orderkey) AS rn FROM v_answers) t WHERE rn = 1),
     a AS (SELECT f.* FROM f JOIN v_org o ON f.Location = o.Code WHERE o.Close_Date IS NULL),
     m AS (SELECT strftime(Date, '%Y-%m') AS Month, CAST(count_if(Answer = 'Yes') AS BIGINT) AS Adopters, CAST(count(Answer) AS BIGINT) AS Returned
           FROM a GROUP BY 1),
     d AS (SELECT strftime(Month, '%Y-%m') AS Month, CAST(count(Location) AS BIGINT) AS Active_Orgs FROM v_active WHERE Dormant = 'N' GROUP BY 1),
     c AS (SELECT Month, CAST(sum(Adopters) OVER (ORDER BY Month) AS BIGINT) AS Cum_Adopters, CAST(sum(Returned) OVER (ORDER BY Month) AS BIGINT) AS Cum_Returned FROM m)
SELECT c.*, d.Active_Orgs, CAST(round_even(CAST(Cum_Adopters AS DOUBLE) / Active_Orgs, 4) AS DOUBLE) AS Adoption FROM c LEFT JOIN d USING (Month)""")
def m51(spark, sf):
    """First row per location and answer, active locations only; the share is of the month's active organisations."""
    f = U.dedup_first(view(spark, sf, "v_answers"), ["Location", "Answer"], ["Date", "o_orderkey"])
    active = FL.nulls(view(spark, sf, "v_org"), "Close_Date", keep_null=True).select(F.col("Code").alias("Location"))
    f = f.join(active, "Location", "left_semi").withColumn("Month", F.date_format("Date", "yyyy-MM"))
    m = f.groupBy("Month").agg(F.count_if(F.col("Answer") == "Yes").alias("Adopters"), F.count("Answer").alias("Returned"))
    m = W.cumsum(m, ["Month"], ["Adopters", "Returned"], names={"Adopters": "Cum_Adopters", "Returned": "Cum_Returned"})
    m = m.select("Month", F.col("Cum_Adopters").cast("long").alias("Cum_Adopters"), F.col("Cum_Returned").cast("long").alias("Cum_Returned"))
    d = FL.keep(view(spark, sf, "v_active"), F.col("Dormant") == "N").groupBy(F.date_format("Month", "yyyy-MM").alias("Month")).agg(
        F.count("Location").alias("Active_Orgs"))
    return m.join(d, "Month", "left").withColumn("Adoption", C.ratio("Cum_Adopters", "Active_Orgs", 4))


@query("m52_coverage", oracle="""
WITH m AS (SELECT strftime(s.Snapshot_Date, '%Y') AS Year, n.n_name AS ICB FROM v_status s JOIN customer c ON s.Code = c.c_custkey
           JOIN nation n ON c.c_nationkey = n.n_nationkey),
     cnt AS (SELECT Year, ICB, CAST(count(*) AS BIGINT) AS n FROM m GROUP BY ALL)
SELECT g.Year, g.ICB, coalesce(cnt.n, 0) AS n FROM ((SELECT DISTINCT Year FROM m) y CROSS JOIN (SELECT replace(n_name, chr(160), '') AS ICB FROM nation) i) g
LEFT JOIN cnt ON g.Year = cnt.Year AND g.ICB = cnt.ICB""")
def m52(spark, sf):
    s = view(spark, sf, "v_status").withColumn("Year", F.date_format("Snapshot_Date", "yyyy"))
    c = table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    n = table(spark, sf, "nation", ["n_nationkey", "n_name"]).withColumn("ICB", C.strip_nbsp("n_name"))
    members = J.map_hierarchy(s.select("Year", "Code"), [(c, "Code", "c_custkey"), (n, "c_nationkey", "n_nationkey")], how="inner")
    return J.coverage_by_group(members.select("Year", "ICB"), n.select("ICB"), "Year", "ICB")


@query("m53_programme", oracle="""
SELECT d.Id AS Organisation_Code, replace(o.Name, chr(160), '') AS Name,
       coalesce(CAST(TRY_STRPTIME(d.Date_Text, '%Y-%m-%d') AS DATE), CAST(TRY_STRPTIME(d.Date_Text, '%d/%m/%Y') AS DATE)) AS Go_Live
FROM v_datetext d LEFT JOIN v_org o ON d.Id % 1500 = o.Code""", dates=["Go_Live"])
def m53(spark, sf):
    d = view(spark, sf, "v_datetext").select("Id", "Date_Text", (F.col("Id") % 1500).alias("_k"))
    o = view(spark, sf, "v_org").select("Code", C.strip_nbsp("Name").alias("Name"))
    j = J.join_on(d, o, "_k", "Code", how="left")
    j = j.select(F.col("Id"), "Name", C.parse_date("Date_Text", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("Go_Live"))
    return rename(j, {"Id": "Organisation_Code"})


@query("m54_population", oracle="""
WITH p AS (SELECT Area_Code, CAST(sum(Size) AS BIGINT) AS Population FROM v_pop WHERE Sex IN ('ECONOMY', 'SMALL') GROUP BY 1),
     r AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_type = 'SMALL')
SELECT p.Area_Code, p.Population, r.p_type AS Has_Small FROM p LEFT JOIN r ON p.Area_Code = r.p_brand""")
def m54(spark, sf):
    p = A.sum_by(FL.keep(view(spark, sf, "v_pop"), F.col("Sex").isin("ECONOMY", "SMALL")), ["Area_Code"], ["Size"], names={"Size": "Population"})
    r = U.distinct(table(spark, sf, "part", ["p_brand", "p_type"]).filter(F.col("p_type") == "SMALL"))
    return J.join_on(p, r, "Area_Code", "p_brand", how="left").select("Area_Code", "Population", F.col("p_type").alias("Has_Small"))


@query("m55_active_ref", oracle="""
SELECT Code, Name, Open_Date FROM v_org WHERE Close_Date IS NULL AND Open_Date < DATE '2001-01-01'""", dates=["Open_Date"])
def m55(spark, sf):
    o = FL.nulls(view(spark, sf, "v_org"), "Close_Date", keep_null=True)
    return FL.active_as_of(o, "2001-01-01").select("Code", "Name", "Open_Date")


@query("m56_code_map", oracle="""
WITH a AS (SELECT user_id AS CODE, CAST(json_extract(props, '$.k') AS BIGINT) AS K FROM events),
     b AS (SELECT DISTINCT user_id AS Code FROM events WHERE event_type = 'signup')
SELECT coalesce(x.Code, b.Code) AS Code, x.Max_K FROM (SELECT CODE AS Code, max(K) AS Max_K FROM a GROUP BY 1) x
FULL OUTER JOIN (SELECT Code FROM b) b ON x.Code = b.Code""")
def m56(spark, sf):
    ev = table(spark, sf, "events", ["user_id", "props", "event_type"])
    flat = flatten_json(ev, "props", "k BIGINT", fields={"K": "k"}, keep=["user_id"])
    flat = rename_at(flat, {0: "Code"})
    agg = flat.groupBy("Code").agg(F.max("K").alias("Max_K"))
    b = ev.filter(F.col("event_type") == "signup").select(F.col("user_id").alias("Code")).distinct()
    return J.full_join(agg, b, "Code")


@query("m57_metric_filter", oracle="""
SELECT Id, Parsed, Metric FROM (SELECT Id, coalesce(CAST(TRY_STRPTIME(Date_Text, '%Y-%m-%d') AS DATE), CAST(TRY_STRPTIME(Date_Text, '%d/%m/%Y') AS DATE)) AS Parsed,
  split_part(File_Name, ' ', 4) AS Metric FROM v_datetext) t WHERE Metric IN ('1-URGENT', '2-HIGH')""", dates=["Parsed"])
def m57(spark, sf):
    d = view(spark, sf, "v_datetext").select("Id", C.parse_date("Date_Text", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("Parsed"),
                                             F.element_at(F.split("File_Name", " "), 4).alias("Metric"))
    return FL.isin(d, "Metric", ["1-URGENT", "2-HIGH"])


@query("m58_passthrough", oracle="""
SELECT ODS_Code, Date, EPS_Items, All_Items, CAST(round_even(CAST(EPS_Items AS DOUBLE) / nullif(All_Items, 0), 4) AS DOUBLE) AS Share FROM v_eps""",
       dates=["Date"])
def m58(spark, sf):
    e = view(spark, sf, "v_eps").select("ODS_Code", "Date", "EPS_Items", "All_Items")
    return e.withColumn("Share", C.ratio("EPS_Items", "All_Items", 4))


@query("m59_login_pct", oracle="""
WITH w AS (SELECT date_trunc('week', Date) AS Week, sum(coalesce(TRY_CAST(Logins AS DOUBLE), 0.0)) AS Logins FROM v_usage_wide GROUP BY 1),
     d AS (SELECT CAST(sum(Size) AS BIGINT) AS Adults FROM v_gp_pop WHERE TRY_CAST(regexp_replace(AGE, '\\+$', '') AS INTEGER) > 17
           AND Effective_Snapshot_Date = (SELECT max(Effective_Snapshot_Date) FROM v_gp_pop))
SELECT CAST(Week AS DATE) AS Week, Logins, (SELECT Adults FROM d) AS Adults, CAST(round_even(Logins / (SELECT Adults FROM d), 4) AS DOUBLE) AS Pct FROM w""",
       dates=["Week"])
def m59(spark, sf):
    u = view(spark, sf, "v_usage_wide").withColumn("Logins", C.coerce("Logins")).withColumn("Week", F.to_date(F.date_trunc("week", "Date")))
    w = A.sum_by(u, ["Week"], ["Logins"])
    pop = FL.adult_population(FL.latest_rows(view(spark, sf, "v_gp_pop"), "Effective_Snapshot_Date"), "AGE", 17)
    w = J.with_scalar(w, "Adults", pop.select(F.sum("Size").cast("long")))
    return w.withColumn("Pct", C.ratio("Logins", "Adults", 4))


_WIDE_COLS = ["Logins", "RecordViews", "Prescriptions", "P9NewAppUsers"]


def _usage_wide(spark, sf):
    u = view(spark, sf, "v_usage_wide").select("Date", "OdsCode", *[C.coerce(c).alias(c) for c in _WIDE_COLS])
    return J.widen(u, {c: (u, c) for c in _WIDE_COLS}, ["Date", "OdsCode"])


@query("m60_usage_wide", oracle="""
SELECT Date, OdsCode, """ + ", ".join(f"sum(coalesce(TRY_CAST({c} AS DOUBLE), 0.0)) AS {c}" for c in _WIDE_COLS) + """
FROM v_usage_wide GROUP BY ALL""", dates=["Date"])
def m60(spark, sf):
    return _usage_wide(spark, sf)


@query("m60_usage_totals", oracle="""
SELECT OdsCode, max(Logins) AS Logins, sum(RecordViews) AS RecordViews, sum(Prescriptions) AS Prescriptions FROM
 (SELECT Date, OdsCode, """ + ", ".join(f"sum(coalesce(TRY_CAST({c} AS DOUBLE), 0.0)) AS {c}" for c in _WIDE_COLS) + """
  FROM v_usage_wide GROUP BY ALL) t GROUP BY OdsCode""")
def m60b(spark, sf):
    return A.totals_by_org(_usage_wide(spark, sf), ["OdsCode"], stock=["Logins"], flow=["RecordViews", "Prescriptions"])


@query("m61_uptake_wide", oracle="""
WITH c AS (SELECT Date, OdsCode, sum(v) OVER (PARTITION BY OdsCode ORDER BY Date ROWS UNBOUNDED PRECEDING) AS Cum_P9 FROM
             (SELECT Date, OdsCode, coalesce(sum(coalesce(TRY_CAST(P9NewAppUsers AS DOUBLE), 0.0)), 0) AS v FROM v_usage_wide GROUP BY ALL) t),
     l AS (SELECT Date, OdsCode, sum(coalesce(TRY_CAST(Logins AS DOUBLE), 0.0)) AS Logins FROM v_usage_wide GROUP BY ALL)
SELECT c.Date, c.OdsCode, c.Cum_P9, l.Logins FROM c LEFT JOIN l ON c.Date = l.Date AND c.OdsCode = l.OdsCode""", dates=["Date"])
def m61(spark, sf):
    u = view(spark, sf, "v_usage_wide")
    cum = W.cumsum_by(u.withColumn("P9NewAppUsers", C.coerce("P9NewAppUsers")), "OdsCode", "Date", "P9NewAppUsers", name="Cum_P9")
    logins = u.select("Date", "OdsCode", C.coerce("Logins").alias("Logins"))
    return J.widen(cum, {"Cum_P9": (cum, "Cum_P9"), "Logins": (logins, "Logins")}, ["Date", "OdsCode"])


@query("m61_month_wide", oracle="""
SELECT CAST(date_trunc('month', Date) AS DATE) AS Month, OdsCode, sum(coalesce(TRY_CAST(Logins AS DOUBLE), 0.0)) AS Logins,
       sum(coalesce(TRY_CAST(RecordViews AS DOUBLE), 0.0)) AS RecordViews FROM v_usage_wide GROUP BY ALL""", dates=["Month"])
def m61b(spark, sf):
    u = view(spark, sf, "v_usage_wide").select("Date", "OdsCode", C.coerce("Logins").alias("Logins"), C.coerce("RecordViews").alias("RecordViews"))
    return A.month_wide(u, "Date", ["OdsCode"], ["Logins", "RecordViews"])


_UPTAKE = """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS Date, o_custkey AS Practice, o_orderkey, o_orderstatus, CAST(floor(o_totalprice / 1000) AS BIGINT) AS Patients FROM orders),
     a AS (SELECT Date, Practice, max(Patients) AS Patients FROM o GROUP BY ALL),
     b AS (SELECT Date, Practice, CAST(count(*) AS BIGINT) AS Registrations FROM o WHERE o_orderstatus <> 'P' GROUP BY ALL),
     d AS (SELECT Date, Practice, CAST(count(*) AS BIGINT) AS P9_Registrations FROM o WHERE o_orderstatus = 'F' GROUP BY ALL),
     m AS (SELECT CAST(date_trunc('month', a.Date) AS DATE) AS Month, a.Practice, max(a.Patients) AS Patients,
                  CAST(sum(b.Registrations) AS BIGINT) AS Registrations, CAST(sum(d.P9_Registrations) AS BIGINT) AS P9_Registrations
           FROM a LEFT JOIN b ON a.Date = b.Date AND a.Practice = b.Practice LEFT JOIN d ON a.Date = d.Date AND a.Practice = d.Practice GROUP BY ALL)
"""


def _uptake_month(spark, sf):
    """Month table of one stock (its maximum) and two flows (their sums), three day tables side by side."""
    o = table(spark, sf, "orders", ["o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice"]).select(
        F.to_date("o_orderdate").alias("Date"), F.col("o_custkey").alias("Practice"), "o_orderstatus",
        F.floor(F.col("o_totalprice") / 1000).cast("long").alias("Patients"))
    keys = ["Date", "Practice"]
    a = o.groupBy(*keys).agg(F.max("Patients").alias("Patients"))
    b = A.count_by(o.filter(F.col("o_orderstatus") != "P"), keys, name="Registrations")
    d = A.count_by(o.filter(F.col("o_orderstatus") == "F"), keys, name="P9_Registrations")
    wide = J.widen(a, {"Patients": (a, "Patients"), "Registrations": (b, "Registrations"), "P9_Registrations": (d, "P9_Registrations")}, keys)
    return wide.groupBy(F.trunc("Date", "MM").alias("Month"), "Practice").agg(
        F.max("Patients").alias("Patients"), F.sum("Registrations").alias("Registrations"), F.sum("P9_Registrations").alias("P9_Registrations"))


@query("m61_uptake_month", oracle=_UPTAKE + "SELECT * FROM m", dates=["Month"])
def m61c(spark, sf):
    return _uptake_month(spark, sf)


@query("m61_uptake_totals", oracle=_UPTAKE + """
SELECT Practice, max(Patients) AS Patients, CAST(sum(Registrations) AS BIGINT) AS Registrations, CAST(sum(P9_Registrations) AS BIGINT) AS P9_Registrations
FROM m GROUP BY Practice""")
def m61d(spark, sf):
    return _uptake_month(spark, sf).groupBy("Practice").agg(
        F.max("Patients").alias("Patients"), F.sum("Registrations").alias("Registrations"), F.sum("P9_Registrations").alias("P9_Registrations"))


@query("m52_submissions", oracle="""
SELECT s.o_orderkey, replace(CAST(s.Code AS VARCHAR) || CASE WHEN s.Code % 3 = 0 THEN chr(160) ELSE '' END, chr(160), '') AS ODS, s.Snapshot_Date, c.c_nationkey AS STP_Code
FROM v_status s LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = replace(CAST(s.Code AS VARCHAR) || CASE WHEN s.Code % 3 = 0 THEN chr(160) ELSE '' END, chr(160), '')""",
       dates=["Snapshot_Date"])
def m52b(spark, sf):
    """Every submission with its STP: codes lose their no-break spaces before the join."""
    raw = F.concat(F.col("Code").cast("string"), F.when(F.col("Code") % 3 == 0, "\u00a0").otherwise(""))
    s = view(spark, sf, "v_status").select("o_orderkey", raw.alias("Raw"), "Snapshot_Date").withColumn("ODS", C.strip_nbsp("Raw")).drop("Raw")
    c = table(spark, sf, "customer", ["c_custkey", "c_nationkey"]).select(F.col("c_custkey").cast("string").alias("ODS"), F.col("c_nationkey").alias("STP_Code"))
    return s.join(c, "ODS", "left")
