"""Practice-level and message-acknowledgement metric families."""
from pyspark.sql import functions as F

from strata.plans import families as fam
from strata.plans.registry import query
from strata.plans.standins import view
from strata.sources.files import read_bundle, write_bundle
from strata.session import scratch_path

ACK_CATS = ["TOC_FHIR_EC_DISCH_ACK", "TOC_FHIR_IP_DISCH_ACK", "TOC_FHIR_MH_DISCH_ACK", "TOC_FHIR_OP_ATTEN_ACK"]
RUN_DATE = "2001-11-20"


@query("m18_utilisation", oracle="""
SELECT ODS_Code, Date, EPS_Items, All_Items, CAST(round_even(TRY_CAST(replace(EPS_Utilisation, '%', '') AS DOUBLE) / 100.0, 4) AS DOUBLE) AS Utilisation
FROM v_eps""", dates=["Date"])
def m18(spark, sf):
    return fam.utilisation(view(spark, sf, "v_eps"), ["ODS_Code", "Date", "EPS_Items", "All_Items"], "EPS_Utilisation")


@query("m19_compliance", oracle="""
SELECT Edition, Compliant, Practices, CAST(round_even(CAST(Compliant AS DOUBLE) / Practices, 4) AS DOUBLE) AS Compliant_Share FROM
 (SELECT Edition, CAST(coalesce(sum(CASE upper(trim(Compliant)) WHEN 'YES' THEN 1 WHEN 'NO' THEN 0 END), 0) AS BIGINT) AS Compliant,
         CAST(count(*) AS BIGINT) AS Practices FROM v_status GROUP BY Edition) t""")
def m19(spark, sf):
    return fam.compliance(view(spark, sf, "v_status"), "Edition", "Compliant")


@query("m20_latest_extract", oracle="""
SELECT a.o_orderkey, a.Location, a.Date, o.ICB_Name FROM v_answers a LEFT JOIN v_org o ON a.Location = o.Code
WHERE a.Date IN (SELECT max(Date) FROM v_answers GROUP BY date_trunc('month', Date))""", dates=["Date"])
def m20(spark, sf):
    a = view(spark, sf, "v_answers").select("o_orderkey", "Location", "Date")
    return fam.latest_extract(a, view(spark, sf, "v_org"), "Date", "Location", "Code", ["ICB_Name"])


@query("m21_survey", oracle="""
SELECT Practice_Code, Year, n AS M090_num, d AS M090_den, o AS M091_num,
       CAST(round_even(CAST(n AS DOUBLE) / nullif(d, 0), 4) AS DOUBLE) AS Prop, d - n AS Remainder FROM
 (SELECT Practice_Code, Year, CASE WHEN M090_num >= 0 THEN M090_num END AS n, CASE WHEN M090_den >= 0 THEN M090_den END AS d,
         CASE WHEN M091_num >= 0 THEN M091_num END AS o FROM v_survey) t""")
def m21(spark, sf):
    return fam.survey(view(spark, sf, "v_survey"), ["Practice_Code", "Year"], "M090_num", "M090_den", "M091_num")


@query("m23_rolling_rate", oracle="""
SELECT Week_Commencing, Submissions, Practice_Population, CAST(round_even(Rate, 2) AS DOUBLE) AS Rate,
       CAST(round_even(CASE WHEN count(Rate) OVER w = 12 THEN avg(Rate) OVER w END, 2) AS DOUBLE) AS Rolling_Rate FROM
 (SELECT Week_Commencing, Submissions, Practice_Population, Submissions / (Practice_Population / 1000.0) AS Rate FROM
   (SELECT Week_Commencing, CAST(sum(Submissions) AS BIGINT) AS Submissions, CAST(sum(Practice_Population) AS BIGINT) AS Practice_Population
    FROM v_weekly GROUP BY 1) t) u
WINDOW w AS (ORDER BY Week_Commencing ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""", dates=["Week_Commencing"])
def m23(spark, sf):
    return fam.rolling_rate(view(spark, sf, "v_weekly"), "Week_Commencing", "Submissions", "Practice_Population")


@query("m24_valid_rows", oracle="""
SELECT o_orderkey, Week_Commencing, Practice_Code, Submissions, Practice_Population,
       regexp_replace(coalesce(Supplier, 'Unknown'), '^[0-9]+', 'UNKNOWN') AS Supplier, Valid_Practice, DATE '2001-09-01' AS Run_Date
FROM v_weekly WHERE Valid_Practice = 1""", dates=["Week_Commencing", "Run_Date"])
def m24(spark, sf):
    return fam.valid_rows(view(spark, sf, "v_weekly"), "Valid_Practice", "Supplier", "2001-09-01")


@query("m25_flag", oracle="""
SELECT Report_Period_End, Practice_Code, l_orderkey, coalesce(TRY_CAST(Value AS DOUBLE), 0.0) AS Value, Field,
       CASE WHEN coalesce(TRY_CAST(Value AS DOUBLE), 0.0) = 2 THEN 1 ELSE 0 END AS Enabled FROM v_field WHERE Field = 'A'""",
       dates=["Report_Period_End"])
def m25(spark, sf):
    return fam.field_flag(view(spark, sf, "v_field"), "A", "Value", 2, drop=["l_linenumber", "System_Supplier"])


@query("m26_transactions", oracle="""
SELECT Report_Period_End, Practice_Code, l_orderkey, l_linenumber, Value AS Transactions FROM v_field WHERE Field = 'R'""",
       dates=["Report_Period_End"])
def m26(spark, sf):
    return fam.field_passthrough(view(spark, sf, "v_field"), "R", ["System_Supplier", "Field"], {"Value": "Transactions"})


@query("m27_sma", oracle="""
SELECT Report_Period_End, Value, CAST(coalesce(floor(CASE WHEN count(Value) OVER w = 3 THEN avg(Value) OVER w END), 0) AS BIGINT) AS SMA FROM
 (SELECT Report_Period_End, coalesce(sum(Value), 0) AS Value FROM v_field WHERE Field = 'N' GROUP BY 1) t
WINDOW w AS (ORDER BY Report_Period_End ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""", dates=["Report_Period_End"])
def m27(spark, sf):
    return fam.national_sma(view(spark, sf, "v_field"), "Report_Period_End", "N", "Value")


@query("m28_enabled_pct", oracle="""
SELECT Report_Period_End, Numerator, Denominator, CAST(round_even(Numerator / nullif(Denominator, 0), 4) AS DOUBLE) AS Pct FROM
 (SELECT Report_Period_End, sum(Value) FILTER (WHERE Field = 'R') AS Numerator, sum(Value) FILTER (WHERE Field = 'N') AS Denominator
  FROM v_field WHERE Field IN ('R', 'N') GROUP BY 1) t""", dates=["Report_Period_End"])
def m28(spark, sf):
    return fam.enabled_pct(view(spark, sf, "v_field"), ["Report_Period_End"], "R", "N")


@query("m29_practice_pct", oracle="""
SELECT * FROM (SELECT Report_Period_End, Practice_Code, Numerator, Denominator,
                      CAST(round_even(Numerator / nullif(Denominator, 0), 4) AS DOUBLE) AS Pct FROM
 (SELECT Report_Period_End, Practice_Code, sum(Value) FILTER (WHERE Field = 'R') AS Numerator,
         sum(Value) FILTER (WHERE Field = 'N') AS Denominator FROM v_field WHERE Field IN ('R', 'N') GROUP BY ALL) t) u
WHERE NOT coalesce(Pct > 1, false)""", dates=["Report_Period_End"])
def m29(spark, sf):
    return fam.enabled_pct(view(spark, sf, "v_field"), ["Report_Period_End", "Practice_Code"], "R", "N", sanity=True)


@query("m30_supplier", oracle="""
SELECT DISTINCT Report_Period_End, Practice_Code, System_Supplier,
       CASE WHEN contains(System_Supplier, 'TPP') THEN 1 ELSE 0 END AS flag FROM v_field""", dates=["Report_Period_End"])
def m30(spark, sf):
    from strata.operators.aggregates import supplier_flag
    return supplier_flag(view(spark, sf, "v_field"), ["Report_Period_End", "Practice_Code"], "System_Supplier", "TPP")


EMERGENCY_RUN_DATE = "2001-06-15"  # discharges dated on or after the run are fictitious

_PAIRS = """(SELECT {k}, CAST(sum(floor(n / 2)) AS BIGINT) AS Pairs FROM (
  SELECT strftime(_time, '%Y-%m') AS Month, workflow, senderOdsCode, recipientOdsCode, count(*) AS n
  FROM v_acks WHERE regexp_matches(workflow, 'ACK') {w} GROUP BY ALL) t GROUP BY {k})"""


@query("m31_ack_pivot", oracle="SELECT Month, " + ", ".join(
    f"CAST(coalesce(sum(Pairs) FILTER (WHERE workflow = '{c}'), 0) AS BIGINT) AS {c}" for c in ACK_CATS) +
    f" FROM {_PAIRS.format(k='Month, workflow', w='')} p WHERE Month < '2001-11' GROUP BY Month")
def m31(spark, sf):
    return fam.ack_pivot(view(spark, sf, "v_acks"), ACK_CATS, RUN_DATE)


@query("m32_ack_trust", oracle="""
WITH site AS (SELECT strftime(_time, '%Y-%m') AS Month, workflow, recipientOdsCode, CAST(floor(count(*) / 2) AS BIGINT) AS Pairs
              FROM v_acks WHERE regexp_matches(workflow, 'ACK') GROUP BY ALL)
SELECT Month, substr(recipientOdsCode, 1, 3) AS Trust, """ + ", ".join(
    f"CAST(coalesce(sum(Pairs) FILTER (WHERE workflow = '{c}'), 0) AS BIGINT) AS {c}" for c in ACK_CATS) + """
FROM site WHERE Month < '2001-11' GROUP BY ALL""")
def m32(spark, sf):
    return fam.ack_trust(view(spark, sf, "v_acks"), ACK_CATS, RUN_DATE)


_M33 = f"""
WITH d AS (SELECT strftime(Discharge_Date, '%Y-%m') AS Month, CAST(coalesce(sum(Discharges), 0) AS BIGINT) AS Discharges FROM v_denominator GROUP BY 1),
     p AS ({_PAIRS.format(k='Month', w="AND workflow = 'TOC_FHIR_IP_DISCH_ACK'")})
SELECT d.Month, d.Discharges, p.Pairs, CAST(round_even(p.Pairs / (d.Discharges / 1000.0), 2) AS DOUBLE) AS Per_1000 FROM
  (SELECT *, row_number() OVER (ORDER BY Month) AS rn FROM d) d LEFT JOIN
  (SELECT *, row_number() OVER (ORDER BY Month) AS rn FROM p) p ON d.rn = p.rn"""


@query("m33_utilisation", oracle=_M33)
def m33(spark, sf):
    return fam.utilisation_positional(view(spark, sf, "v_acks"), view(spark, sf, "v_denominator"), "TOC_FHIR_IP_DISCH_ACK",
                                      "Discharge_Date", "Discharges")


@query("m34_trust_admitted", oracle="""
WITH site AS (SELECT strftime(_time, '%Y-%m') AS Month, recipientOdsCode, CAST(floor(count(*) / 2) AS BIGINT) AS Pairs
              FROM v_acks WHERE workflow = 'TOC_FHIR_IP_DISCH_ACK' GROUP BY ALL),
     den AS (SELECT strftime(Discharge_Date, '%Y-%m') AS Month, substr(Provider_Code, 1, 3) AS Trust, CAST(sum(Discharges) AS BIGINT) AS Discharges
             FROM v_denominator GROUP BY ALL)
SELECT den.Month, den.Trust, den.Discharges, coalesce(site.Pairs, 0) AS Pairs,
       CAST(round_even(coalesce(site.Pairs, 0) / (den.Discharges / 1000.0), 2) AS DOUBLE) AS Per_1000
FROM den LEFT JOIN site ON den.Month = site.Month AND den.Trust = substr(site.recipientOdsCode, 1, 3)""")
def m34(spark, sf):
    return fam.trust_rate(view(spark, sf, "v_acks"), view(spark, sf, "v_denominator"), "TOC_FHIR_IP_DISCH_ACK",
                          "Discharge_Date", "Provider_Code", "Discharges")


@query("m35_trust_emergency", oracle=f"""
WITH site AS (SELECT CAST(_time AS DATE) AS Day, recipientOdsCode, CAST(floor(count(*) / 2) AS BIGINT) AS Pairs
              FROM v_acks WHERE workflow = 'TOC_FHIR_EC_DISCH_ACK' GROUP BY ALL),
     den AS (SELECT Discharge_Date AS Day, Provider_Code AS Trust, CAST(sum(Discharges) AS BIGINT) AS Discharges FROM v_denominator
             WHERE Discharge_Date < DATE '{EMERGENCY_RUN_DATE}' GROUP BY ALL),
     j AS (SELECT strftime(den.Day, '%Y-%m') AS Month, den.Trust, CAST(sum(den.Discharges) AS BIGINT) AS Discharges,
                  CAST(sum(coalesce(site.Pairs, 0)) AS BIGINT) AS Pairs
           FROM den LEFT JOIN site ON den.Day = site.Day AND den.Trust = substr(site.recipientOdsCode, 1, 3) GROUP BY ALL)
SELECT Month, Trust, Discharges, Pairs, CAST(round_even(Pairs / (Discharges / 1000.0), 2) AS DOUBLE) AS Per_1000
FROM j WHERE Month < (SELECT max(Month) FROM j)""")
def m35(spark, sf):
    return fam.trust_rate(view(spark, sf, "v_acks"), view(spark, sf, "v_denominator"), "TOC_FHIR_EC_DISCH_ACK",
                          "Discharge_Date", "Provider_Code", "Discharges", grain="day", drop_last=True, run_date=EMERGENCY_RUN_DATE)


# England less provider numbers over all suppressed cells; site rows beside the trust's discharges, not summed (notebook lines 80-114).
@query("m36_trust_suppressed", oracle="""
WITH fill AS (SELECT ((SELECT sum(Measure_Value) FROM v_mh WHERE Breakdown = 'England') - (SELECT sum(Measure_Value) FROM v_mh WHERE Breakdown = 'Provider'))
                / CAST((SELECT count(*) FROM v_mh WHERE Measure_Value_Str = '*') AS DOUBLE) AS v),
     den AS (SELECT strftime(Reporting_Period_Start, '%Y-%m') AS Month, Primary_Level AS Trust,
               coalesce(sum(CASE WHEN Measure_Value_Str = '*' THEN (SELECT v FROM fill) ELSE TRY_CAST(Measure_Value_Str AS DOUBLE) END), 0) AS Discharges
             FROM v_mh WHERE Breakdown = 'Provider' GROUP BY ALL),
     site AS (SELECT strftime(_time, '%Y-%m') AS Month, recipientOdsCode, CAST(floor(count(*) / 2) AS BIGINT) AS Pairs
              FROM v_acks WHERE workflow = 'TOC_FHIR_MH_DISCH_ACK' GROUP BY ALL)
SELECT den.Month, den.Trust, CAST(round_even(den.Discharges, 2) AS DOUBLE) AS Discharges, coalesce(site.Pairs, 0) AS Pairs,
       CAST(round_even(coalesce(site.Pairs, 0) / (den.Discharges / 1000.0), 2) AS DOUBLE) AS Per_1000
FROM den LEFT JOIN site ON den.Month = site.Month AND den.Trust = substr(site.recipientOdsCode, 1, 3)""")
def m36(spark, sf):
    return fam.trust_suppressed(view(spark, sf, "v_acks"), view(spark, sf, "v_mh"), "TOC_FHIR_MH_DISCH_ACK")


@query("m37_bundle", oracle=f"""
SELECT 'acks_by_workflow' AS "table", CAST(count(DISTINCT strftime(_time, '%Y-%m')) AS BIGINT) AS rows FROM v_acks
WHERE regexp_matches(workflow, 'ACK') AND strftime(_time, '%Y-%m') < '2001-11'
UNION ALL SELECT 'utilisation', CAST(count(DISTINCT strftime(Discharge_Date, '%Y-%m')) AS BIGINT) FROM v_denominator""")
def m37(spark, sf):
    """Deliver the national pivot (M31) and utilisation (M33) tables together,
    then read the bundle back: one row per delivered table with its row count."""
    path = scratch_path(spark, "bundle")
    write_bundle(path, {"acks_by_workflow": m31(spark, sf), "utilisation": m33(spark, sf)})
    return read_bundle(spark, path).groupBy("table").agg(F.count(F.lit(1)).cast("long").alias("rows"))


@query("m37_bundle_rows", oracle="SELECT Month, " + ", ".join(
    f"CAST(coalesce(sum(Pairs) FILTER (WHERE workflow = '{c}'), 0) AS BIGINT) AS {c}" for c in ACK_CATS) + f""",
  NULL::BIGINT AS Discharges, NULL::BIGINT AS Pairs, NULL::DOUBLE AS Per_1000, 'acks_by_workflow' AS "table"
FROM {_PAIRS.format(k='Month, workflow', w='')} p WHERE Month < '2001-11' GROUP BY Month
UNION ALL SELECT Month, """ + ", ".join("NULL" for _ in ACK_CATS) + f""", Discharges, Pairs, Per_1000, 'utilisation' FROM ({_M33})""")
def m37b(spark, sf):
    """The same bundle, every row of it as it is read back."""
    path = scratch_path(spark, "bundle")
    write_bundle(path, {"acks_by_workflow": m31(spark, sf), "utilisation": m33(spark, sf)})
    return read_bundle(spark, path)
