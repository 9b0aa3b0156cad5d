"""Scalar functions (C1-C26) and row-wise measures."""
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.projection import round_all
from strata.plans.registry import query
from strata.plans.standins import view
from strata.sources.tables import table


@query("c1_coerce", oracle="""
SELECT event_id, ValueText, coalesce(TRY_CAST(ValueText AS DOUBLE), 0.0) AS Value_Num FROM v_usage""")
def c1(spark, sf):
    return view(spark, sf, "v_usage").select("event_id", "ValueText", C.coerce("ValueText").alias("Value_Num"))


@query("c2_percent", oracle="""
SELECT Id, TRY_CAST(replace(Pct_Dirty, '%', '') AS DOUBLE) / 100.0 AS Pct,
       TRY_CAST(replace(Pct_Text, '%', '') AS DOUBLE) / 100.0 AS Pct2 FROM v_text""")
def c2(spark, sf):
    return view(spark, sf, "v_text").select("Id", C.percent("Pct_Dirty").alias("Pct"), C.percent("Pct_Text").alias("Pct2"))


@query("c3_yesno", oracle="""
SELECT Id, CASE upper(trim(YesNo)) WHEN 'YES' THEN 1 WHEN 'NO' THEN 0 END AS Flag FROM v_text""")
def c3(spark, sf):
    return view(spark, sf, "v_text").select("Id", C.yesno("YesNo").alias("Flag"))


@query("c4_value_map", oracle="""
SELECT o_orderkey, CASE Status WHEN 'Standards Exceeded' THEN 2 WHEN 'Standards Met' THEN 1 ELSE 0 END AS Score FROM v_status""")
def c4(spark, sf):
    return view(spark, sf, "v_status").select(
        "o_orderkey", C.value_map("Status", {"Standards Exceeded": 2, "Standards Met": 1}, default=0).alias("Score"))


@query("c5_flags", oracle="""
SELECT o_orderkey,
       CASE WHEN Status = 'Standards Met' THEN 1 ELSE 0 END AS Met,
       CASE WHEN Status IN ('Standards Met', 'Standards Exceeded') THEN 1 ELSE 0 END AS Met_Or_Exceeded,
       CASE WHEN Status IN ('None', 'Approaching Standards') THEN 0 ELSE 1 END AS Submitted,
       CASE WHEN Compliant = upper(Compliant) THEN 1 ELSE 0 END AS Upper_Case
FROM v_status""")
def c5(spark, sf):
    v = view(spark, sf, "v_status")
    return v.select(
        "o_orderkey",
        C.eq_flag("Status", "Standards Met").alias("Met"),
        C.in_flag("Status", ["Standards Met", "Standards Exceeded"]).alias("Met_Or_Exceeded"),
        C.not_in_flag("Status", ["None", "Approaching Standards"]).alias("Submitted"),
        C.flag(F.col("Compliant") == F.upper("Compliant")).alias("Upper_Case"),
    )


@query("c6_case", oracle="""
SELECT o_orderkey, CASE WHEN Answer = 'Yes' THEN 'Digital' WHEN Answer = 'No' THEN 'Not digital' ELSE 'Unknown' END AS Label
FROM v_answers""")
def c6(spark, sf):
    a = F.col("Answer")
    return view(spark, sf, "v_answers").select(
        "o_orderkey", C.case([(a == "Yes", "Digital"), (a == "No", "Not digital")], default="Unknown").alias("Label"))


@query("c7_dates", oracle="""
SELECT Id, coalesce(CAST(TRY_STRPTIME(Date_Text, '%Y-%m-%d') AS DATE), CAST(TRY_STRPTIME(Date_Text, '%d/%m/%Y') AS DATE)) AS Parsed
FROM v_datetext""", dates=["Parsed"])
def c7(spark, sf):
    return view(spark, sf, "v_datetext").select("Id", C.parse_date("Date_Text", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("Parsed"))


@query("c7_stamps", oracle="""
SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE ts END AS Stamp,
       CASE WHEN event_id % 2 = 0 THEN CAST(date_trunc('month', ts) AS DATE) ELSE CAST(ts AS DATE) END AS Day FROM (
  SELECT event_id, date_trunc('second', ts) AS ts FROM events) t""", dates=["Stamp", "Day"])
def c7b(spark, sf):
    """Stamps as ``dd-MM-yyyy HH:mm:ss`` (some broken), days as ``January-2024`` or ISO text."""
    e = table(spark, sf, "events", ["event_id", "ts"])
    stamp = F.when(F.col("event_id") % 3 == 2, "no stamp").otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm:ss"))
    day = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "MMMM-yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", C.parse_timestamp(stamp, ["dd-MM-yyyy HH:mm:ss"]).cast("timestamp_ntz").alias("Stamp"),
                    C.parse_date(day, ["yyyy-MM-dd", "MMMM-yyyy"]).alias("Day"))


@query("c8_format", oracle="""
SELECT Id, strftime(Date, '%Y-%m') AS Ym, strftime(Date, '%m-%Y') AS My, strftime(Date, '%Y-%m-%d') AS Ymd,
       CAST(strftime(Date, '%Y%m%d') AS BIGINT) AS Ymd_Int FROM v_datetext""")
def c8(spark, sf):
    return view(spark, sf, "v_datetext").select(
        "Id", C.fmt_date("Date", "yyyy-MM").alias("Ym"), C.fmt_date("Date", "MM-yyyy").alias("My"),
        C.fmt_date("Date", "yyyy-MM-dd").alias("Ymd"), C.yyyymmdd_int("Date").alias("Ymd_Int"))


@query("c9_parts", oracle="""
SELECT Id, month(Date) AS Month, year(Date) AS Year,
       CAST(month(Date) AS VARCHAR) || '-' || CAST(year(Date) AS VARCHAR) AS Month_Year FROM v_datetext""")
def c9(spark, sf):
    return view(spark, sf, "v_datetext").select(
        "Id", F.month("Date").alias("Month"), F.year("Date").alias("Year"), C.month_year("Date").alias("Month_Year"))


@query("c10_add_month", oracle="""
SELECT Id, CAST(Date + INTERVAL 1 MONTH AS DATE) AS Next_Month,
       CAST(Date AS TIMESTAMP) + INTERVAL 2629746 SECOND AS Avg_Month FROM v_datetext""", dates=["Next_Month", "Avg_Month"])
def c10(spark, sf):
    return view(spark, sf, "v_datetext").select(
        "Id", C.add_month("Date", 1).alias("Next_Month"), C.add_avg_month("Date").alias("Avg_Month"))


@query("c11_month_end", oracle="""
SELECT Id, last_day(Date) AS Month_End, dayofmonth(last_day(Date)) AS Days_In_Month FROM v_datetext""", dates=["Month_End"])
def c11(spark, sf):
    return view(spark, sf, "v_datetext").select(
        "Id", C.month_end("Date").alias("Month_End"), C.days_in_month("Date").alias("Days_In_Month"))


@query("c12_fin_year", oracle="""
SELECT Id, CASE WHEN month(Date) >= 4 THEN CAST(year(Date) AS VARCHAR) || '/' || CAST(year(Date) + 1 AS VARCHAR)
                ELSE CAST(year(Date) - 1 AS VARCHAR) || '/' || CAST(year(Date) AS VARCHAR) END AS FY FROM v_datetext""")
def c12(spark, sf):
    return view(spark, sf, "v_datetext").select("Id", C.fin_year("Date").alias("FY"))


@query("c13_edition", oracle="""
SELECT o_orderkey, Edition, substr(Edition, 3, 2) || '/' || substr(Edition, 8, 2) AS Short_Edition,
       CAST(year(Snapshot_Date) - 1 AS VARCHAR) || '/' || CAST(year(Snapshot_Date) AS VARCHAR) AS From_Year FROM v_status""")
def c13(spark, sf):
    return view(spark, sf, "v_status").select(
        "o_orderkey", "Edition", C.short_edition("Edition").alias("Short_Edition"),
        C.edition(F.year("Snapshot_Date")).alias("From_Year"))


STATUS_MAP = {"STANDARDS MET (19-20)": "STANDARDS MET", "NONE": "NOT SUBMITTED"}


@query("c14_norm_status", oracle="""
SELECT o_orderkey, CASE upper(trim(Status)) WHEN 'STANDARDS MET (19-20)' THEN 'STANDARDS MET'
                        WHEN 'NONE' THEN 'NOT SUBMITTED' ELSE upper(trim(Status)) END AS Status_Norm FROM v_status""")
def c14(spark, sf):
    return view(spark, sf, "v_status").select("o_orderkey", C.norm_status("Status", STATUS_MAP).alias("Status_Norm"))


@query("c15_prefix", oracle="SELECT l_orderkey, l_linenumber, substr(recipientOdsCode, 1, 3) AS Trust FROM v_acks")
def c15(spark, sf):
    return view(spark, sf, "v_acks").select("l_orderkey", "l_linenumber", C.prefix("recipientOdsCode", 3).alias("Trust"))


@query("c16_nbsp", oracle="SELECT Id, replace(Nbsp_Text, chr(160), '') AS Clean FROM v_text")
def c16(spark, sf):
    return view(spark, sf, "v_text").select("Id", C.strip_nbsp("Nbsp_Text").alias("Clean"))


@query("c17_regex_replace", oracle="""
SELECT Id, regexp_replace(Supplier, '^[0-9]+', 'UNKNOWN') AS Supplier_Clean,
       regexp_replace(Provider, 'Cie$', '') AS Provider_Clean FROM v_text""")
def c17(spark, sf):
    return view(spark, sf, "v_text").select(
        "Id", C.regex_replace("Supplier", r"^\d+", "UNKNOWN").alias("Supplier_Clean"),
        C.regex_replace("Provider", "Cie$", "").alias("Provider_Clean"))


@query("c18_sentence_case", oracle="""
SELECT Id, upper(substr(s, 1, 1)) || lower(substr(s, 2)) AS Sentence FROM
  (SELECT Id, regexp_replace(Camel, '(\\w)([A-Z])', '\\1 \\2', 'g') AS s FROM v_text) t""")
def c18(spark, sf):
    return view(spark, sf, "v_text").select("Id", C.sentence_case("Camel").alias("Sentence"))


@query("c19_fill", oracle="""
SELECT o_orderkey, coalesce(Supplier, 'Unknown') AS Supplier FROM v_weekly""")
def c19(spark, sf):
    return view(spark, sf, "v_weekly").select("o_orderkey", C.fill("Supplier", "Unknown").alias("Supplier"))


@query("c20_nullif", oracle="""
SELECT event_id, CASE WHEN lower(trim(ValueText)) IN ('', 'null') THEN NULL ELSE ValueText END AS Text_Or_Null,
       CASE WHEN Value - 10 >= 0 THEN Value - 10 END AS Non_Negative FROM v_usage""")
def c20(spark, sf):
    return view(spark, sf, "v_usage").select(
        "event_id", C.null_if_blank("ValueText").alias("Text_Or_Null"),
        C.null_if_negative(F.col("Value") - 10).alias("Non_Negative"))


@query("c21_round", oracle="""
SELECT Id, CAST(floor(Price / 7) AS BIGINT) AS Floor_, CAST(round_even(Price / 7, 0) AS DOUBLE) AS R0,
       CAST(round_even(Price / 7, 2) AS DOUBLE) AS R2, CAST(round_even(Price / 7, 4) AS DOUBLE) AS R4,
       TRY_CAST(Pct_Text AS BIGINT) AS As_Int FROM v_text""")
def c21(spark, sf):
    x = F.col("Price") / 7
    return view(spark, sf, "v_text").select(
        "Id", F.floor(x).cast("long").alias("Floor_"), C.round_half_even(x, 0).alias("R0"),
        C.round_half_even(x, 2).alias("R2"), C.round_half_even(x, 4).alias("R4"),
        F.col("Pct_Text").try_cast("long").alias("As_Int"))


@query("c22_split", oracle="""
SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS Host FROM pages""")
def c22(spark, sf):
    from strata.sources.tables import table
    return table(spark, sf, "pages", ["page_id", "url"]).select(
        "page_id", C.first_segment(F.regexp_replace("url", "^https?://", ""), "/").alias("Host"))


@query("c23_has_digit", oracle="SELECT Id, regexp_matches(Supplier, '[0-9]') AS Has_Digit FROM v_text")
def c23(spark, sf):
    return view(spark, sf, "v_text").select("Id", C.has_digit("Supplier").alias("Has_Digit"))


@query("c24_year_token", oracle="""
SELECT Id, replace(CASE WHEN len(h) > 0 THEN h[-1] ELSE toks[1] END, '_', '/') AS Token FROM
  (SELECT Id, string_split(File_Name, ' ') AS toks,
          list_filter(string_split(File_Name, ' '), lambda t: contains(t, CAST(Year AS VARCHAR))) AS h FROM v_datetext) t""")
def c24(spark, sf):
    return view(spark, sf, "v_datetext").select("Id", C.year_token("File_Name", F.col("Year")).alias("Token"))


@query("c25_date_valid", oracle="""
SELECT Id, coalesce(CAST(TRY_STRPTIME(Date_Text, '%Y-%m-%d') AS DATE), DATE '1900-01-01') AS Valid_Date FROM v_datetext""",
       dates=["Valid_Date"])
def c25(spark, sf):
    return view(spark, sf, "v_datetext").select("Id", C.date_or_sentinel("Date_Text").alias("Valid_Date"))


@query("c26_strip3", oracle="SELECT Id, substr(File_Name, 4) AS Rest FROM v_datetext")
def c26(spark, sf):
    return view(spark, sf, "v_datetext").select("Id", C.strip_leading("File_Name", 3).alias("Rest"))


# ---------------------------------------------------------------- P10-P17
@query("p10_row_sum", oracle="""
SELECT Daily, coalesce(Fulfilled, 0) + coalesce(Open, 0) + coalesce(Pending, 0) AS Total FROM v_monthly""", dates=["Daily"])
def p10(spark, sf):
    return view(spark, sf, "v_monthly").select("Daily", C.row_sum(["Fulfilled", "Open", "Pending"]).alias("Total"))


@query("p11_add", oracle="SELECT Daily, Fulfilled + Open AS F_Plus_O FROM v_monthly", dates=["Daily"])
def p11(spark, sf):
    return view(spark, sf, "v_monthly").select("Daily", C.add(["Fulfilled", "Open"]).alias("F_Plus_O"))


@query("p12_ratio", oracle="""
SELECT Daily, CAST(round_even(CAST(Fulfilled AS DOUBLE) / nullif(Orders, 0), 4) AS DOUBLE) AS Share_Fulfilled,
       CAST(round_even(CAST(Open AS DOUBLE) / nullif(Fulfilled - Fulfilled, 0), 4) AS DOUBLE) AS By_Zero FROM v_monthly""",
       dates=["Daily"])
def p12(spark, sf):
    return view(spark, sf, "v_monthly").select(
        "Daily", C.ratio("Fulfilled", "Orders", 4).alias("Share_Fulfilled"),
        C.ratio("Open", F.col("Fulfilled") - F.col("Fulfilled"), 4).alias("By_Zero"))


@query("p13_rate", oracle="""
SELECT Daily, CAST(Revenue AS DOUBLE) / (CAST(Orders AS DOUBLE) / 1000.0) AS Per_1000 FROM v_monthly""", dates=["Daily"])
def p13(spark, sf):
    return view(spark, sf, "v_monthly").select("Daily", C.rate("Revenue", "Orders", 1000).alias("Per_1000"))


@query("p14_residual", oracle="""
SELECT Daily, Orders - Fulfilled AS Not_Fulfilled FROM v_monthly WHERE Orders - Fulfilled > 0""", dates=["Daily"])
def p14(spark, sf):
    v = view(spark, sf, "v_monthly").select("Daily", C.residual("Orders", "Fulfilled").alias("Not_Fulfilled"))
    return v.filter(F.col("Not_Fulfilled") > 0)


@query("p15_inf", oracle="""
SELECT Daily, CASE WHEN Fulfilled % 3 = 0 AND Pending <> 0 THEN 0.0
                   ELSE CAST(Pending AS DOUBLE) / nullif(Fulfilled % 3, 0) END AS Ratio FROM v_monthly""", dates=["Daily"])
def p15(spark, sf):
    return view(spark, sf, "v_monthly").select("Daily", C.inf_to_zero("Pending", F.col("Fulfilled") % 3).alias("Ratio"))


@query("p16_override", oracle="SELECT Daily, coalesce(Open, Fulfilled) AS Open_Or_Fulfilled FROM v_monthly", dates=["Daily"])
def p16(spark, sf):
    return view(spark, sf, "v_monthly").select("Daily", C.override("Fulfilled", "Open").alias("Open_Or_Fulfilled"))


@query("p17_round_all", oracle="""
SELECT o_orderkey, CAST(round_even(o_totalprice / 3, 2) AS DOUBLE) AS Third, CAST(round_even(o_totalprice / 7, 2) AS DOUBLE) AS Seventh,
       o_custkey FROM orders""")
def p17(spark, sf):
    from strata.sources.tables import table
    o = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 3).alias("Third"), (F.col("o_totalprice") / 7).alias("Seventh"), "o_custkey")
    return round_all(o, 2)
