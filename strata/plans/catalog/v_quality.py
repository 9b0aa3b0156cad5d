"""Data-quality checks and run logs."""
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import quality as Q
from strata.operators import sketches as SK
from strata.operators import timeseries as W
from strata.plans.registry import query
from strata.plans.standins import view
from strata.session import scratch_path
from strata.sources.tables import table


def _row(check, column, obs, lo="NULL", hi="NULL", src="", hard=True):
    col = "NULL" if column is None else f"'{column}'"
    return f"""SELECT '{check}' AS "check", CAST({col} AS VARCHAR) AS "column", CAST({obs} AS DOUBLE) AS observed,
  CAST({lo} AS DOUBLE) AS min_value, CAST({hi} AS DOUBLE) AS max_value,
  ((coalesce(CAST({obs} AS DOUBLE) >= CAST({lo} AS DOUBLE), true) AND coalesce(CAST({obs} AS DOUBLE) <= CAST({hi} AS DOUBLE), true)
    AND CAST({obs} AS DOUBLE) IS NOT NULL) OR (CAST({lo} AS DOUBLE) IS NULL AND CAST({hi} AS DOUBLE) IS NULL)) AS success,
  {str(hard).lower()} AS hard {src}"""


@query("v1_not_null", oracle=_row("not_null", "ValueText", "count_if(nullif(trim(ValueText), '') IS NULL)", 0, 0, "FROM v_usage"))
def v1(spark, sf):
    return Q.run_suite(view(spark, sf, "v_usage"), [Q.Check.not_null("ValueText")])


@query("v2_unique", oracle=_row("unique", "Location", "count(Location) - count(DISTINCT Location)", 0, 0, "FROM v_answers"))
def v2(spark, sf):
    return Q.run_suite(view(spark, sf, "v_answers"), [Q.Check.unique("Location")])


_STATUSES = ["Standards Exceeded", "Standards Met", "STANDARDS MET (19-20)", "Approaching Standards"]


@query("v3_in_set", oracle=_row("in_set", "Status", "count_if(Status IS NOT NULL AND Status NOT IN ('Standards Exceeded', 'Standards Met', "
                                "'STANDARDS MET (19-20)', 'Approaching Standards'))", 0, 0, "FROM v_status"))
def v3(spark, sf):
    return Q.run_suite(view(spark, sf, "v_status"), [Q.Check.in_set("Status", _STATUSES)])


@query("v4_type", oracle=_row("type_double", "ValueText", "count_if(ValueText IS NOT NULL AND TRY_CAST(ValueText AS DOUBLE) IS NULL)", 0, 0,
                              "FROM v_usage") + " UNION ALL " + _row(
                                  "type_is_bigint", "o_custkey", "CAST(count_if(column_name = 'o_custkey' AND column_type = 'BIGINT') AS DOUBLE)", 1, 1,
                                  "FROM (DESCRIBE orders)"))
def v4(spark, sf):
    u, o = view(spark, sf, "v_usage"), table(spark, sf, "orders")
    return Q.run_suite(u, [Q.Check.castable("ValueText", "double")]).unionByName(
        Q.run_suite(o, [Q.Check.type_is(o, "o_custkey", "bigint")]))


@query("v5_row_count", oracle=_row("row_count", None, "count(*)", 10000, 20000, "FROM orders"))
def v5(spark, sf):
    return Q.run_suite(table(spark, sf, "orders"), [Q.Check.row_count(10000, 20000)])


@query("v6_sum_between", oracle=_row("sum_between", "Clicks", "sum(Clicks)", 100000, 1000000, "FROM v_clicks"))
def v6(spark, sf):
    return Q.run_suite(view(spark, sf, "v_clicks"), [Q.Check.sum_between("Clicks", 100000, 1000000)])


@query("v7_distinct_between", oracle=_row("distinct_between", "OdsCode", "count(DISTINCT OdsCode)", 100, 200, "FROM v_clicks"))
def v7(spark, sf):
    return Q.run_suite(view(spark, sf, "v_clicks"), [Q.Check.distinct_between("OdsCode", 100, 200)])


@query("v8_between", oracle=_row("values_between", "Clicks", "count_if(Clicks < 1 OR Clicks > 99)", 0, 0, "FROM v_clicks"))
def v8(spark, sf):
    return Q.run_suite(view(spark, sf, "v_clicks"), [Q.Check.between("Clicks", 1, 99)])


@query("v9_increasing", oracle=_row("increasing", "Cum_Revenue", "(SELECT count_if(nxt < v) FROM (SELECT v, lead(v) OVER (ORDER BY Month) AS nxt FROM "
                                    "(SELECT Month, sum(r) OVER (ORDER BY Month ROWS UNBOUNDED PRECEDING) AS v FROM "
                                    "(SELECT strftime(Daily, '%Y-%m') AS Month, sum(Revenue) AS r FROM v_monthly GROUP BY 1) a) b) c)", 0, 0))
def v9(spark, sf):
    m = W.cumsum(A.monthly_sum(view(spark, sf, "v_monthly"), "Daily", ["Revenue"]), ["Month"], ["Revenue"], names={"Revenue": "Cum_Revenue"})
    return Q.run_suite(m, [Q.Check.increasing(m, "Cum_Revenue", ["Month"])])


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("v10_columns", oracle=_row("columns", None, f"""CAST(count(*) = {len(_ORDER_COLS)} AND count_if(column_name IN ({', '.join(f"'{c}'" for c in _ORDER_COLS)})) = count(*) AS DOUBLE)""",
                                  1, 1, "FROM (DESCRIBE orders)"))
def v10(spark, sf):
    o = table(spark, sf, "orders")
    return Q.run_suite(o, [Q.Check.columns(o, _ORDER_COLS)])


@query("v11_no_zero_days", oracle=_row("no_zero_days", "Acks", """(WITH a AS (SELECT CAST(_time AS DATE) AS d, count(*) AS n FROM v_acks GROUP BY 1),
  c AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM a), (SELECT max(d) FROM a), INTERVAL 1 DAY)) AS DATE) AS d)
  SELECT count(*) FROM c LEFT JOIN a ON c.d = a.d WHERE coalesce(a.n, 0) = 0 AND c.d <> DATE '1995-01-07')""", 0, 0))
def v11(spark, sf):
    v = view(spark, sf, "v_acks").select("_time", F.lit(1).alias("Acks"))
    return Q.run_suite(v, [Q.Check.no_zero_days(v, "_time", "Acks", ignore=["1995-01-07"])])


_MONTHLY = "(SELECT strftime(o_orderdate, '%Y-%m') AS Month, count(*) AS Orders FROM orders GROUP BY 1)"


@query("v12_threshold", oracle=f"""
SELECT Month, Orders, Prev, CAST(Prev - round_even(0.1 * Prev, 0) AS DOUBLE) AS min_value, CAST(Prev + round_even(0.1 * Prev, 0) AS DOUBLE) AS max_value,
       coalesce(Orders BETWEEN Prev - round_even(0.1 * Prev, 0) AND Prev + round_even(0.1 * Prev, 0), true) AS within
FROM (SELECT Month, CAST(Orders AS BIGINT) AS Orders, CAST(lag(Orders) OVER (ORDER BY Month) AS BIGINT) AS Prev FROM {_MONTHLY} m) t""")
def v12(spark, sf):
    from pyspark.sql import Window
    m = A.count_by(table(spark, sf, "orders").withColumn("Month", F.date_format("o_orderdate", "yyyy-MM")), ["Month"], name="Orders")
    # one row per month: the window is bounded by the calendar
    m = m.withColumn("Prev", F.lag("Orders").over(Window.orderBy("Month")))
    lo, hi = Q.threshold(F.col("Prev"), 10)
    return m.select("Month", "Orders", "Prev", lo.cast("double").alias("min_value"), hi.cast("double").alias("max_value"),
                    F.coalesce((F.col("Orders") >= lo) & (F.col("Orders") <= hi), F.lit(True)).alias("within"))


def _preload(spark, sf):
    """A pre-load log derived from orders: one row per monthly file."""
    o = table(spark, sf, "orders")
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("m")).agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(
        "row_count", F.to_timestamp(F.concat("m", F.lit("-01"))).alias("load_date"),
        F.concat(F.lit("orders_"), "m", F.lit(".csv")).alias("file_to_load"))


_PRELOAD_SQL = """(SELECT CAST(count(*) AS BIGINT) AS row_count, CAST(strftime(o_orderdate, '%Y-%m') || '-01' AS TIMESTAMP) AS load_date,
  'orders_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS file_to_load FROM orders GROUP BY 2, 3)"""


@query("v13_last_log", oracle=f"""
SELECT * FROM {_PRELOAD_SQL} l WHERE contains(file_to_load, 'orders_') AND load_date = (SELECT max(load_date) FROM {_PRELOAD_SQL} x
  WHERE contains(file_to_load, 'orders_'))""", dates=["load_date"])
def v13(spark, sf):
    return Q.last_log(_preload(spark, sf), "file_to_load", "orders_")


@query("v14_drift", oracle=_row("drift", None, f"(SELECT row_count FROM {_PRELOAD_SQL} a WHERE load_date = (SELECT max(load_date) FROM {_PRELOAD_SQL} b))",
       f"(SELECT p - round_even(0.1 * p, 0) FROM (SELECT row_count AS p FROM {_PRELOAD_SQL} c ORDER BY load_date DESC LIMIT 1 OFFSET 1))",
       f"(SELECT p + round_even(0.1 * p, 0) FROM (SELECT row_count AS p FROM {_PRELOAD_SQL} c ORDER BY load_date DESC LIMIT 1 OFFSET 1))"))
def v14(spark, sf):
    log = _preload(spark, sf).filter(F.col("file_to_load").contains("orders_"))
    two = Q.last_two(log.groupBy("load_date").agg(F.max("row_count").alias("rows")), "load_date")
    return Q.run_suite(two, [Q.drift(F.col("now_rows"), F.col("prev_rows"), 10)], one_row=True)


_MEASURES = ["Orders", "Revenue", "Fulfilled"]


@query("v15_column_drift", oracle=" UNION ALL ".join(
    _row("column_drift", m, f"(SELECT sum({m}) FROM v_monthly WHERE strftime(Daily, '%Y-%m') = (SELECT max(strftime(Daily, '%Y-%m')) FROM v_monthly))",
         f"(SELECT p - round_even(0.3 * p, 0) FROM (SELECT sum({m}) AS p FROM v_monthly GROUP BY strftime(Daily, '%Y-%m') ORDER BY strftime(Daily, '%Y-%m') DESC LIMIT 1 OFFSET 1))",
         f"(SELECT p + round_even(0.3 * p, 0) FROM (SELECT sum({m}) AS p FROM v_monthly GROUP BY strftime(Daily, '%Y-%m') ORDER BY strftime(Daily, '%Y-%m') DESC LIMIT 1 OFFSET 1))")
    for m in _MEASURES))
def v15(spark, sf):
    v = view(spark, sf, "v_monthly").withColumn("Month", F.date_format("Daily", "yyyy-MM"))
    two = Q.last_two(A.monthly_sum(v, "Daily", _MEASURES, name="Month"), "Month")
    checks = [Q.drift(F.col(f"now_{m}"), F.col(f"prev_{m}"), 30, name="column_drift", column=m) for m in _MEASURES]
    return Q.run_suite(two, checks, one_row=True)


@query("v16_not_decreasing", oracle=_row("not_decreasing", "Answer", "(SELECT count_if(Answer = 'Yes') FROM v_answers)",
       "(SELECT count_if(Answer = 'Yes') FROM v_answers WHERE Date < (SELECT CAST(date_trunc('month', max(Date)) AS DATE) FROM v_answers))"))
def v16(spark, sf):
    a = view(spark, sf, "v_answers")
    cut = a.select(F.trunc(F.max("Date"), "MM")).scalar()
    prev = a.filter(F.col("Date") < cut).select(F.count_if(F.col("Answer") == "Yes")).scalar()
    return Q.run_suite(a, [Q.not_decreasing(F.count_if(F.col("Answer") == "Yes"), prev, "Answer")])


@query("v17_unchanged", oracle=_row("distinct_between", "Supplier", "(SELECT count(DISTINCT Supplier) FROM v_messages WHERE Date = (SELECT max(Date) FROM v_messages))",
       "(SELECT count(DISTINCT Supplier) FROM v_messages WHERE Date = (SELECT max(Date) FROM v_messages WHERE Date < (SELECT max(Date) FROM v_messages)))",
       "(SELECT count(DISTINCT Supplier) FROM v_messages WHERE Date = (SELECT max(Date) FROM v_messages WHERE Date < (SELECT max(Date) FROM v_messages)))",
       hard=False))
def v17(spark, sf):
    m = view(spark, sf, "v_messages")
    two = Q.last_two(m.groupBy("Date").agg(F.count_distinct("Supplier").alias("n")), "Date")
    return Q.run_suite(two, [Q.Check("distinct_between", F.col("now_n"), F.col("prev_n"), F.col("prev_n"), "Supplier", hard=False)], one_row=True)


_DROPS = "(SELECT max(Date) FROM v_eps)", "(SELECT max(Date) FROM v_eps WHERE Date < (SELECT max(Date) FROM v_eps))"


def _change(c):
    now, prev = (f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS x FROM v_eps WHERE Date = {d} AND {c} IS NOT NULL)" for d in _DROPS)
    return f"""SELECT 'eps' AS file_name, '{c}' AS "column", n.now, n.previous, n.added, n.removed,
  n.over_runs, true AS certain, n.added = 0 AND n.removed = 0 AS unchanged FROM (SELECT
  (SELECT count(*) FROM {now} a) AS now, (SELECT count(*) FROM {prev} a) AS previous,
  (SELECT count(*) FROM {now} a WHERE x NOT IN (SELECT x FROM {prev} b)) AS added,
  (SELECT count(*) FROM {prev} a WHERE x NOT IN (SELECT x FROM {now} b)) AS removed,
  (SELECT count(DISTINCT CAST({c} AS VARCHAR)) FROM v_eps) AS over_runs) n"""


@query("v17_unchanged_from_log", oracle=" UNION ALL ".join(_change(c) for c in ["ODS_Code", "Date"]))
def v17b(spark, sf):
    """Practices and months of the newest drop against the run log alone: new, gone, and over all runs."""
    path, m = scratch_path(spark, "distinct-log"), view(spark, sf, "v_eps")
    Q.append_log(SK.distinct_log(m, "eps", ["ODS_Code", "Date"], drop="Date"), path)  # the runs so far
    now = SK.distinct_log(m.where(F.col("Date") == m.select(F.max("Date")).scalar()), "eps", ["ODS_Code", "Date"], drop="Date")
    return SK.distinct_change(now, spark.read.parquet(path))


@query("v18_calendar", oracle=_row("calendar", "Date", "count(DISTINCT Date)", "(SELECT dayofmonth(last_day(max(Date))) FROM v_clicks)",
                                   "(SELECT dayofmonth(last_day(max(Date))) FROM v_clicks)", "FROM v_clicks"))
def v18(spark, sf):
    v = view(spark, sf, "v_clicks")
    return Q.run_suite(v, [Q.Check.calendar(v, "Date")])


@query("v19_preload_log", oracle="""
SELECT CAST(count(*) AS BIGINT) AS row_count, TIMESTAMP '2024-02-01 00:00:00' AS load_date, 'orders.parquet' AS file_to_load FROM orders""", dates=["load_date"])
def v19(spark, sf):
    """The log row is appended to the run log and read back; files are named without their folder."""
    path = scratch_path(spark, "preload-log")
    log = Q.preload_log(table(spark, sf, "orders"), "2024-02-01 00:00:00")
    Q.append_log(log.withColumn("file_to_load", F.regexp_extract("file_to_load", r"(orders\.parquet)", 1))
                 .groupBy("load_date", "file_to_load").agg(F.sum("row_count").alias("row_count")), path)
    return spark.read.parquet(path).select("row_count", "load_date", "file_to_load")


@query("v20_agg_log", oracle="""
SELECT TIMESTAMP '2024-02-01 00:00:00' AS load_date, 'clicks.parquet' AS file_name, aggregation, aggregate_value, comment FROM (
  SELECT 'count' AS aggregation, CAST(count(*) AS BIGINT) AS aggregate_value, 'rows' AS comment FROM v_clicks
  UNION ALL SELECT 'sum', CAST(sum(Clicks) AS BIGINT), 'Clicks' FROM v_clicks
  UNION ALL SELECT 'distinct', CAST(count(DISTINCT OdsCode) AS BIGINT), 'OdsCode' FROM v_clicks) t""", dates=["load_date"])
def v20(spark, sf):
    v = view(spark, sf, "v_clicks")
    return Q.agg_log(v, "clicks.parquet", {("count", "rows"): F.count(F.lit(1)), ("sum", "Clicks"): F.sum("Clicks"),
                                           ("distinct", "OdsCode"): F.count_distinct("OdsCode")}, "2024-02-01 00:00:00")


@query("v21_postload_log", oracle="""
SELECT TIMESTAMP '2024-02-01 00:00:00' AS load_date, tbl_name, 'count' AS aggregation, aggregate_value FROM (
  SELECT 'orders' AS tbl_name, CAST(count(*) AS BIGINT) AS aggregate_value FROM orders
  UNION ALL SELECT 'customer', CAST(count(*) AS BIGINT) FROM customer
  UNION ALL SELECT 'nation', CAST(count(*) AS BIGINT) FROM nation) t""", dates=["load_date"])
def v21(spark, sf):
    return Q.postload_log({n: table(spark, sf, n) for n in ["orders", "customer", "nation"]}, "2024-02-01 00:00:00")


@query("v22_baseline", oracle=_row("baseline", None, "count(*)", "1500 - round_even(0.1 * 1500, 0)", "1500 + round_even(0.1 * 1500, 0)", "FROM customer"))
def v22(spark, sf):
    return Q.run_suite(table(spark, sf, "customer"), [Q.Check.baseline(1500, 10)])


@query("v23_report", oracle=f"""
SELECT *, CASE WHEN success THEN 'PASS' WHEN hard THEN 'FAILED' ELSE 'WARN' END AS outcome FROM (
{_row("not_null", "OdsCode", "count_if(nullif(trim(CAST(OdsCode AS VARCHAR)), '') IS NULL)", 0, 0, "FROM v_clicks")} UNION ALL
{_row("row_count", None, "count(*)", 1, "NULL", "FROM v_clicks")} UNION ALL
{_row("distinct_between", "Provider", "count(DISTINCT Provider)", 1, 5, "FROM v_clicks")}) t""")
def v23(spark, sf):
    v = view(spark, sf, "v_clicks")
    return Q.report(Q.run_suite(v, [Q.Check.not_null("OdsCode"), Q.Check.row_count(1, None), Q.Check.distinct_between("Provider", 1, 5)]))


@query("v24_arrival", oracle="""
SELECT 'refund' AS feed, (SELECT count(*) > 0 FROM events WHERE event_type = 'refund') AS arrived,
       CASE WHEN (SELECT count(*) > 0 FROM events WHERE event_type = 'refund') THEN 'ran' ELSE 'skipped' END AS status
UNION ALL SELECT 'view', (SELECT count(*) > 0 FROM events WHERE event_type = 'view'),
       CASE WHEN (SELECT count(*) > 0 FROM events WHERE event_type = 'view') THEN 'ran' ELSE 'skipped' END""")
def v24(spark, sf):
    ev = table(spark, sf, "events", ["event_type"])
    rows = []
    for feed in ["refund", "view"]:
        got = Q.arrival(ev.filter(F.col("event_type") == feed))
        rows.append(F.struct(F.lit(feed).alias("feed"), got.alias("arrived"),
                             F.when(got, "ran").otherwise("skipped").alias("status")))
    return spark.range(1).select(F.inline(F.array(*rows)))


_WEEK, _PREVIOUS = "2024-01-15", "2024-01-08"  # Mondays: the week that is validated and the one in the log
_SUITE = ["Logins", "RecordViews", "Prescriptions"]


def _week_of(spark, sf, start):
    u = view(spark, sf, "v_usage_wide").filter((F.col("Date") >= F.lit(start).cast("date")) & (F.col("Date") < F.date_add(F.lit(start).cast("date"), 7)))
    return u.select("Date", "OdsCode", *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in _SUITE])


def _suite_sql(check, column, expr, prev, pct):
    lo, hi = f"p.v - round_even({pct} * p.v, 0)", f"p.v + round_even({pct} * p.v, 0)"
    return f"""SELECT '{check}' AS "check", '{column}' AS "column", CAST(t.v AS DOUBLE) AS observed, CAST({lo} AS DOUBLE) AS min_value,
      CAST({hi} AS DOUBLE) AS max_value, CASE WHEN t.v BETWEEN {lo} AND {hi} THEN 'PASS' ELSE 'FAILED' END AS outcome
      FROM (SELECT {expr} AS v FROM now) t, (SELECT {prev} AS v FROM was) p"""


_EXACT = """SELECT '{c}' AS "check", {col} AS "column", CAST({e} AS DOUBLE) AS observed, CAST({lo} AS DOUBLE) AS min_value, CAST({hi} AS DOUBLE) AS max_value,
      CASE WHEN {e} BETWEEN {lo} AND {hi} THEN 'PASS' ELSE 'FAILED' END AS outcome FROM now"""


@query("v25_usage_suite", oracle=f"""
WITH u AS (SELECT Date, OdsCode, """ + ", ".join(f"coalesce(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _SUITE) + f""" FROM v_usage_wide),
     now AS (SELECT * FROM u WHERE Date >= DATE '{_WEEK}' AND Date < DATE '{_WEEK}' + INTERVAL 7 DAY),
     was AS (SELECT * FROM u WHERE Date >= DATE '{_PREVIOUS}' AND Date < DATE '{_PREVIOUS}' + INTERVAL 7 DAY)
""" + " UNION ALL ".join([
    _EXACT.format(c="calendar", col="'Date'", e="count(DISTINCT Date)", lo=7, hi=7),
    _EXACT.format(c="not_null", col="'OdsCode'", e="count_if(OdsCode IS NULL)", lo=0, hi=0),
    _suite_sql("rows", "rows", "count(*)", "count(*)", 0.1),
    _suite_sql("distinct", "OdsCode", "count(DISTINCT OdsCode)", "count(DISTINCT OdsCode)", 0.1),
    *[_suite_sql("sum", c, f"sum({c})", f"sum({c})", 0.3) for c in _SUITE],
    """SELECT 'log_rows', NULL, CAST(2 * 5 AS DOUBLE), CAST(10 AS DOUBLE), CAST(10 AS DOUBLE), CASE WHEN count(*) >= 0 THEN 'PASS' END FROM now"""]))
def v25(spark, sf):
    """The weekly validation of the usage feed: the previous run's aggregates come from the run log, today's rows, organisations and
    every measure's sum must lie in bands around them, the week has seven days; then today's aggregates are appended to the log."""
    path = scratch_path(spark, "usage-log")
    aggs = {("count", "rows"): F.count(F.lit(1)), ("distinct", "OdsCode"): F.count_distinct("OdsCode"), **{("sum", c): F.sum(c) for c in _SUITE}}
    Q.append_log(Q.agg_log(_week_of(spark, sf, _PREVIOUS), "usage_2024-01-08.parquet", aggs, "2024-01-14 00:00:00"), path)
    now = _week_of(spark, sf, _WEEK)
    log = spark.read.parquet(path)
    last = log.filter(F.col("file_name").contains("usage") & (F.col("load_date") < F.lit("2024-01-21").cast("timestamp")))
    prev = last.groupBy("aggregation", "comment").agg(F.max_by("aggregate_value", "load_date").alias("prev"))
    today = Q.agg_log(now, "usage_2024-01-15.parquet", aggs, "2024-01-21 00:00:00")
    band = F.bround(F.when(F.col("aggregation") == "sum", 0.3).otherwise(0.1) * F.col("prev"), 0)
    named = F.when(F.col("aggregation") == "count", "rows").otherwise(F.col("aggregation"))
    drift = today.join(prev, ["aggregation", "comment"]).select(
        named.alias("check"), F.col("comment").alias("column"), F.col("aggregate_value").cast("double").alias("observed"),
        (F.col("prev") - band).cast("double").alias("min_value"), (F.col("prev") + band).cast("double").alias("max_value"))
    drift = drift.withColumn("outcome", F.when(F.col("observed").between(F.col("min_value"), F.col("max_value")), "PASS").otherwise("FAILED"))
    suite = Q.run_suite(now, [Q.Check.calendar(now, "Date", 7), Q.Check("not_null", F.count_if(F.col("OdsCode").isNull()), 0, 0, "OdsCode")])
    suite = Q.report(suite).select("check", "column", "observed", "min_value", "max_value", "outcome")
    Q.append_log(today, path)
    rows = Q.run_suite(spark.read.parquet(path), [Q.Check("log_rows", F.count(F.lit(1)), 10, 10)])
    return suite.unionByName(drift).unionByName(Q.report(rows).select("check", "column", "observed", "min_value", "max_value", "outcome"))
