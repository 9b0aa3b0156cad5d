"""Scans, sources and sinks (S1-S17): data is written to the shared scratch
folder (``spark.checkpoint.dir``) in the drop layout, then read back."""
import uuid

from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.projection import with_row_id
from strata.plans.registry import query
from strata.plans.standins import view
from strata.session import scratch_path
from strata.sources import files as S
from strata.sources.paged import read_pages
from strata.sources.tables import table

NATION_SCHEMA = "n_nationkey INT, n_name STRING, n_regionkey INT"


def _snap_orders(spark, sf, label):
    o = table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    root = scratch_path(spark, "snapshots")
    S.write_snapshot(o.withColumn("snapshot_date", label).drop("o_orderdate"), root)
    return root


@query("s1_latest_snapshot", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, last_day(CAST(o_orderdate AS DATE)) AS snapshot_date FROM orders
WHERE last_day(CAST(o_orderdate AS DATE)) = (SELECT max(last_day(CAST(o_orderdate AS DATE))) FROM orders)""", dates=["snapshot_date"])
def s1(spark, sf):
    root = _snap_orders(spark, sf, F.last_day(F.to_date("o_orderdate")))
    return S.read_latest(spark, root)


@query("s2_list_snapshots", oracle="""
SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS snapshot_date FROM orders ORDER BY 1 DESC""", dates=["snapshot_date"])
def s2(spark, sf):
    root = _snap_orders(spark, sf, F.last_day(F.to_date("o_orderdate")))
    return S.list_snapshots(spark, root)


@query("s3_latest_per_month_scan", oracle="""
WITH w AS (SELECT o_orderkey, o_custkey, o_totalprice, CAST(date_trunc('week', o_orderdate) AS DATE) AS snapshot_date FROM orders)
SELECT * FROM w WHERE snapshot_date IN (SELECT max(snapshot_date) FROM w GROUP BY date_trunc('month', snapshot_date))""", dates=["snapshot_date"])
def s3(spark, sf):
    root = _snap_orders(spark, sf, F.to_date(F.date_trunc("week", "o_orderdate")))
    return S.read_month_end_snapshots(spark, root)


@query("s4_glob_scan", oracle="SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey < 2")
def s4(spark, sf):
    n = table(spark, sf, "nation")
    root = scratch_path(spark, "landing")
    S.write_csv(n.filter(F.col("n_regionkey") < 2), f"{root}/usage_2024-01-07")
    S.write_csv(n.filter(F.col("n_regionkey") >= 2), f"{root}/jumpoff_2024-01-07")
    return S.read_matching(spark, root, "*usage*", schema=NATION_SCHEMA, options={"header": "true"})


@query("s5_csv_roundtrip", oracle="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s5(spark, sf):
    path = scratch_path(spark, "csv")
    S.write_csv(table(spark, sf, "nation"), path)
    return S.read_csv(spark, path, schema=NATION_SCHEMA, encoding="ISO-8859-1", columns=["n_nationkey", "n_name", "n_regionkey"])


@query("s6_projected_scan", oracle="SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 25")
def s6(spark, sf):
    from strata.sources.tables import table_path
    return S.read_parquet(spark, table_path(sf, "lineitem"), ["l_orderkey", "l_quantity"]).filter(F.col("l_quantity") > 25)


@query("s7_folder_union", oracle="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s7(spark, sf):
    path = scratch_path(spark, "folder")
    table(spark, sf, "nation").repartition(3, "n_regionkey").write.option("header", True).csv(path)
    return S.read_folder_union(spark, path, schema=NATION_SCHEMA)


@query("s8_json_flatten", oracle="SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def s8(spark, sf):
    return S.flatten_json(table(spark, sf, "events", ["event_id", "props"]), "props", "k BIGINT", fields={"k": "k"}, keep=["event_id"])


@query("s8_json_records", oracle="""
SELECT o_custkey, o_orderkey, price, CAST(seq AS INTEGER) AS seq FROM (
  SELECT o_custkey, o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS seq FROM orders) t""")
def s8b(spark, sf):
    """A JSON object with an array of records per customer, flattened to one row per record."""
    o = table(spark, sf, "orders", ["o_custkey", "o_orderkey", "o_totalprice"])
    item = F.struct("o_orderkey", F.struct(F.floor("o_totalprice").cast("long").alias("price")).alias("amount"))
    docs = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(item)).alias("items"))
    docs = docs.select("o_custkey", F.to_json(F.struct(F.transform("items", lambda x, i: F.struct(
        x["o_orderkey"].alias("id"), x["amount"].alias("amount"), (i + 1).alias("seq"))).alias("records"))).alias("body"))
    schema = "records ARRAY<STRUCT<id: BIGINT, amount: STRUCT<price: BIGINT>, seq: INT>>"
    return S.flatten_json(docs, "body", schema, array_path="records",
                          fields={"o_orderkey": "id", "price": "amount.price", "seq": "seq"}, keep=["o_custkey"])


_NUMS = """list_filter(string_split(trim(regexp_replace(translate(regexp_replace(html, '<[^>]*>', ' ', 'g'), ',%()', ''), '\\s+', ' ', 'g')), ' '),
  lambda t: regexp_full_match(t, '[0-9]+'))"""


@query("s9_page_numbers", oracle=f"""
SELECT page_id, TRY_CAST(n[1] AS BIGINT) AS first_number, TRY_CAST(n[2] AS BIGINT) AS second_number, TRY_CAST(n[3] AS BIGINT) AS third_number
FROM (SELECT page_id, {_NUMS} AS n FROM pages) t""")
def s9(spark, sf):
    return S.extract_page_numbers(table(spark, sf, "pages"), "html", ["first_number", "second_number", "third_number"], keep=["page_id"])


@query("s9_page_links", oracle="""
SELECT page_id, href FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages) t WHERE contains(href, '/the')""")
def s9b(spark, sf):
    return S.page_links(table(spark, sf, "pages"), "html", "/the", keep=["page_id"])


@query("s10_table_read", oracle="SELECT r_regionkey, r_name FROM region")
def s10(spark, sf):
    name = f"strata_region_{uuid.uuid4().hex[:8]}"
    S.write_table(table(spark, sf, "region"), name, path=scratch_path(spark, name))
    return S.read_table(spark, name)


@query("s11_table_write", oracle="SELECT CAST(2 * count(*) AS BIGINT) AS rows FROM orders")
def s11(spark, sf):
    name = f"strata_orders_{uuid.uuid4().hex[:8]}"
    S.write_table(table(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), name, path=scratch_path(spark, name))
    S.write_table(table(spark, sf, "orders", ["o_orderkey", "o_totalprice"]), name, mode="append")
    return S.read_table(spark, name).groupBy().agg(F.count(F.lit(1)).cast("long").alias("rows"))


@query("s12_snapshot_sink", oracle="SELECT o_orderkey, o_totalprice, DATE '2024-02-01' AS snapshot_date FROM orders", dates=["snapshot_date"])
def s12(spark, sf):
    root = scratch_path(spark, "sink")
    o = table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    S.write_snapshot(o, root, "2024-02-01")
    S.write_snapshot(o, root, "2024-02-01")  # idempotent: the partition is replaced, not doubled
    S.write_snapshot(o.limit(0), root, "2024-02-08")
    return S.read_snapshots(spark, root)


@query("s13_csv_sink", oracle="""
SELECT n_nationkey, n_name, n_regionkey, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS Unique_ID FROM nation""")
def s13(spark, sf):
    from strata.operators.projection import with_row_id
    path = scratch_path(spark, "metric_csv")
    S.write_csv(with_row_id(table(spark, sf, "nation"), ["n_nationkey"]), path)
    return S.read_csv(spark, path, schema="n_nationkey INT, n_name STRING, n_regionkey INT, Unique_ID LONG")


@query("s14_ctas", oracle="""
SELECT n.n_name, CAST(count(*) AS BIGINT) AS customers FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")
def s14(spark, sf):
    tag = uuid.uuid4().hex[:8]
    S.register_views({f"c_{tag}": table(spark, sf, "customer"), f"n_{tag}": table(spark, sf, "nation")})
    path = scratch_path(spark, "wide")
    out = S.ctas(spark, f"wide_{tag}", f"""SELECT n.n_name, CAST(count(*) AS BIGINT) AS customers FROM c_{tag} c
        JOIN n_{tag} n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""", path)
    schema = out.schema
    S.drop_table(spark, f"wide_{tag}")
    return spark.read.schema(schema).parquet(path)


@query("s15_bundle", oracle="""
SELECT n_nationkey, n_name, n_regionkey, NULL::INTEGER AS r_regionkey, NULL::VARCHAR AS r_name, 'nation' AS "table" FROM nation
UNION ALL SELECT NULL, NULL, NULL, r_regionkey, r_name, 'region' FROM region""")
def s15(spark, sf):
    path = scratch_path(spark, "bundle")
    S.write_bundle(path, {"nation": table(spark, sf, "nation"), "region": table(spark, sf, "region")})
    return S.read_bundle(spark, path)


@query("s16_paged_union", oracle="SELECT c_custkey, c_name FROM customer")
def s16(spark, sf):
    c = table(spark, sf, "customer", ["c_custkey", "c_name"])
    # result pages of a paged source (here: three key ranges) appended into one table
    pages = [c.filter(F.col("c_custkey") < 500), c.filter((F.col("c_custkey") >= 500) & (F.col("c_custkey") < 1000)),
             c.filter(F.col("c_custkey") >= 1000)]
    return S.paged_union(pages)


@query("s16_paged_source", oracle="SELECT c_custkey, c_name FROM customer")
def s16b(spark, sf):
    """Numbered pages of 100 rows as JSON lines, read by a data source that goes on until the first empty page."""
    root = scratch_path(spark, "pages")
    c = with_row_id(table(spark, sf, "customer", ["c_custkey", "c_name"]), ["c_custkey"], "row")
    pages = c.select(F.floor(F.col("row") / 100).alias("page"), F.to_json(F.struct("c_custkey", "c_name")).alias("value"))
    pages.repartition("page").write.partitionBy("page").text(root)
    return read_pages(spark, root, "c_custkey long, c_name string")


@query("s17_date_from_name", oracle="""
SELECT Id, File_Name, CASE WHEN d > DATE '2000-01-01' THEN CAST(d - INTERVAL 12 MONTH AS DATE) ELSE d END AS snapshot_date FROM
 (SELECT Id, File_Name, CAST(TRY_STRPTIME(regexp_extract(File_Name, '([0-9]{4}_[0-9]{2})', 1), '%Y_%m') AS DATE) AS d FROM v_datetext) t""",
       dates=["snapshot_date"])
def s17(spark, sf):
    d = view(spark, sf, "v_datetext").select("Id", "File_Name")
    return S.with_snapshot_date(d, source="text", text_col="File_Name", pattern=r"(\d{4}_\d{2})", fmt="yyyy_MM",
                                fix_future=True, today="2000-01-01")


@query("s17_date_from_path", oracle="""
SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM orders""", dates=["snapshot_date"])
def s17b(spark, sf):
    """Drops in folders whose names carry the date; every row is stamped from the path of its file."""
    root = scratch_path(spark, "dated")
    o = table(spark, sf, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    month = F.date_format(F.trunc("o_orderdate", "MM"), "yyyy-MM-dd")
    o.withColumn("drop", month).drop("o_orderdate").repartition("drop").write.partitionBy("drop").parquet(root)
    rows = spark.read.option("recursiveFileLookup", "true").schema("o_orderkey LONG, o_totalprice DOUBLE").parquet(root)
    return S.with_snapshot_date(rows, source="path", pattern=r"drop=(\d{4}-\d{2}-\d{2})")


@query("s9_page_as_of", oracle="""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS As_Of FROM orders""", dates=["As_Of"])
def s9c(spark, sf):
    """Pages with their "current as of" date in several layouts, some without."""
    o = table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    day = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "d MMMM yyyy")).when(
        F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    intro = F.when(F.col("o_orderkey") % 4 == 3, "<p>Published ").otherwise("<p>Data current as of <b>")
    pages = o.select("o_orderkey", F.concat(F.lit("<html><h1>12,345 records</h1>"), intro, day, F.lit("</b></p></html>")).alias("html"))
    return S.page_as_of(pages, "html", keep=["o_orderkey"])
