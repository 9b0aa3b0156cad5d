"""Stand-in views: the reference domain's feeds expressed over the driver tables.

Each view is one SQL text run by Spark (``parquet.`path` `` sources) and, for
the DuckDB oracle, inlined as a CTE over the pre-registered tables. A view is
either a single text shared by both engines or a ``(spark, duckdb)`` pair
where the dialects differ. Measures are kept integral where the feed allows it
so that sums are exact in both engines.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from strata.sources.tables import TABLES, table_path

# Fixed cut dates used by the stand-ins (history batches, close dates, panels).
HIST_CUT = "1999-01-01"
BATCH_OVERLAP_FROM = "1998-07-01"
CLOSE_CUT = "2001-01-01"

VIEWS: dict[str, str | tuple[str, str]] = {
    # D1 usage: one row per event; ValueText is the measure as dirty text.
    "v_usage": """
        SELECT event_id, CAST(ts AS DATE) AS Date, user_id AS OdsCode, event_type AS Measure,
               value AS Value,
               CASE WHEN event_type = 'error' THEN 'n/a'
                    WHEN event_type = 'signup' AND user_id % 7 = 0 THEN ''
                    ELSE regexp_extract(props, '[0-9]+', 0) END AS ValueText
        FROM {events}""",
    # D1 wide: org x day rows with text measures, as the usage feed lands.
    "v_usage_wide": """
        SELECT CAST(ts AS DATE) AS Date, user_id AS OdsCode,
               CAST(count_if(event_type = 'view') AS STRING) AS Logins,
               CAST(count_if(event_type = 'click') AS STRING) AS RecordViews,
               CASE WHEN count_if(event_type = 'purchase') = 0 THEN 'n/a'
                    ELSE CAST(count_if(event_type = 'purchase') AS STRING) END AS Prescriptions,
               CAST(count_if(event_type = 'signup') AS STRING) AS P9NewAppUsers,
               CAST(count_if(event_type = 'error') AS STRING) AS Errors
        FROM {events} GROUP BY CAST(ts AS DATE), user_id""",
    # D5 channels daily sheet: day grain measures from orders.
    "v_monthly": """
        SELECT CAST(o_orderdate AS DATE) AS Daily,
               CAST(count(*) AS BIGINT) AS Orders,
               CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS Revenue,
               CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS Fulfilled,
               CASE WHEN dayofmonth(CAST(o_orderdate AS DATE)) = 1 THEN NULL
                    ELSE CAST(count_if(o_orderstatus = 'O') AS BIGINT) END AS Open,
               CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS Pending
        FROM {orders} GROUP BY CAST(o_orderdate AS DATE)""",
    # D2 jump-off clicks.
    "v_clicks": """
        SELECT event_id, CAST(ts AS DATE) AS Date, user_id AS OdsCode,
               'P' || CAST(user_id % 5 AS STRING) || CASE WHEN user_id % 10 = 0 THEN 'Cie' ELSE '' END AS Provider,
               event_type || CASE WHEN user_id % 3 = 0 THEN 'CarePlans' ELSE 'MedicalRecord' END AS JumpOff,
               CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS Clicks
        FROM {events}""",
    # D3 device downloads.
    "v_downloads": """
        SELECT CAST(ts AS DATE) AS Date,
               CASE WHEN event_type = 'view' THEN 'Apple' ELSE 'Google' END AS Type,
               CAST(count(*) AS BIGINT) AS Count
        FROM {events}
        GROUP BY CAST(ts AS DATE), CASE WHEN event_type = 'view' THEN 'Apple' ELSE 'Google' END""",
    # D7 long field/value table (practice x month x field), lineitem grain.
    "v_field": """
        SELECT l.l_orderkey, l.l_linenumber, last_day(CAST(l.l_shipdate AS DATE)) AS Report_Period_End,
               o.o_custkey AS Practice_Code, l.l_returnflag AS Field,
               CASE WHEN l.l_linenumber = 7 THEN NULL ELSE l.l_quantity END AS Value,
               CASE WHEN l.l_linestatus = 'F' THEN 'EMIS' ELSE 'TPP' END AS System_Supplier
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    # D8 message acknowledgements (lineitem grain: 80 months of traffic).
    "v_acks": """
        SELECT l_orderkey, l_linenumber, l_shipdate AS _time,
               CASE WHEN l_linenumber = 7 THEN 'TOC_FHIR_OP_ATTEN'
                    ELSE 'TOC_FHIR_' || CASE l_returnflag WHEN 'A' THEN 'EC_DISCH' WHEN 'N' THEN 'IP_DISCH'
                                                          ELSE 'MH_DISCH' END || '_ACK' END AS workflow,
               'S' || CAST(l_suppkey % 50 AS STRING) AS senderOdsCode,
               'R' || CAST(l_orderkey % 40 AS STRING) || 'X' || CAST(l_partkey % 3 AS STRING) AS recipientOdsCode
        FROM {lineitem}""",
    # D9 discharge denominators per provider and day.
    "v_denominator": """
        SELECT CAST(o_orderdate AS DATE) AS Discharge_Date,
               'R' || CAST(o_custkey % 20 AS STRING) AS Provider_Code,
               CAST(count(*) AS BIGINT) AS Discharges
        FROM {orders} GROUP BY CAST(o_orderdate AS DATE), 'R' || CAST(o_custkey % 20 AS STRING)""",
    # D9 mental-health discharges: provider rows (some suppressed) + national rows.
    "v_mh": """
        SELECT Reporting_Period_Start, Primary_Level, Breakdown, Measure_Value,
               CASE WHEN Breakdown = 'Provider' AND (month(Reporting_Period_Start) + length(Primary_Level)) % 5 = 0
                    THEN '*' ELSE CAST(Measure_Value AS STRING) END AS Measure_Value_Str
        FROM (
          SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS Reporting_Period_Start,
                 'R' || CAST(o_custkey % 20 AS STRING) AS Primary_Level, 'Provider' AS Breakdown,
                 CAST(count(*) AS BIGINT) AS Measure_Value
          FROM {orders} GROUP BY Reporting_Period_Start, Primary_Level
          UNION ALL
          SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS Reporting_Period_Start, 'ENG' AS Primary_Level,
                 'England' AS Breakdown, CAST(count(*) + 7 AS BIGINT) AS Measure_Value
          FROM {orders} GROUP BY Reporting_Period_Start) u""",
    # D10 online consultations, practice x week.
    "v_weekly": """
        SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS Week_Commencing,
               o_custkey AS Practice_Code,
               CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS Valid_Practice,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS Submissions,
               CAST(1000 + (o_custkey % 97) * 13 AS BIGINT) AS Practice_Population,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'EMIS' WHEN '2-HIGH' THEN '12Medical'
                    WHEN '3-MEDIUM' THEN NULL ELSE 'TPP' END AS Supplier
        FROM {orders}""",
    # D13/D15/D28 status by organisation and edition.
    "v_status": """
        SELECT o_orderkey, o_custkey AS Code, CAST(o_orderdate AS DATE) AS Snapshot_Date,
               CAST(year(o_orderdate) - 1 AS STRING) || '/' || CAST(year(o_orderdate) AS STRING) AS Edition,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Standards Exceeded'
                    WHEN '2-HIGH' THEN 'Standards Met' WHEN '3-MEDIUM' THEN 'STANDARDS MET (19-20)'
                    WHEN '4-NOT SPECIFIED' THEN 'Approaching Standards' ELSE 'None' END AS Status,
               CASE o_orderstatus WHEN 'F' THEN 'YES' WHEN 'O' THEN 'NO' ELSE 'yes' END AS Compliant
        FROM {orders}""",
    # D16-D18 organisation reference with hierarchy and open/close dates.
    "v_org": """
        SELECT c.c_custkey AS Code, c.c_name AS Name, c.c_mktsegment AS Role,
               n.n_nationkey AS ICB_Code, n.n_name AS ICB_Name,
               r.r_regionkey AS Region_Code, r.r_name AS Region_Name,
               o.open_date AS Open_Date,
               CASE WHEN o.close_date >= DATE '2001-01-01' THEN NULL ELSE o.close_date END AS Close_Date
        FROM {customer} c
        JOIN {nation} n ON c.c_nationkey = n.n_nationkey
        JOIN {region} r ON n.n_regionkey = r.r_regionkey
        LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS open_date,
                          CAST(max(o_orderdate) AS DATE) AS close_date
                   FROM {orders} GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey""",
    # D19 population by area, sex and (top-coded) age.
    "v_pop": """
        SELECT p_partkey AS Pop_Id, p_brand AS Area_Code, p_type AS Sex,
               CASE WHEN p_partkey % 50 = 0 THEN 'ALL' WHEN p_size >= 45 THEN '45+'
                    ELSE CAST(p_size AS STRING) END AS Age,
               CAST(floor(p_retailprice) AS BIGINT) AS Size
        FROM {part}""",
    # D19 registered population per extract, organisation, sex and (top-coded) age.
    "v_stp_pop": """
        SELECT p_partkey AS Pop_Id,
               CASE p_size % 3 WHEN 0 THEN DATE '1996-04-01' WHEN 1 THEN DATE '1997-04-01' ELSE DATE '1998-04-01' END AS EXTRACT_DATE,
               CASE WHEN CAST(floor(p_retailprice * 7) AS BIGINT) % 4 = 0 THEN 'CCG' ELSE 'STP' END AS ORG_TYPE,
               'Brand#' || CAST(p_partkey % 31 AS STRING) AS ORG_CODE,
               CASE WHEN CAST(floor(p_retailprice) AS BIGINT) % 5 = 0 THEN 'ALL'
                    WHEN CAST(floor(p_retailprice) AS BIGINT) % 5 < 3 THEN 'FEMALE' ELSE 'MALE' END AS SEX,
               CASE WHEN p_partkey % 50 = 0 THEN 'ALL' WHEN p_size >= 45 THEN '95+'
                    ELSE CAST(p_size AS STRING) END AS AGE,
               CAST(floor(p_retailprice) AS BIGINT) AS NUMBER_OF_PATIENTS
        FROM {part}""",
    # D22 active organisations per month.
    "v_active": """
        SELECT o_custkey AS Location, CAST(date_trunc('month', o_orderdate) AS DATE) AS Month,
               CASE o_orderstatus WHEN 'P' THEN 'Y' ELSE 'N' END AS Dormant
        FROM {orders}""",
    # D21-D23 answers per location.
    "v_answers": """
        SELECT o_orderkey, o_custkey AS Location, CAST(o_orderdate AS DATE) AS Date,
               o_orderpriority AS Type,
               CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE NULL END AS Answer,
               CAST(floor(o_totalprice / 10000) AS BIGINT) AS Beds
        FROM {orders}""",
    # Panel: every location that has an order x each month from the first order to the last.
    "v_panel": (
        """
        SELECT Location, explode(sequence(
                 (SELECT trunc(CAST(min(o_orderdate) AS DATE), 'MM') FROM {orders}),
                 (SELECT trunc(CAST(max(o_orderdate) AS DATE), 'MM') FROM {orders}), INTERVAL 1 MONTH)) AS Month
        FROM (SELECT DISTINCT o_custkey AS Location FROM {orders}) l""",
        """
        SELECT l.Location, CAST(m.Month AS DATE) AS Month FROM
          (SELECT DISTINCT o_custkey AS Location FROM {orders}) l
          CROSS JOIN (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM {orders}),
                              (SELECT date_trunc('month', max(o_orderdate)) FROM {orders}), INTERVAL 1 MONTH)) AS Month) m""",
    ),
    # History maintenance: history before the cut, batches from/after it.
    "v_hist": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS Period, o_orderstatus, o_totalprice
        FROM {orders} WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'""",
    "v_batch": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS Period, o_orderstatus, o_totalprice
        FROM {orders} WHERE o_orderdate >= TIMESTAMP '1998-07-01 00:00:00'""",
    "v_batch_new": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS Period, o_orderstatus, o_totalprice
        FROM {orders} WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'""",
    # D19 GP registered population by practice and (top-coded) age.
    "v_gp_pop": """
        SELECT c_custkey % 150 AS GP_Practice_Code,
               CASE WHEN c_nationkey >= 24 THEN '95+' ELSE CAST(c_nationkey * 4 AS STRING) END AS AGE,
               CAST(floor(abs(c_acctbal)) AS BIGINT) AS Size,
               CASE c_custkey % 3 WHEN 0 THEN DATE '2023-10-01' WHEN 1 THEN DATE '2023-11-01'
                    ELSE DATE '2023-12-01' END AS Effective_Snapshot_Date
        FROM {customer}""",
    # D6 messages sent / read by notification type.
    "v_messages": """
        SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS Date,
               'S' || CAST(o_custkey % 4 AS STRING) AS Supplier,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Unknown' WHEN '2-HIGH' THEN 'Appointment'
                    WHEN '3-MEDIUM' THEN 'Prescription' ELSE 'Message' END AS Push_Notification,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS Count,
               CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(floor(o_totalprice / 5000) AS BIGINT) END AS Read_By
        FROM {orders}""",
    # D11 prescription items with text percentages.
    "v_eps": """
        SELECT o_orderkey, o_custkey AS ODS_Code, CAST(date_trunc('month', o_orderdate) AS DATE) AS Date,
               CAST(floor(o_totalprice / 1000) AS BIGINT) AS EPS_Items,
               CAST(floor(o_totalprice / 900) AS BIGINT) + 1 AS All_Items,
               CASE WHEN o_orderkey % 17 = 0 THEN 'n/a%' ELSE CAST(o_orderkey % 101 AS STRING) || '%' END AS EPS_Utilisation
        FROM {orders}""",
    # D12 survey numerators/denominators per practice and year (negative sentinel).
    "v_survey": """
        SELECT o_custkey AS Practice_Code, year(o_orderdate) AS Year,
               CASE WHEN o_custkey % 13 = 0 THEN -1 ELSE CAST(count_if(o_orderstatus = 'F') AS BIGINT) END AS M090_num,
               CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS M091_num,
               CAST(count(*) AS BIGINT) AS M090_den
        FROM {orders} GROUP BY o_custkey, year(o_orderdate)""",
    # D20 virtual wards: organisation x fortnight.
    "v_vw": """
        SELECT o.o_orderkey AS Submission, CAST(o.o_orderdate AS DATE) AS Period_End,
               'R' || CAST(o.o_custkey % 20 AS STRING) AS organisation_code,
               'Brand#' || CAST(o.o_custkey % 30 AS STRING) AS ICB_Code,
               CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE CAST(floor(o.o_totalprice / 10000) AS BIGINT) END AS current_capacity,
               CAST(floor(o.o_totalprice / 20000) AS BIGINT) AS total_number_of_patients_on_ward
        FROM {orders} o""",
    # D27 shared-care-record partners per month.
    "v_partners": """
        SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS For_Month,
               'ICB' || CAST(o_custkey % 7 AS STRING) AS ICB_Code, 'O' || CAST(o_custkey AS STRING) AS ODS_Code,
               CASE WHEN o_orderkey % 31 = 0 THEN 'nan' ELSE 'Org ' || CAST(o_custkey AS STRING) END AS Name,
               CASE o_orderstatus WHEN 'F' THEN 'Connected' WHEN 'O' THEN 'Please select' ELSE 'Not connected' END AS Connected,
               CASE WHEN o_custkey % 2 = 0 THEN 'Acute' ELSE 'Community' END AS Org_Type
        FROM {orders}""",
    # Dates as text in several layouts, some invalid.
    "v_datetext": """
        SELECT o_orderkey AS Id, CAST(o_orderdate AS DATE) AS Date,
               CASE o_orderkey % 4
                    WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                    WHEN 1 THEN lpad(CAST(dayofmonth(o_orderdate) AS STRING), 2, '0') || '/' ||
                                lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' || CAST(year(o_orderdate) AS STRING)
                    WHEN 2 THEN 'not a date'
                    ELSE CAST(year(o_orderdate) AS STRING) || '-13-01' END AS Date_Text,
               'DSPT ' || CAST(year(o_orderdate) AS STRING) || '_' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
                    || ' export ' || o_orderpriority AS File_Name,
               year(o_orderdate) AS Year
        FROM {orders}""",
    # Text columns with the dirt the C-family cleans.
    "v_text": """
        SELECT p_partkey AS Id, p_name AS Name, p_brand AS Brand, p_type AS Type,
               CASE WHEN p_partkey % 97 = 0 THEN 'Grand Total' WHEN p_partkey % 89 = 0 THEN 'nan'
                    WHEN p_partkey % 83 = 0 THEN NULL ELSE p_name END AS Name_Dirty,
               CAST(p_size AS STRING) || '%' AS Pct_Text,
               CASE WHEN p_partkey % 11 = 0 THEN 'bad%' ELSE CAST(p_size * 2 AS STRING) || '.5%' END AS Pct_Dirty,
               chr(160) || p_brand || chr(160) AS Nbsp_Text,
               replace(p_brand, 'Brand#', 'Co') || CASE WHEN p_partkey % 4 = 0 THEN 'Cie' ELSE '' END AS Provider,
               CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS STRING) || p_type ELSE p_type END AS Supplier,
               replace(p_name, ' ', 'Of') AS Camel,
               CASE WHEN p_partkey % 5 = 0 THEN 'YES' WHEN p_partkey % 5 = 1 THEN 'No'
                    WHEN p_partkey % 5 = 2 THEN 'yes' WHEN p_partkey % 5 = 3 THEN NULL ELSE 'NO' END AS YesNo,
               p_size AS Size, p_retailprice AS Price
        FROM {part}""",
}

_REF = re.compile(r"\{(\w+)\}")


def _spark_text(name: str) -> str:
    v = VIEWS[name]
    return v[0] if isinstance(v, tuple) else v


def _duck_text(name: str) -> str:
    v = VIEWS[name]
    return v[1] if isinstance(v, tuple) else v


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stand-in view ``name`` over the tables in ``sf_dir`` (lazy)."""
    text = _spark_text(name)
    subst = {t: f"parquet.`{table_path(sf_dir, t)}`" for t in TABLES}
    return spark.sql(_REF.sub(lambda m: subst[m.group(1)], text))


def with_views(sql: str) -> str:
    """Prefix an oracle query with CTEs for every stand-in view it names."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    ctes = []
    for n in used:
        body = _REF.sub(lambda m: m.group(1), _duck_text(n))
        ctes.append(f"{n} AS ({body})")
    head = "WITH " + ",\n".join(ctes)
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return head + ",\n" + body[4:].lstrip()
    return head + "\n" + sql
