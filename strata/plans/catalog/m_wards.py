"""Virtual-ward families.

Rules: the delivered date stays as it is; population of STP rows of both sexes aged 16
and over, per extract; full outer join on the organisation.
"""
from strata.plans import families as fam
from strata.plans.registry import query
from strata.plans.standins import view

_POP = """(SELECT EXTRACT_DATE, ORG_CODE, CAST(sum(NUMBER_OF_PATIENTS) AS BIGINT) AS Size FROM v_stp_pop
           WHERE ORG_TYPE = 'STP' AND SEX IN ('FEMALE', 'MALE') AND AGE <> 'ALL'
             AND CAST(CASE AGE WHEN '95+' THEN '95' ELSE AGE END AS INTEGER) >= 16 GROUP BY ALL)"""


def _pop(spark, sf):
    return fam.stp_population(view(spark, sf, "v_stp_pop"), "EXTRACT_DATE", "ORG_TYPE", "ORG_CODE", "SEX", "AGE", "NUMBER_OF_PATIENTS") \
        .withColumnsRenamed({"ORG_CODE": "ICB_Code", "NUMBER_OF_PATIENTS": "Size"})


def _per100k_sql(measure, extra=""):
    return f"""
WITH m AS (SELECT Period_End, ICB_Code, CAST(coalesce(sum({measure}), 0) AS BIGINT) AS {measure}
           FROM v_vw WHERE Period_End >= DATE '1996-01-01' {extra} GROUP BY ALL),
     p AS {_POP}
SELECT m.Period_End, coalesce(m.ICB_Code, p.ORG_CODE) AS ICB_Code, m.{measure}, p.Size,
       CAST(round_even(m.{measure} / (p.Size / 100000.0), 2) AS DOUBLE) AS Per_100k
FROM p FULL OUTER JOIN m ON m.ICB_Code = p.ORG_CODE"""


@query("m38_per_100k", oracle=_per100k_sql("total_number_of_patients_on_ward"), dates=["Period_End"])
def m38(spark, sf):
    return fam.per_100k(view(spark, sf, "v_vw"), _pop(spark, sf), "Period_End", "ICB_Code",
                        "total_number_of_patients_on_ward", "1996-01-01", "EXTRACT_DATE", "Size")


@query("m40_capacity", oracle=_per100k_sql("current_capacity", "AND current_capacity IS NOT NULL"), dates=["Period_End"])
def m40(spark, sf):
    return fam.per_100k(view(spark, sf, "v_vw"), _pop(spark, sf), "Period_End", "ICB_Code",
                        "current_capacity", "1996-01-01", "EXTRACT_DATE", "Size", require=True)


@query("m39_fiscal_per_100k", oracle=f"""
WITH pop AS {_POP},
     m AS (SELECT Period_End, ICB_Code, CAST(sum(current_capacity) AS BIGINT) AS current_capacity FROM v_vw
           WHERE current_capacity IS NOT NULL AND Period_End >= DATE '1996-05-20' GROUP BY ALL),
     e AS (SELECT DISTINCT EXTRACT_DATE FROM pop),
     n AS (SELECT e.EXTRACT_DATE, m.* FROM e JOIN m ON m.Period_End >= make_date(year(e.EXTRACT_DATE), 4, 1)
             AND m.Period_End < make_date(year(e.EXTRACT_DATE) + 1, 4, 1))
SELECT year(coalesce(n.EXTRACT_DATE, pop.EXTRACT_DATE)) AS FY, coalesce(n.ICB_Code, pop.ORG_CODE) AS ICB_Code, n.Period_End,
       n.current_capacity, pop.Size, CAST(round_even(n.current_capacity / (pop.Size / 100000.0), 2) AS DOUBLE) AS Per_100k
FROM pop FULL OUTER JOIN n ON n.ICB_Code = pop.ORG_CODE AND n.EXTRACT_DATE = pop.EXTRACT_DATE""", dates=["Period_End"])
def m39(spark, sf):
    return fam.fiscal_per_100k(view(spark, sf, "v_vw"), _pop(spark, sf), "Period_End", "ICB_Code",
                               "current_capacity", "1996-05-20", "EXTRACT_DATE", "Size")
