"""Weekly practice feeds (online consultations): M22-M24."""
from strata.plans import families as fam
from strata.plans.registry import query
from strata.plans.standins import view


@query("m22_rolling_total", oracle="""
SELECT Week_Commencing, Submissions,
       CAST(CASE WHEN count(Submissions) OVER w = 12 THEN round_even(avg(Submissions) OVER w, 0) END AS DOUBLE) AS rolling_avg,
       CAST(row_number() OVER (ORDER BY Week_Commencing) - 1 AS BIGINT) AS Unique_ID
FROM (SELECT Week_Commencing, CAST(sum(Submissions) AS BIGINT) AS Submissions
      FROM v_weekly WHERE Week_Commencing IS NOT NULL GROUP BY Week_Commencing) t
WINDOW w AS (ORDER BY Week_Commencing ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
""", dates=["Week_Commencing"])
def m22_rolling_total(spark, sf):
    return fam.rolling_total(view(spark, sf, "v_weekly"), "Week_Commencing", "Submissions", window=12, dp=0)
