"""Hand-made rows for the rules that the notebooks state."""
import datetime as dt

from pyspark.sql import functions as F

from strata.operators import joins as J
from strata.operators import timeseries as W
from strata.plans import families as fam

D = dt.date


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_every_response_counts(spark):
    """Two answers of one location in one month, a null answer, a response without a place."""
    a = spark.createDataFrame([(1, D(2023, 5, 1), "R", "Yes"), (1, D(2023, 5, 20), "R", "No"), (1, D(2023, 5, 21), "R", "Yes"), (2, D(2023, 5, 2), "R", None),
                               (2, D(2023, 6, 2), "C", None), (9, D(2023, 5, 2), "R", "Yes")], "Location int, Date date, Type string, Answer string")
    p = spark.createDataFrame([(1, "A", "North"), (2, "A", "North")], "Code int, ICB_Name string, Region_Name string")
    out = fam.responses_by_month(a, p, "Location", "Code", "Date", ["Type"], ["ICB_Name", "Region_Name"], "Answer")
    assert rows(out) == [("05-2023", "R", "A", "North", 2, 1, 3, 2 / 3), ("06-2023", "C", "A", "North", 0, 0, 0, None)]


def test_null_answers_are_no_state(spark):
    a = spark.createDataFrame([(1, D(2023, 1, 31), None), (2, D(2023, 1, 5), "No"), (2, D(2023, 3, 1), "Yes"), (2, D(2023, 4, 1), "No"), (3, D(2023, 2, 1), "Yes"),
                               (3, D(2023, 1, 1), "Maybe")], "Location int, Date date, Answer string")
    panel = a.select("Location").distinct().withColumn("Month", F.explode(F.sequence(F.lit(D(2023, 1, 1)), F.lit(D(2023, 4, 1)), F.expr("INTERVAL 1 MONTH"))))
    one = lambda v: F.when(F.col("Answer") == v, 1).otherwise(0).cast("long")
    s = J.state_as_of(panel, a, "Location", "Month", "Date", {"y": (one("Yes"), "sum"), "n": (one("No"), "sum")})
    state = F.when(F.col("y") >= 1, "Yes").when(F.col("n") >= 1, "No").otherwise("None")
    by_panel = s.groupBy("Month").agg(*(F.count_if(state == v).alias(v) for v in ("Yes", "No", "None")))
    swept = J.state_sweep(a, "Location", "Date", "Answer", ["Yes", "No"], "None", "Month")
    want = [(D(2023, 1, 1), 0, 1, 2), (D(2023, 2, 1), 1, 1, 1), (D(2023, 3, 1), 2, 0, 1), (D(2023, 4, 1), 2, 0, 1)]
    assert rows(swept) == rows(by_panel) == want
    assert J.state_sweep(a.limit(0), "Location", "Date", "Answer", ["Yes", "No"], "None", "Month").count() == 0


def test_one_response_of_a_location(spark):
    """Of the last responses of both types the one with an answer that sorts last; a missing answer sorts behind "Yes"."""
    a = spark.createDataFrame([(1, "R", D(2023, 1, 1), "Yes", 1), (1, "R", D(2023, 2, 1), "No", 2), (1, "C", D(2023, 1, 5), "Yes", 3), (2, "R", D(2023, 1, 1), "Yes", 4),
                               (2, "C", D(2023, 1, 1), None, 5)], "Location int, Type string, Date date, Answer string, k int")
    out = W.reduce_answers(a, "Location", "Type", "Date", "Answer", tiebreak=["k"]).select("Location", "Type", "Answer")
    assert rows(out) == [(1, "C", "Yes"), (2, "C", None)]
    spine = spark.createDataFrame([(1,), (7,)], "Location int")
    assert rows(spine.join(out, "Location", "left")) == [(1, "C", "Yes"), (7, None, None)]  # a location without answers stays


def test_two_sites_of_a_trust_and_suppressed_cells(spark):
    t = dt.datetime(2024, 1, 3)
    acks = spark.createDataFrame([(t, "MH_ACK", "RAB01")] * 4 + [(t, "MH_ACK", "RAB02")] * 3 + [(t, "OTHER_ACK", "RAB02")], "_time timestamp, workflow string, recipientOdsCode string")
    mh = spark.createDataFrame([(D(2024, 1, 1), "ENG", "England", 100, "100"), (D(2024, 1, 1), "RAB", "Provider", 60, "60"), (D(2024, 1, 1), "RCD", "Provider", 10, "*"),
                                (D(2024, 1, 1), "REF", "Provider", None, "*")], "Reporting_Period_Start date, Primary_Level string, Breakdown string, Measure_Value long, Measure_Value_Str string")
    out = fam.trust_suppressed(acks, mh, "MH_ACK").select("Trust", "Discharges", "Pairs", "Per_1000")
    # (100 - 60 - 10) / 2 suppressed cells
    assert rows(out) == [("RAB", 60.0, 1, 16.67), ("RAB", 60.0, 2, 33.33), ("RCD", 15.0, 0, 0.0), ("REF", 15.0, 0, 0.0)]


def test_status_mix_drops_the_old_edition_after_the_switch(spark):
    early, late = D(2021, 6, 1), D(2021, 8, 1)
    s = spark.createDataFrame([(early, "A", "19/20 Met", early), (early, "A", "20/21 Met", None), (late, "A", "19/20 Met", early), (late, "A", "20/21 Met", late), (late, "A", "20/21 Met", None),
                               (late, None, "20/21 Met", late), (late, "B", "Other", late), (late, "B", "19/20 Met", early)], "d date, icb string, status string, pub date")
    out = fam.status_mix(s, "d", "icb", "status", "pub", ["19/20 Met", "20/21 Met"], outdated=1, switch="2021-07-01").select("d", "icb", "status", "n", "total")
    assert rows(out) == [(early, "A", "19/20 Met", 1, 2), (early, "A", "20/21 Met", 1, 2), (late, "A", "20/21 Met", 2, 2)]
    out = fam.status_mix(s, "d", "icb", "status", None, ["20/21 Met"]).select("d", "icb", "status", "n", "total")
    assert rows(out) == [(early, "A", "20/21 Met", 1, 1), (late, "A", "20/21 Met", 2, 2)]


def test_one_row_of_met_per_date(spark):
    s = spark.createDataFrame([("2021-09", "old met"), ("2021-09", "old exceeded"), ("2021-09", "new met"), ("2021-10", "old met"), ("2021-10", "new met"), ("2021-10", None), ("2021-11", "none")],
                              "d string, status string")
    out = fam.met_by_date(s, "d", "status", [(None, "2021-09", ["old met", "old exceeded"]), ("2021-10", None, ["new met"])])
    assert rows(out.select("d", "Met_Or_Exceeded", "Total", "Pct")) == [("2021-09", 2, 3, 0.6667), ("2021-10", 1, 2, 0.5)]
