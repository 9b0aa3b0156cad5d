"""Distinct counts and sketches in the run log."""
from pyspark.sql import functions as F

from strata.operators import sketches as SK


def log(spark, values, day, lg_k=SK.LG_K):
    return SK.distinct_log(spark.createDataFrame([(v,) for v in values], "v string"), "f", ["v"], day, lg_k=lg_k)


def change(spark, now, *before, lg_k=SK.LG_K):
    runs = [log(spark, v, f"2024-01-0{i}", lg_k) for i, v in enumerate(before, 1)]
    earlier = log(spark, [], "2025-01-01").where(F.lit(False))
    for r in runs:
        earlier = earlier.unionByName(r)
    return SK.distinct_change(log(spark, now, "2024-02-01", lg_k), earlier, lg_k).first().asDict()


def test_equal_counts_of_other_values_are_a_change(spark):
    got = change(spark, ["a", "b", "d", None], ["x"], ["a", "b", "c"])
    assert (got["now"], got["previous"], got["added"], got["removed"], got["over_runs"]) == (3, 3, 1, 1, 5)
    assert got["certain"] and got["unchanged"] is False
    assert change(spark, ["b", "a", "a"], ["a", "b", None])["unchanged"] is True


def test_first_run_and_empty_drops(spark):
    first = change(spark, ["a", "b"])
    assert first["now"] == first["over_runs"] == 2 and first["previous"] is None and first["unchanged"] is None
    empty = change(spark, [], ["a"])
    assert (empty["now"], empty["previous"], empty["added"], empty["removed"], empty["unchanged"]) == (0, 1, 0, 1, False)
    assert change(spark, [], [])["unchanged"] is True


def test_error_bound_beyond_the_sketch(spark):
    """100,000 and 100,000 values, half of them shared, in sketches of 4,096: within four standard errors of the union."""
    a = SK.distinct_log(spark.range(100_000).withColumnRenamed("id", "v"), "f", ["v"], "2024-01-01", lg_k=12)
    b = SK.distinct_log(spark.range(50_000, 150_000).withColumnRenamed("id", "v"), "f", ["v"], "2024-01-02", lg_k=12)
    got = SK.distinct_change(b, a, 12).first()
    bound = 4 * 150_000 / 4096**0.5
    assert got.now == got.previous == 100_000 and not got.certain and got.unchanged is None
    assert abs(got.added - 50_000) < bound and abs(got.removed - 50_000) < bound and abs(got.over_runs - 150_000) < bound


def test_log_of_all_drops_reads_the_table_once(spark):
    df = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "b")], "d string, v string").withColumn("d", F.to_date("d"))
    whole = SK.distinct_log(df, "f", ["v", "d"], drop="d")
    assert sorted((str(r.load_date)[:10], r.column, r.distinct_count) for r in whole.collect()) == [
        ("2024-01-01", "d", 1), ("2024-01-01", "v", 2), ("2024-01-02", "d", 1), ("2024-01-02", "v", 1)]
