"""Ingest, snapshots, history writes, merges and hot keys: the cases that were wrong or untested."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import history as H
from strata.operators import joins as J
from strata.operators import timeseries as W
from strata.plans import families as fam
from strata.session import scratch_path
from strata.sources import files as S
from strata.streaming import ingest

SCHEMA = "k int, Period string"


def landing(spark, files):
    base = scratch_path(spark, "landing")
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{base}/in/f{i}")
    return base


def drain(spark, base, n):
    ingest.incremental_ingest(spark, f"{base}/in/*", SCHEMA, f"{base}/history", f"{base}/checkpoint", "Period", max_files_per_trigger=n)
    return sorted(tuple(r) for r in ingest.read_history(spark, f"{base}/history").collect())


@pytest.mark.parametrize("n", [1, 2, 100])
def test_ingest_does_not_depend_on_the_batch_size(spark, n):
    period = [[(i * 10 + j, "2024-01") for j in range(10)] for i in range(4)]  # one period over four files
    base = landing(spark, [*period, period[1], [(99, "2024-02")]])  # one file sent twice
    want = sorted([r for f in period for r in f] + [(99, "2024-02")])
    assert drain(spark, base, n) == want
    spark.createDataFrame(period[2] + [(500, "2024-01"), (7, "2024-03")], SCHEMA).write.parquet(f"{base}/in/later")
    assert drain(spark, base, n) == sorted([*want, (7, "2024-03")])  # a period that the history has is closed


@pytest.mark.parametrize("n", [1, 100])
def test_ingest_keeps_equal_rows_of_one_file(spark, n):
    rows = [(1, "2024-01"), (1, "2024-01"), (2, "2024-01"), (None, "2024-01"), (None, "2024-01")]
    base = landing(spark, [rows, [(3, "2024-01")], rows])  # the first file is sent again
    ingest.incremental_ingest(spark, f"{base}/in/*", SCHEMA, f"{base}/history", f"{base}/checkpoint", "Period", max_files_per_trigger=n)
    assert sorted(map(tuple, ingest.read_history(spark, f"{base}/history").collect()), key=repr) == sorted([*rows, (3, "2024-01")], key=repr)


def test_ingest_retried_batch_replaces_itself(spark):
    base = scratch_path(spark, "retry")
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (None, None)], SCHEMA)
    write = ingest.append_new(f"{base}/h", "Period", 0)
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)  # sent again in the same run
    assert sorted(map(tuple, ingest.read_history(spark, f"{base}/h").collect()), key=repr) == [(1, "a"), (2, "a"), (None, None)]


def test_ingest_broken_run_goes_on(spark):
    base = landing(spark, [[(1, "a")], [(2, "a")]])
    ingest._mark(spark, f"{base}/checkpoint", 0, done=False)
    ingest.append_new(f"{base}/history", "Period", 0)(spark.createDataFrame([(0, "a")], SCHEMA), 0)
    assert ingest._first_epoch(spark, f"{base}/history", f"{base}/checkpoint") == 0


@pytest.mark.parametrize("n", [1, 100])
def test_ingest_keeps_equal_rows_of_different_files(spark, n):
    base = landing(spark, [[(1, "a")], [(1, "a"), (2, "b")], [(2, "b"), (1, "a")]])  # the third is the second, sent again
    assert drain(spark, base, n) == [(1, "a"), (1, "a"), (2, "b")]
    spark.createDataFrame([(1, "a")], SCHEMA).coalesce(1).write.parquet(f"{base}/in/again")
    spark.createDataFrame([(None, "c"), (5, None)], SCHEMA).coalesce(1).write.parquet(f"{base}/in/odd")
    want = [(1, "a"), (1, "a"), (2, "b"), (5, None), (None, "c")]
    drain_rows = lambda: sorted(map(tuple, ingest.read_history(spark, f"{base}/history").collect()), key=repr)
    ingest.incremental_ingest(spark, f"{base}/in/*", SCHEMA, f"{base}/history", f"{base}/checkpoint", "Period", max_files_per_trigger=n)
    assert drain_rows() == sorted(want, key=repr)


def test_ingest_broken_between_data_and_ledger(spark):
    """The data of an epoch without its ledger entry is not seen; the batch run again gives the same rows once."""
    base = scratch_path(spark, "broken")
    one = spark.createDataFrame([(1, "a", "f1"), (1, "a", "f2"), (2, "a", "f2")], f"{SCHEMA}, {ingest.FILE} string")
    two = spark.createDataFrame([(1, "a", "f3"), (9, "a", "f4")], f"{SCHEMA}, {ingest.FILE} string")  # f3 is f1 again
    write = ingest.append_new(f"{base}/h", "Period", 0)
    write(one, 0)
    spark.createDataFrame([(77, "a")], SCHEMA).write.parquet(f"{base}/h/{ingest.EPOCH}=1")  # all that the broken batch has left
    assert sorted(map(tuple, ingest.read_history(spark, f"{base}/h").collect())) == [(1, "a"), (1, "a"), (2, "a")]
    write(two, 1)
    write(two, 1)
    assert sorted(map(tuple, ingest.read_history(spark, f"{base}/h").collect())) == [(1, "a"), (1, "a"), (2, "a"), (9, "a")]


def test_ingest_reads_the_ledger_not_the_history(spark):
    base = scratch_path(spark, "ledger-only")
    ingest.append_new(f"{base}/h", "Period", 0)(spark.createDataFrame([(1, "a")], SCHEMA), 0)
    seen = ingest.seen_periods(spark, f"{base}/h", "Period", 1)
    assert [r[0] for r in seen.collect()] == ["a"] and all("-ledger/periods" in f for f in seen.inputFiles())


def test_fingerprints_tell_files_apart(spark):
    rows = [("f1", 1, None, {"k": 1}), ("f1", 2, "x", None), ("f2", 2, "x", None), ("f2", 1, None, {"k": 1}), ("f3", 1, "x", None), ("f3", 2, None, {"k": 1}),
            ("f4", 1, None, {"k": 1}), ("f4", 2, "x", None), ("f4", 2, "x", None)]
    out = ingest.fingerprints(spark.createDataFrame(rows, f"{ingest.FILE} string, v int, w string, m map<string,int>")).collect()
    found = {r[ingest.FILE]: tuple(r[c] for c in ingest.PRINT) for r in out}
    assert found["f1"] == found["f2"] and len(set(found.values())) == 3


def test_ingest_surfaces_read_failures(spark, tmp_path):
    (tmp_path / "h").mkdir()
    (tmp_path / "h" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        ingest.append_new(str(tmp_path / "h"), "Period", 0)(spark.createDataFrame([(1, "a")], SCHEMA), 1)


def test_snapshot_scans_read_only_the_drops_they_need(spark):
    root = scratch_path(spark, "drops")
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 28), dt.date(2024, 2, 4)]
    S.write_snapshot(spark.createDataFrame([(i, d) for i, d in enumerate(days)], "v int, snapshot_date date"), root)
    assert S.snapshot_dates(spark, root) == days
    last = S.read_month_end_snapshots(spark, root)
    assert sorted(r.v for r in last.collect()) == [1, 2] and [r.v for r in S.read_latest(spark, root).collect()] == [2]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" not in plan and not any("2024-01-07" in f for f in last.inputFiles())


def test_replaced_history_leaves_no_stale_partition(spark):
    path = scratch_path(spark, "history")
    frame = lambda p: spark.createDataFrame([(1, p)], "v int, p string")
    H.write_history(frame("old"), path, ["p"])
    H.write_history(H.merge_history(spark.read.parquet(path), frame("new"), "p", "replace_if_new"), path + "-2", ["p"])
    H.write_history(frame("old"), path + "-3", ["p"])
    H.write_history(frame("new"), path + "-3", ["p"])
    assert [r.p for r in spark.read.parquet(path + "-2").collect()] == ["new"]
    assert [r.p for r in spark.read.parquet(path + "-3").collect()] == ["new"]


@pytest.mark.parametrize("rule", H.RULES)
def test_newest_batch_twice_is_a_no_op(spark, rule):
    hist = spark.createDataFrame([(1, "2024-01", "x"), (2, "2024-02", "y")], "v long, p string, kind string")
    batch = spark.createDataFrame([(3, "2024-03", "x"), (4, "2024-03", "y")], "v long, p string, kind string")
    extra = {"fingerprint": {"columns": ["v", "p"], "order": ["v"]}, "preagg_append": {"measures": ["v"]}, "fanout": {"partition_by": ["kind"]}}.get(rule, {})
    path = scratch_path(spark, "twice")
    H.write_history(H.merge_history(hist, batch, "p", rule, **extra), path)
    once = spark.read.parquet(path)
    again = H.merge_history(once, batch, "p", rule, **extra)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))


def test_merges_keep_exact_values_and_refuse_double_keys(spark):
    big = 2**53 + 1
    spine = spark.createDataFrame([("a",), ("b",)], "k string")
    feed = spark.createDataFrame([("a", big), ("c", 1)], "k string, v long")
    assert sorted(tuple(r) for r in J.widen(spine, {"v": (feed, "v")}, "k").collect()) == [("a", big), ("b", None)]
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, w long")
    with pytest.raises(Exception, match="twice"):
        J.outer_merge_all([feed, twice], "k").collect()


def test_positional_join(spark):
    a, b = spark.range(5).withColumnRenamed("id", "x"), spark.range(10, 13).withColumnRenamed("id", "y")
    assert sorted(map(tuple, J.zip_join(a, b, ["x"], ["y"]).collect()), key=repr) == [(0, 10), (1, 11), (2, 12), (3, None), (4, None)]


def test_hot_key_is_spread_by_a_salt(spark):
    df = spark.range(2000).select(F.when(F.col("id") < 1800, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        out = W.n_in_group(df, ["k"])
        assert "_salt" in out._jdf.queryExecution().executedPlan().toString()
        assert out.where("k = 0 and n_in_group = 1800").count() == 1800 and out.count() == 2000
        groups = df.groupBy("k").agg(F.count(F.lit(1)).alias("_rows"))
        cold, hot = W.attach(df, groups, ["k"]), W.attach(df, groups, ["k"], hot_rows=1000)
        assert sorted(cold.collect()) == sorted(hot.collect()) and hot.where("k = 0 and _rows = 1800").count() == 1800
        tasks = lambda x: x.where("k = 0").select(F.spark_partition_id()).distinct().count()
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert tasks(cold) == 1 and tasks(hot) > 1  # only a hot key is spread
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 << 20))


def test_pairs_ignore_the_sender(spark):
    """Two senders of one message each to one site make a pair."""
    t = dt.datetime(2024, 1, 3)
    acks = spark.createDataFrame([(t, "W_ACK", "s1", "RAB01"), (t, "W_ACK", "s2", "RAB01"), (t, "W_ACK", "s1", "RAB02")],
                                 "_time timestamp, workflow string, senderOdsCode string, recipientOdsCode string")
    den = spark.createDataFrame([(dt.date(2024, 1, 3), "RABXX", 500), (dt.date(2024, 1, 9), "RABXX", 500)], "d date, org string, n long")
    rows = fam.trust_rate(acks, den, "W_ACK", "d", "org", "n").collect()
    assert sorted((r.Trust, r.n, r.Pairs, r.Per_1000) for r in rows) == [("RAB", 1000, 0, 0.0), ("RAB", 1000, 1, 1.0)]
    den = den.withColumn("org", F.lit("RAB"))
    rows = fam.trust_rate(acks, den, "W_ACK", "d", "org", "n", grain="day", run_date="2024-01-09").collect()
    assert [(r.n, r.Pairs) for r in rows] == [(1000, 1)]  # both sites' rows carry the trust's day; the later day is fictitious


def test_every_acknowledgement_workflow_has_a_column(spark):
    t = dt.datetime(2024, 1, 3)
    acks = spark.createDataFrame([(t, w, "s1", "RAB01") for w in ("A_ACK", "A_ACK", "NEW_ACK", "NEW_ACK", "NEW_ACK", "other", None)],
                                 "_time timestamp, workflow string, senderOdsCode string, recipientOdsCode string")
    assert fam.ack_pivot(acks, ["B_ACK", "A_ACK"], "2024-02-03").first().asDict() == {"Month": "2024-01", "B_ACK": 0, "A_ACK": 1, "NEW_ACK": 1}
    assert fam.ack_trust(acks, ["A_ACK"], "2024-02-03").first().asDict() == {"Month": "2024-01", "Trust": "RAB", "A_ACK": 1, "NEW_ACK": 1}
    many = spark.range(12).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 10"):
        A.categories_of(many, "c", most=10)


def test_ward_population_is_of_both_sexes_aged_16_and_over(spark):
    pop = spark.createDataFrame([("2024-04-01", "STP", "A", "FEMALE", "16", 1), ("2024-04-01", "STP", "A", "MALE", "95+", 2), ("2024-04-01", "STP", "A", "ALL", "40", 100),
                                 ("2024-04-01", "STP", "A", "MALE", "ALL", 100), ("2024-04-01", "CCG", "A", "MALE", "40", 100), ("2024-04-01", "STP", "A", "MALE", "15", 100)],
                                "e string, t string, o string, s string, a string, n long")
    assert [tuple(r) for r in fam.stp_population(pop, "e", "t", "o", "s", "a", "n").collect()] == [("2024-04-01", "A", 3)]
