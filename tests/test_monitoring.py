"""Pipeline checks."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tributary.operators import monitoring as mo

T = dt.datetime


def test_gap_fixture(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, h),) for h in (0, 1, 14)], "ts timestamp_ntz")
    got = [(r.gap_start, r.gap_end) for r in mo.find_gaps(df, "ts", "12 hours").collect()]
    assert got == [(T(2024, 1, 1, 1), T(2024, 1, 1, 14))]


def test_find_gaps_matches_brute_force(spark):
    rnd = random.Random(5)
    ts = sorted(T(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 5000)) for _ in range(120))
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    want = [(a, b) for a, b in zip(ts, ts[1:]) if (b - a) > dt.timedelta(hours=1)]
    got = sorted((r.gap_start, r.gap_end) for r in mo.find_gaps(df, "ts", "1 hour").collect())
    assert got == want and want


def test_backfill_restores_hole(spark):
    src = spark.createDataFrame([(i, T(2024, 1, 1) + dt.timedelta(minutes=10 * i)) for i in range(200)],
                                "id long, ts timestamp_ntz")
    tgt = src.filter(~F.col("id").between(50, 120))
    gaps = mo.find_gaps(tgt, "ts", "30 minutes")
    out = mo.backfill(tgt, src, gaps, ts="ts", key=["id"])
    assert sorted(r.id for r in out.collect()) == list(range(200))


def test_account_changes_and_churn(spark):
    rows = [("a", 1, 2, True), ("a", 2, 1, True), ("a", 3, 1, False), ("a", 4, 3, True),
            ("b", 1, 2, True), ("b", 2, 3, True), ("b", 3, 3, True)]
    df = spark.createDataFrame(rows, "k string, p int, plan_rank int, is_active boolean")
    ch = mo.account_changes(df, "k", "p")
    got = {(r.k, r.p): r.change for r in ch.collect()}
    assert got == {("a", 1): "new", ("a", 2): "upgrade", ("a", 3): "cancel", ("a", 4): "reactivate",
                   ("b", 1): "new", ("b", 2): "downgrade", ("b", 3): "renew"}
    c = {r.p: (r.n_cancel, r.n_active_prev, r.churn_rate) for r in mo.churn(ch, "p").collect()}
    assert c[3] == (1, 2, 0.5)


def test_missing_periods(spark):
    df = spark.createDataFrame([("a", y) for y in (1995, 1996, 1999, 2001)], "k string, y int")
    got = sorted(tuple(r) for r in mo.missing_periods(df, "k", "y").collect())
    assert got == [("a", 1997, 1998, 2), ("a", 2000, 2000, 1)]


def test_report_gate_and_freshness(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0)], "rev double, den double")
    gate = {r.rule: (r.n_bad, r.passed) for r in mo.validate_report([
        ("missing", df, F.col("rev").isNull()), ("zero_den", df, F.col("den") == 0)]).collect()}
    assert gate == {"missing": (1, False), "zero_den": (1, False)}
    ev = spark.createDataFrame([(T(2024, 1, 30),)], "ts timestamp_ntz")
    fr = mo.freshness([("events", ev, "ts", 48)], as_of="2024-02-01 00:00:00").first()
    assert fr.age_s == 48 * 3600 and fr.fresh


def test_profit_missing_side_counts_zero(spark):
    income = spark.createDataFrame([("u", 10.0, 3.0), ("v", None, 1.0)], "unit string, revenue double, expenses double")
    sal = spark.createDataFrame([("v", 2.0), ("w", 5.0)], "unit string, amount double")
    got = {r.unit: (r.profit, r.missing_revenue) for r in mo.profit(income, sal, ["unit"]).collect()}
    assert got == {"u": (7.0, False), "v": (-3.0, True), "w": (-5.0, True)}


def test_publish_counts_what_it_wrote(spark, scratch):
    """The same numbers as a gate over the report, counted on the written rows."""
    import os
    path = os.path.join(scratch, "report")
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, id % 5) as v")
    rules = {"missing": F.col("v").isNull(), "zero": F.col("v") == 0}
    counts = mo.publish(df, path, rules)
    written = spark.read.parquet(path)
    again = {r.rule: r.n_bad for r in mo.validate_report([(n, written, c) for n, c in rules.items()]).collect()}
    assert counts == again == {"missing": 143, "zero": 171} and written.count() == 1000
    assert {tuple(r) for r in mo.gate(spark, counts).collect()} == {("missing", 143, False), ("zero", 171, False)}
    assert mo.publish(df.limit(0), path, rules) == {"missing": 0, "zero": 0}


def test_rules_on_one_frame_are_one_pass(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = mo.validate_report([("a", df, F.col("o_totalprice") > 5), ("b", df, F.col("o_custkey") < 9)])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Scan parquet") == 1


def test_backfill_at_any_bucket_width(spark):
    src = spark.createDataFrame([(i, T(2024, 1, 1) + dt.timedelta(minutes=37 * i)) for i in range(400)],
                                "id long, ts timestamp_ntz")
    tgt = src.filter(~(F.col("id").between(40, 90) | F.col("id").between(200, 260)))
    gaps = mo.find_gaps(tgt, "ts", "2 hours")
    a = mo.backfill(tgt, src, gaps, ts="ts", key=["id"])
    b = mo.backfill(tgt, src, gaps, ts="ts", key=["id"], bucket="3 hours")
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect()) == list(range(400))


def test_arrivals_before_their_event_have_a_band(spark):
    import datetime as dt

    from tributary.operators import monitoring as mo
    t = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(t, t - dt.timedelta(seconds=300)), (t, t + dt.timedelta(seconds=5))], "e timestamp_ntz, a timestamp_ntz")
    got = {r.band: (r.n_events, r.avg_lateness_s) for r in mo.lateness(df, event_ts="e", arrival_ts="a").collect()}
    assert got == {"early": (1, -300.0), "0-60s": (1, 5.0)}


def test_no_job_runs_while_a_frame_is_built(spark):
    from tributary.operators import joins, monitoring as mo, patterns as pt, sessions as ss
    from tributary.plans import derive as dv
    from pyspark.sql import functions as F
    ev, sc = dv.table(spark, "/root/testdata/sf0.001", "events"), spark.sparkContext
    sc.setJobGroup("lazy-frames", "none")
    gaps = mo.find_gaps(ev, "ts", "10 minutes")
    mo.backfill(ev, ev, gaps, ts="ts", key=["event_id"])
    ss.sessionize(ev, "ts", ["user_id"])
    pt.longest_streak(ev, "user_id", ["ts", "event_id"], F.col("value") > 10, bucket=F.to_date("ts"))
    joins.salted_join(ev, ev.select("user_id").distinct(), ["user_id"])
    joins.lookup_join(ev, ev.select("user_id").distinct(), "user_id")
    jobs = sc.statusTracker().getJobIdsForGroup("lazy-frames")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []
