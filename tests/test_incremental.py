"""Incremental = batch: folding the daily / yearly steps
over the driver data equals the one-pass batch operators."""

import datetime as dt

from pyspark.sql import functions as F

from tributary.operators import facts, scd
from tributary.plans import derive as dv
from tributary.plans.queries import actor_classes

SF = "/root/testdata/sf0.001"


def test_scd2_merge_fold_equals_backfill(spark):
    snap = actor_classes(spark, SF).cache()
    attrs = ["quality_class", "is_active"]
    hist = scd.scd2_backfill(snap, "actorid", "current_year", attrs, as_of=1996).checkpoint()
    for y in range(1997, 2002):
        cur = snap.filter(F.col("current_year") == y)
        hist = scd.scd2_merge(hist, cur, "actorid", attrs, prev_as_of=y - 1, new_period=y).checkpoint()
    batch = scd.scd2_backfill(snap, "actorid", "current_year", attrs, as_of=2001)
    cols = ["actorid", "quality_class", "is_active", "start_date", "end_date", "current_year"]
    assert sorted(map(tuple, hist.select(cols).collect())) == sorted(map(tuple, batch.select(cols).collect()))


def test_host_datelist_fold_equals_batch(spark):
    ev = dv.web_events(spark, SF)
    prev = spark.createDataFrame([], "host string, month_start date, host_activity_datelist array<date>")
    for d in range(1, 11):
        step = facts.host_datelist_step(prev, ev, f"2024-01-{d:02d}")
        prev = facts.upsert(prev, step, ["host", "month_start"]).checkpoint()
    again = facts.upsert(prev, facts.host_datelist_step(prev, ev, "2024-01-10"), ["host", "month_start"])
    batch = facts.host_datelist(ev, as_of="2024-01-10")

    def norm(df):
        return sorted((r.host, r.month_start, tuple(r.host_activity_datelist)) for r in df.collect())
    assert norm(prev) == norm(batch) == norm(again)                  # rerun of a day is stable (X8)


def test_monthly_arrays_fold_equals_batch(spark):
    daily = facts.daily_host_metrics(dv.web_events(spark, SF)).cache()
    prev = spark.createDataFrame([], "host string, month_start date, hit_array array<bigint>, "
                                     "unique_visitors_array array<bigint>")
    for d in [1, 2, 3, 5, 6, 7, 8]:                                  # day 4 skipped: zero padded
        step = facts.monthly_arrays_step(prev, daily, f"2024-01-{d:02d}")
        prev = facts.upsert(prev, step, ["host", "month_start"]).checkpoint()
    batch = facts.monthly_arrays(daily, as_of="2024-01-08")

    def norm(df):
        return sorted((r.host, tuple(r.hit_array), tuple(r.unique_visitors_array)) for r in df.collect())
    got, want = norm(prev), norm(batch)
    # the skipped day is 0 in the fold; the batch sees day 4's real counts
    day4 = {r.host: (r.hits, r.unique_visitors) for r in daily.filter(F.col("date") == dt.date(2024, 1, 4)).collect()}
    fixed = [(h, a[:3] + (day4.get(h, (0, 0))[0],) + a[4:], u[:3] + (day4.get(h, (0, 0))[1],) + u[4:])
             for h, a, u in got]
    assert all(a[3] == 0 and u[3] == 0 for _, a, u in got)
    assert sorted(fixed) == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunked_operators_shuffle_rows_once(spark):
    from tributary.plans.queries import QUERIES
    spark.catalog.clearCache()                  # plans must not read cached relations
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # one scan, one range partitioning, one shuffle of the rows by (segment, key)
        for name in ("pattern_best_90_game_stretch", "pattern_longest_streak", "stream_session_hits"):
            plan = _plan(QUERIES[name](spark, SF))
            assert plan.count("FileScan") == 1 and plan.count("Exchange rangepartitioning") == 1, name
        assert "BroadcastNestedLoopJoin" not in _plan(QUERIES["ops_backfill"](spark, SF))
        # segmented history: films by range, then by (segment, entity, year); sums by entity after that
        snap = _plan(QUERIES["dim_cumulative_snapshot"](spark, SF))
        assert snap.count("FileScan") == 1 and snap.count("Exchange rangepartitioning") == 1 and snap.count("Exchange hashpartitioning") == 3
        # array-free form (SCD2 input): partial aggregates, then one row per entity x year by entity
        scd_plan = _plan(QUERIES["dim_scd2_backfill"](spark, SF))
        assert scd_plan.count("Exchange hashpartitioning") == 2 and "collect_list" not in scd_plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_snapshot_shuffles_only_the_new_period(spark, scratch):
    """The growing snapshot is written bucketed by entity; the next period's
    merge shuffles only the new period's rows (cumulate and datelists)."""
    import os
    from tributary.operators import cumulative as cu
    from tributary.sources.layout import write_snapshot_bucketed

    def exchanges(df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        return [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln]

    films = spark.createDataFrame([(str(a), 2000 + y, f"f{a}-{y}", 1, 5.0 + a % 4, f"{a}-{y}")
                                   for a in range(40) for y in range(3) if (a + y) % 3],
                                  "actorid string, year int, film string, votes int, rating double, filmid string")
    roll = cu.period_rollup(films, ["actorid"], "year", ["film", "votes", "rating", "filmid"], avg_col="rating")
    prev = spark.createDataFrame([], "actorid string, current_year int, films array<struct<film:string,votes:int,"
                                     "rating:double,filmid:string>>, quality_class string, is_active boolean")
    for y in range(2000, 2003):
        step = cu.cumulate(prev, roll.filter(F.col("year") == y), ["actorid"], null_safe=False)
        if y == 2002:
            ex = exchanges(step)
            plain = spark.read.parquet(os.path.join(scratch, "actors/y=2001"))
            ex_plain = exchanges(cu.cumulate(plain, roll.filter(F.col("year") == y), ["actorid"], null_safe=False))
        prev = write_snapshot_bucketed(step, f"actors_{y}", os.path.join(scratch, f"actors/y={y}"),
                                       ["actorid"], 8)
    assert len(ex) == len(ex_plain) - 1                         # the snapshot side is not shuffled
    assert all("year" in e or "actorid" in e for e in ex)
    assert prev.count() == 40 and prev.filter("current_year = 2002").count() == 40

    act = spark.createDataFrame([(u, dt.date(2024, 1, d)) for u in range(50) for d in (1, 2, 3) if (u + d) % 3],
                                "u long, date date")
    prev = spark.createDataFrame([], "u long, date date, device_activity_datelist array<date>")
    for d in (1, 2, 3):
        day = dt.date(2024, 1, d)
        step = facts.datelist_cumulate(prev, act, ["u"], str(day), null_safe=False)
        if d == 3:
            ex = exchanges(step)
        prev = write_snapshot_bucketed(step, f"snap_d{d}", os.path.join(scratch, f"snap/date={day}"), ["u"], 8)
    assert len(ex) == 1                                         # only today's rows move
    want = {u: [dt.date(2024, 1, d) for d in (1, 2, 3) if (u + d) % 3] for u in range(50)}
    assert {r.u: r.device_activity_datelist for r in prev.collect()} == {u: v for u, v in want.items() if v}
