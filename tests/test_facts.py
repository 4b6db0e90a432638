"""Fact operators (F1-F13) on hand-made rows (FIXTURES §4) and fold checks."""

import datetime as dt

from pyspark.sql import functions as F

from tributary import functions as fx
from tributary.operators import facts

D = dt.date


def test_dedup_takes_first_in_total_order(spark):
    df = spark.createDataFrame([(1, 1, "2020-01-02", "late"), (1, 1, "2020-01-01", "early"), (2, 1, None, "only")],
                               "g long, p long, d string, payload string")
    got = {(r.g, r.payload) for r in facts.dedup(df, ["g", "p"], ["d", "payload"]).collect()}
    assert got == {(1, "early"), (2, "only")}


def test_flags_and_clock(spark):
    df = spark.createDataFrame([("34:30",), ("34",), (None,), ("",), ("DNP - coach",)], "m string")
    got = [tuple(r) for r in df.select(fx.clock_to_minutes("m"), fx.flag_contains("m", "DNP")).collect()]
    assert got == [(34.5, False), (34.0, False), (None, False), (None, False), (None, True)]


def test_datelist_null_browser_matches(spark):
    prev = spark.createDataFrame([(1, 2, None, D(2023, 1, 30), [D(2023, 1, 30)])],
                                 "user_id long, device_id long, browser_type string, date date, "
                                 "device_activity_datelist array<date>")
    today = spark.createDataFrame([(1, 2, None, D(2023, 1, 31))],
                                  "user_id long, device_id long, browser_type string, date date")
    out = facts.datelist_cumulate(prev, today, ["user_id", "device_id", "browser_type"], "2023-01-31").collect()
    assert len(out) == 1 and out[0].device_activity_datelist == [D(2023, 1, 30), D(2023, 1, 31)]


def test_datelist_mask_fixture(spark):
    df = spark.createDataFrame([([D(2023, 1, 31), D(2023, 1, 30), D(2023, 1, 1), D(2023, 1, 30)],)],
                               "l array<date>")
    r = facts.datelist_int(df, "l", "2023-01-31").first()
    assert r.datelist_int == 2**31 + 2**30 + 2**1 == 3221225474
    assert r.datelist_bits == "11000000000000000000000000000010"


def test_datelist_range_equals_fold(spark):
    act = spark.createDataFrame([(1, D(2024, 1, d)) for d in (1, 3, 4, 7)] + [(2, D(2024, 1, d)) for d in (2, 7)],
                                "u long, date date")
    batch = facts.datelist_range(act, ["u"], end="2024-01-07")
    prev = spark.createDataFrame([], "u long, date date, device_activity_datelist array<date>")
    rows = []
    for d in range(1, 8):
        day = D(2024, 1, d)
        prev = facts.datelist_cumulate(prev, act, ["u"], str(day)).checkpoint()
        rows += [(r.u, r.date, tuple(r.device_activity_datelist)) for r in prev.collect()]
    got = sorted((r.u, r.date, tuple(r.device_activity_datelist)) for r in batch.collect())
    assert got == sorted(rows)


def test_monthly_arrays_padding_and_rerun(spark):
    daily = spark.createDataFrame([("h", D(2024, 1, 3), 5, 2), ("g", D(2024, 1, 1), 1, 1)],
                                  "host string, date date, hits long, unique_visitors long")
    empty = spark.createDataFrame([], "host string, month_start date, hit_array array<bigint>, "
                                      "unique_visitors_array array<bigint>")
    step = facts.monthly_arrays_step(empty, daily, "2024-01-01")
    step = facts.monthly_arrays_step(step, daily, "2024-01-03")
    got = {r.host: (r.hit_array, r.unique_visitors_array) for r in step.collect()}
    assert got["h"] == ([0, 0, 5], [0, 0, 2])                                 # X9: pad day - 1 zeros
    assert got["g"] == ([1, 0, 0], [1, 0, 0])                                 # skipped day 2 padded
    again = facts.monthly_arrays_step(step, daily, "2024-01-03")
    assert {r.host: r.hit_array for r in again.collect()}["h"] == [0, 0, 5]   # X8: rerun is stable
    batch = {r.host: r.hit_array for r in facts.monthly_arrays(daily, as_of="2024-01-03").collect()}
    assert batch == {"h": [0, 0, 5], "g": [1, 0, 0]}


def test_monthly_arrays_rerun_of_an_earlier_day_keeps_later_slots(spark):
    prev = spark.createDataFrame([("h", D(2024, 1, 1), [1, 2, 3], [1, 1, 1]), (None, D(2024, 1, 1), [4, 0, 6], [1, 0, 1])],
                                 "host string, month_start date, hit_array array<bigint>, unique_visitors_array array<bigint>")
    daily = spark.createDataFrame([("h", D(2024, 1, 2), 9, 5), (None, D(2024, 1, 2), 5, 2), ("new", D(2024, 1, 2), 7, 1)],
                                  "host string, date date, hits long, unique_visitors long")
    step = facts.monthly_arrays_step(prev, daily, "2024-01-02", as_of="2024-01-03")
    got = {r.host: r.hit_array for r in facts.upsert(prev, step, ["host", "month_start"]).collect()}
    assert got == {"h": [1, 9, 3], None: [4, 5, 6], "new": [0, 7, 0]}
    assert step.count() == 3                                                  # a NULL host is one host


def test_monthly_arrays_batch_has_every_month(spark):
    daily = spark.createDataFrame([("h", D(2024, 1, 31), 5, 2), ("h", D(2024, 2, 2), 1, 1)],
                                  "host string, date date, hits long, unique_visitors long")
    got = {r.month_start: r.hit_array for r in facts.monthly_arrays(daily, as_of="2024-02-03").collect()}
    assert got == {D(2024, 1, 1): [0] * 30 + [5], D(2024, 2, 1): [0, 1, 0]}


def test_datelist_skipped_and_rerun_days(spark):
    prev = spark.createDataFrame([("a", D(2024, 1, 1), [D(2024, 1, 1)]), ("b", D(2024, 1, 1), [D(2024, 1, 1)])],
                                 "u string, date date, device_activity_datelist array<date>")
    act = spark.createDataFrame([("a", D(2024, 1, 3)), ("b", D(2024, 1, 2)), (None, D(2024, 1, 3))], "u string, date date")

    def norm(df):
        return sorted(((r.u, r.date, tuple(r.device_activity_datelist)) for r in df.collect()), key=str)
    third = facts.datelist_cumulate(prev, act, ["u"], "2024-01-03")           # the 2nd is skipped
    assert {r.date for r in third.collect()} == {D(2024, 1, 3)}
    assert norm(facts.datelist_cumulate(third, act, ["u"], "2024-01-03")) == norm(third)
    late = facts.datelist_cumulate(third, act, ["u"], "2024-01-02", as_of="2024-01-03")
    assert {r.u: r.device_activity_datelist for r in late.collect()}["b"] == [D(2024, 1, 1), D(2024, 1, 2)]
    assert {r.date for r in late.collect()} == {D(2024, 1, 3)} and late.count() == 3


def test_host_datelist_step_and_upsert_match_null_keys(spark):
    ev = spark.createDataFrame([(None, dt.datetime(2024, 1, 2, 5)), ("h", dt.datetime(2024, 1, 2, 6))], "host string, event_time timestamp_ntz")
    prev = spark.createDataFrame([(None, D(2024, 1, 1), [D(2024, 1, 1)])], "host string, month_start date, host_activity_datelist array<date>")
    step = facts.host_datelist_step(prev, ev, "2024-01-02")
    got = {r.host: r.host_activity_datelist for r in facts.upsert(prev, step, ["host", "month_start"]).collect()}
    assert got == {None: [D(2024, 1, 1), D(2024, 1, 2)], "h": [D(2024, 1, 2)]} and step.count() == 2
    t = spark.createDataFrame([(None, 1)], "k string, v int")
    s = spark.createDataFrame([(None, 2)], "k string, v int")
    assert [tuple(r) for r in facts.upsert(t, s, ["k"]).collect()] == [(None, 2)]
    assert [tuple(r) for r in facts.upsert(t, s, ["k"], set_cols=["v"]).collect()] == [(None, 2)]


def test_dedup_descending_order_map_columns_and_plan(spark):
    df = spark.createDataFrame([(1, 5, {"a": 1}), (1, 7, {"b": 2}), (2, None, {})], "k int, o int, m map<string,int>")
    got = {r.k: (r.o, r.m) for r in facts.dedup(df, ["k"], [F.col("o").desc_nulls_last()]).collect()}
    assert got == {1: (7, {"b": 2}), 2: (None, {})}
    plan = facts.dedup(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2                                # before and after the shuffle


def test_upsert_replaces_conflicts(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, note string")
    s = spark.createDataFrame([("b", 20, "z"), ("c", 30, "w")], "k string, v int, note string")
    assert sorted(tuple(r) for r in facts.upsert(t, s, ["k"]).collect()) == [("a", 1, "x"), ("b", 20, "z"),
                                                                             ("c", 30, "w")]
    partial = sorted(tuple(r) for r in facts.upsert(t, s, ["k"], set_cols=["v"]).collect())
    assert partial == [("a", 1, "x"), ("b", 20, "y"), ("c", 30, None)]


def test_datelist_mask_plan_has_no_cross_join(spark):
    df = spark.createDataFrame([(1, [D(2024, 1, 30)])], "u long, l array<date>")
    plan = facts.datelist_int(df, "l", "2024-01-30")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
