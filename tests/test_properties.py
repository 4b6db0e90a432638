"""Property tests (hypothesis) for the chunked operators: for random keys,
orders, bucket widths and window sizes they equal the plain per-key window
or a brute-force scan."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary.operators import patterns as pt
from tributary.operators import sessions as ss

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.booleans()), min_size=1, max_size=80)


@SETTINGS
@given(rows=rows_st, n=st.integers(1, 12), width=st.integers(1, 15))
def test_rolling_rows_property(spark, rows, n, width):
    data = [(k, i, v, c) for i, (k, v, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, o int, v int, c boolean")
    got = pt.rolling_rows(df, "k", ["o"], "v", n, bucket=F.floor(F.col("o") / width), out="r")
    want = df.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("o").rowsBetween(-(n - 1), 0)))
    assert sorted(map(tuple, got.select("k", "o", "r").collect())) == \
        sorted(map(tuple, want.select("k", "o", "r").collect()))


@SETTINGS
@given(rows=rows_st, width=st.integers(1, 15))
def test_longest_streak_property(spark, rows, width):
    data = [(k, i, v, c) for i, (k, v, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, o int, v int, c boolean")
    got = {r.k: r.longest_streak for r in
           pt.longest_streak(df, "k", ["o"], F.col("c"), bucket=F.floor(F.col("o") / width)).collect()}
    want = {}
    cur = {}
    for k, _, _, c in data:
        cur[k] = cur.get(k, 0) + 1 if c else 0
        want[k] = max(want.get(k, 0), cur[k])
    assert got == want


@SETTINGS
@given(events=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 7200)), min_size=1, max_size=60),
       gap_min=st.integers(1, 20))
def test_sessionize_property(spark, events, gap_min):
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(seconds=s)) for k, s in events]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    got = sorted((r.k, r.session_start, r.num_hits) for r in
                 ss.sessionize(df, "ts", ["k"], f"{gap_min} minutes").collect())
    want = []
    for key in sorted({k for k, _ in rows}):
        ts = sorted(t for k, t in rows if k == key)
        start, prev, n = ts[0], ts[0], 0
        for t in ts:
            if (t - prev).total_seconds() > gap_min * 60:
                want.append((key, start, n))
                start, n = t, 0
            n += 1
            prev = t
        want.append((key, start, n))
    assert got == sorted(want)


@SETTINGS
@given(rows=rows_st, n=st.integers(1, 12), width=st.integers(1, 20))
def test_rolling_rows_at_any_bucket_width(spark, rows, n, width):
    data = [(k, i, v, c) for i, (k, v, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, o int, v int, c boolean")
    got = pt.rolling_rows(df, "k", ["o"], "v", n, bucket=F.floor(F.col("o") / width), out="r")
    want = df.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("o").rowsBetween(-(n - 1), 0)))
    assert sorted(map(tuple, got.select("k", "o", "r").collect())) == \
        sorted(map(tuple, want.select("k", "o", "r").collect()))


@SETTINGS
@given(rows=rows_st, width=st.integers(1, 20))
def test_longest_streak_at_any_bucket_width(spark, rows, width):
    data = [(k, i, v, c) for i, (k, v, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, o int, v int, c boolean")
    got = {r.k: r.longest_streak for r in
           pt.longest_streak(df, "k", ["o"], F.col("c"), bucket=F.floor(F.col("o") / width)).collect()}
    want, cur = {}, {}
    for k, _, _, c in data:
        cur[k] = cur.get(k, 0) + 1 if c else 0
        want[k] = max(want.get(k, 0), cur[k])
    assert got == want


@SETTINGS
@given(minutes=st.lists(st.integers(0, 3000), min_size=2, max_size=60), gap=st.integers(1, 120),
       fanout=st.integers(1, 8), keyed=st.booleans())
def test_find_gaps_property(spark, minutes, gap, fanout, keyed):
    from tributary.operators import monitoring as mo
    base = dt.datetime(2024, 1, 1)
    rows = [(i % 2 if keyed else 0, base + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz")
    got = sorted(tuple(r) for r in mo.find_gaps(df, "ts", f"{gap} minutes", keys=["k"] if keyed else [],
                                                 fanout=fanout).select(
        *(["k"] if keyed else []), "gap_start", "gap_end").collect())
    want = []
    for key in sorted({k for k, _ in rows}):
        ts = sorted({t for k, t in rows if k == key})
        want += [((key,) if keyed else ()) + (a, b) for a, b in zip(ts, ts[1:])
                 if (b - a) > dt.timedelta(minutes=gap)]
    assert got == sorted(want)
