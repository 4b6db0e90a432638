"""Sessionization (T4, T7, T8, M6): fixtures, brute force, and streaming =
batch through Structured Streaming with a file source."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from tributary.operators import sessions as ss
from tributary.streaming import read_events_stream, sessionize_stream, start_query, parquet_batch_writer

T = dt.datetime


def test_gap_is_inclusive_fixture(spark):
    ts = [T(2024, 1, 1, 0, 0, 0), T(2024, 1, 1, 0, 5, 0), T(2024, 1, 1, 0, 9, 59), T(2024, 1, 1, 0, 15, 0)]
    df = spark.createDataFrame([("h", "1", t) for t in ts], "host string, ip string, ts timestamp_ntz")
    got = sorted((r.session_start, r.num_hits) for r in ss.sessionize(df, "ts", ["host", "ip"]).collect())
    assert got == [(T(2024, 1, 1, 0, 0), 3), (T(2024, 1, 1, 0, 15), 1)]


def test_avg_hits_rounds_half_up(spark):
    df = spark.createDataFrame([("a.io", "1", 1), ("a.io", "1", 2), ("a.io", "2", 2), ("a.io", "2", 3)],
                               "host string, ip string, num_hits long")
    got = {r.ip: r.average_num_hits for r in ss.avg_session_hits(df, host_like="%.io").collect()}
    assert got == {"1": 2, "2": 3}


def _brute_sessions(rows, gap_s):
    out = []
    for key in sorted({r[0] for r in rows}):
        ts = sorted(r[1] for r in rows if r[0] == key)
        start = prev = ts[0]
        n = 1
        for t in ts[1:]:
            if (t - prev).total_seconds() > gap_s:
                out.append((key, start, n))
                start, n = t, 0
            n += 1
            prev = t
        out.append((key, start, n))
    return sorted(out)


def test_sessionize_matches_brute_force_at_any_partitioning(spark):
    rnd = random.Random(3)
    base = T(2024, 1, 1)
    rows = [(rnd.choice("ab"), base + dt.timedelta(seconds=rnd.randrange(0, 6 * 3600))) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    want = _brute_sessions(rows, 300)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 3, 8, 40):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for adaptive in ("true", "false"):
                spark.conf.set("spark.sql.adaptive.enabled", adaptive)
                got = sorted((r.k, r.session_start, r.num_hits) for r in ss.sessionize(df, "ts", ["k"], "5 minutes").collect())
                assert got == want, (parts, adaptive)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_moment_of_one_key_is_spread(spark):
    """All events of one key in three seconds, most in one: no task gets more
    than its share, and the split ties are one session again."""
    from tributary.operators.scan import ordered_segments
    df = spark.range(40_000).selectExpr("'hot' as k", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,if(id % 10 < 8, 1, id % 3)) as ts")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in ordered_segments(df, ["k"], ["ts"]).groupBy("_seg").count().collect()]
        got = ss.sessionize(df, "ts", ["k"], "5 minutes").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
    assert [(r.num_hits, (r.last_event - r.session_start).total_seconds()) for r in got] == [(40_000, 2.0)]


def test_time_per_user_day_splits_midnight(spark):
    ts = [T(2024, 1, 1, 23, 50), T(2024, 1, 2, 0, 10), T(2024, 1, 2, 5, 0)]
    df = spark.createDataFrame([(1, t) for t in ts], "user_id long, ts timestamp_ntz")
    got = {r.day: r.active_micros for r in ss.time_per_user_day(df).collect()}
    assert got == {dt.date(2024, 1, 1): 600_000_000, dt.date(2024, 1, 2): 600_000_000}


def test_stream_equals_batch(spark, scratch):
    """Web-traffic JSON files -> parse -> watermark -> session windows; a late
    sentinel event moves the watermark past every real session."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_type").alias("host"), (F.col("user_id") % 3).cast("string").alias("ip"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"))
    rows = [r.asDict() for r in ev.collect()]
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows.sort(key=lambda r: r["event_time"])
    for n, i in enumerate(range(0, len(rows), 250)):
        path = os.path.join(src, f"part-{i:05d}.json")
        with open(path, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows[i:i + 250])
        os.utime(path, (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))   # files arrive in time order
    sentinel = os.path.join(src, "part-99999.json")
    with open(sentinel, "w") as f:
        f.write(json.dumps({"host": "zz-sentinel", "ip": "0", "event_time": "2025-01-01T00:00:00.000Z"}) + "\n")
    os.utime(sentinel, (1_800_000_000, 1_800_000_000))

    stream = read_events_stream(spark, "json", path=src, watermark="15 seconds", max_files_per_trigger=1)
    out = os.path.join(scratch, "out")
    q = start_query(sessionize_stream(stream), parquet_batch_writer(out), name="sessions_test",
                    checkpoint=os.path.join(scratch, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(300)
    streamed = sorted((r.event_window_timestamp, r.host, r.ip, r.num_hits)
                      for r in spark.read.parquet(out).collect() if r.host != "zz-sentinel")

    from tributary.streaming.sources import parse_web_events
    batch_in = parse_web_events(spark.read.json(src, schema="ip string, event_time string, referrer string, "
                                                            "host string, url string, geodata string"),
                                value_col=None, watermark=None).filter("host != 'zz-sentinel'")
    batch_sessions = ss.sessionize(batch_in, "window_timestamp", ["host", "ip"])
    batch = sorted((r.session_start, r.host, r.ip, r.num_hits) for r in batch_sessions.collect())
    assert len(batch) > 500 and streamed == batch
    # the reference's follow-up analysis (T7, T8) on the stream's sink equals the batch result
    sink = spark.read.parquet(out).filter("host != 'zz-sentinel'")
    for analyse in (lambda d: ss.avg_session_hits(d, host_like="%e"),
                    lambda d: ss.compare_hosts(d, ["click", "view", "signup"])):
        assert sorted(map(tuple, analyse(sink).collect())) == sorted(map(tuple, analyse(batch_sessions).collect()))


def test_stream_dedup_within_watermark(spark, scratch):
    from tributary.streaming import dedup_stream
    rows = [(i % 50, T(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(200)]
    src = os.path.join(scratch, "clicks")
    spark.createDataFrame(rows, "event_id long, ts timestamp").repartition(4).write.parquet(src)
    stream = spark.readStream.schema("event_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "dedup_out")
    q = start_query(dedup_stream(stream, ["event_id"], ts="ts", delay="1 hour"), parquet_batch_writer(out),
                    name="dedup_test", checkpoint=os.path.join(scratch, "ckpt2"), trigger={"availableNow": True})
    q.awaitTermination(300)
    ids = [r.event_id for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == list(range(50))


def test_snapshot_fold_writes_new_paths(spark, scratch):
    """Each period writes its own snapshot path and reads only the previous
    one (never overwrites what it reads)."""
    from tributary.operators import facts
    from tributary.sources.layout import write_snapshot
    act = spark.createDataFrame([(1, dt.date(2024, 1, d)) for d in (1, 2, 4)], "u long, date date")
    prev = spark.createDataFrame([], "u long, date date, device_activity_datelist array<date>")
    for d in range(1, 5):
        day = dt.date(2024, 1, d)
        prev = write_snapshot(facts.datelist_cumulate(prev, act, ["u"], str(day)),
                              os.path.join(scratch, f"snap/date={day}"))
    r = prev.first()
    assert r.date == dt.date(2024, 1, 4) and r.device_activity_datelist == [dt.date(2024, 1, d) for d in (1, 2, 4)]


def test_stream_drops_events_behind_the_watermark(spark, scratch):
    """Late data (T3): once a session has been emitted, a later event that
    would fall into it is behind the watermark and is dropped; it does not
    reopen the session.  Spark moves the watermark at micro-batch boundaries,
    so a late row arriving in the very batch that closes its session still
    joins it (Flink checks per event); the case below is past that batch."""
    src = os.path.join(scratch, "late_in")
    os.makedirs(src)
    batches = [[("a", "1", "2024-01-01T00:00:00.000Z")],
               [("b", "1", "2024-01-01T01:00:00.000Z")],                 # watermark -> 00:59:45
               [("c", "1", "2024-01-01T02:00:00.000Z")],                 # session a emitted
               [("a", "1", "2024-01-01T00:00:30.000Z")],                 # late: dropped
               [("zz", "0", "2025-01-01T00:00:00.000Z")]]                # flushes the rest
    for i, rows in enumerate(batches):
        path = os.path.join(src, f"part-{i}.json")
        with open(path, "w") as f:
            f.writelines(json.dumps({"host": h, "ip": ip, "event_time": t}) + "\n" for h, ip, t in rows)
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))   # arrival order = file age
    stream = read_events_stream(spark, "json", path=src, watermark="15 seconds", max_files_per_trigger=1)
    out = os.path.join(scratch, "late_out")
    q = start_query(sessionize_stream(stream), parquet_batch_writer(out), name="late_test",
                    checkpoint=os.path.join(scratch, "ckpt_late"), trigger={"availableNow": True})
    q.awaitTermination(300)
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    got = {(r.host, r.num_hits) for r in spark.read.parquet(out).collect()}
    assert ("a", 1) in got and ("a", 2) not in got and ("b", 1) in got and dropped == 1


def test_sessionize_bursts(spark):
    """A burst (one key, thousands of events in one hour): the sessions of brute
    force, and the events are scanned and windowed once."""
    rnd = random.Random(11)
    base = T(2024, 1, 1, 10)
    rows = [("hot", base + dt.timedelta(seconds=rnd.randrange(0, 3600))) for _ in range(3000)]
    rows += [("hot", base + dt.timedelta(hours=h, seconds=rnd.randrange(0, 60))) for h in range(2, 6)]
    rows += [("cold", base + dt.timedelta(minutes=17 * i)) for i in range(30)]
    rows += [(None, base + dt.timedelta(minutes=4 * i)) for i in range(9)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    out = ss.sessionize(df, "ts", ["k"], "5 minutes")
    got = {(r.k, r.session_start, r.num_hits) for r in out.collect()}
    assert got == set(_brute_sessions([r for r in rows if r[0] in ("hot", "cold")], 300)) | {(None, base, 9)}
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Scan ") == 1 and "Union" not in plan


def test_session_stream_on_rocksdb_state(spark, scratch):
    """Large state: the same session-window stream on the RocksDB state
    store with changelog checkpointing."""
    from tributary.streaming import stream_state_conf
    conf = stream_state_conf()
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        src = os.path.join(scratch, "rocks_in")
        os.makedirs(src)
        times = ["2024-01-01T00:00:00.000Z", "2024-01-01T00:04:00.000Z", "2024-01-01T00:20:00.000Z",
                 "2025-01-01T00:00:00.000Z"]
        for i, t in enumerate(times):
            path = os.path.join(src, f"p{i}.json")
            with open(path, "w") as f:
                f.write(json.dumps({"host": "h", "ip": "1", "event_time": t}) + "\n")
            os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        stream = read_events_stream(spark, "json", path=src, max_files_per_trigger=1)
        out = os.path.join(scratch, "rocks_out")
        q = start_query(sessionize_stream(stream), parquet_batch_writer(out), name="rocks_test",
                        checkpoint=os.path.join(scratch, "ckpt_rocks"), trigger={"availableNow": True})
        q.awaitTermination(300)
        assert sorted(r.num_hits for r in spark.read.parquet(out).collect()) == [1, 2]
        assert any(k.startswith("rocksdb") for p in q.recentProgress for s in p["stateOperators"]
                   for k in s.get("customMetrics", {}))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
