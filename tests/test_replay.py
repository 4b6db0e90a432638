"""Bounded stream replay (T2-T6, M7) against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import sessions as ss
from tributary.streaming import dedup_stream, replay, sessionize_stream

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """A hot key, sessions across any cut, ties, exact gaps, a missing time."""
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["hot"] * 4 + ["a", "b"]), rnd.choice("xy"), BASE + dt.timedelta(seconds=rnd.randrange(0, 40_000))) for i in range(700)]
    rows += [(1000 + i, "c", "x", BASE + dt.timedelta(minutes=5 * i)) for i in range(130)] + [(2000, "c", "x", None)]
    return spark.createDataFrame(rows, "event_id long, host string, ip string, ts timestamp_ntz").repartition(3).cache()


def streamed(s):
    return sessionize_stream(s.withWatermark("ts", "15 seconds"), "ts")


@pytest.mark.parametrize("slices", [1, 2, 4])
def test_sessions_equal_the_batch_at_any_restart(events, slices):
    got = replay(events, "ts", streamed, name="t", slices=slices, close="event_window_timestamp")
    want = ss.sessionize(events, "ts", ["host", "ip"]).select("session_start", "host", "ip", "session_end", "num_hits")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_without_the_closing_row_open_sessions_stay_in_the_stream(events):
    """What the watermark (last event - 15 s) has passed is written, once; what
    it has not passed is held back."""
    want = {tuple(r) for r in ss.sessionize(events, "ts", ["host", "ip"]).select("session_start", "host", "ip", "session_end", "num_hits").collect()}
    got = [tuple(r) for r in replay(events, "ts", streamed, name="t", slices=3).collect()]
    mark = events.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=15)
    assert len(got) == len(set(got)) and set(got) == {r for r in want if r[3] <= mark} and set(got) < want


@pytest.mark.parametrize("slices", [1, 3])
def test_every_event_once_though_delivered_twice(events, slices):
    out = replay(events.filter("ts is not null"), "ts", lambda s: dedup_stream(s, ["event_id"], ts="ts", delay="1 hour"), name="d", slices=slices, redeliver=True)
    assert sorted(r.event_id for r in out.collect()) == sorted(r.event_id for r in events.filter("ts is not null").collect())


def test_empty_table(events):
    assert replay(events.limit(0), "ts", streamed, name="e", close="event_window_timestamp").collect() == []
