"""Sessionization and session analytics.

Batch :func:`sessionize` gives the same sessions as Structured Streaming's
``session_window`` (gap inclusive: events exactly ``gap`` apart share a
session, V9) but is skew-safe, a two-phase scan over ordered segments
(:mod:`tributary.operators.scan`):

1. per (segment, keys): ``lag`` / running-sum sessions inside the segment;
2. only the first and last session of each segment can touch a neighbouring
   segment, so just those are merged per key, ordered by start.

A key with a third of all events is thus spread over many tasks even if all
of them fall into one second; the per-key step sees at most two rows per
shuffle partition.  Times are handled as
wall-clock ``timestamp_ntz`` micros, independent of the session time zone;
the streaming twin casts to ``timestamp`` first, as watermarks require it (V8).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.nulls import round_half_away
from tributary.operators.scan import ordered_segments

_US = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_micros(text: str) -> int:
    """'5 minutes' -> microseconds (literal intervals only, as in the reference)."""
    n, unit = text.split()
    return int(float(n) * _US[unit.rstrip("s").lower()])


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def to_micros(ts: str | Column) -> Column:
    """Microseconds since the epoch of the wall-clock time.  Computed on
    ``timestamp_ntz`` so the result does not depend on the session time zone
    (no DST hour appears in differences)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", _epoch(), c.cast("timestamp_ntz"))


def from_micros(us: Column) -> Column:
    """Inverse of :func:`to_micros`, as ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", us, _epoch())


def sessionize(df: DataFrame, ts: str, keys: Sequence[str], gap: str = "5 minutes", *,
               start: str = "session_start", end: str = "session_end",
               last: str = "last_event", count: str = "num_hits") -> DataFrame:
    """Sessions per ``keys`` with an inclusive inactivity ``gap`` (T4).

    Output per session: keys, start (first event), end (last event + gap, as
    ``session_window``), last event, event count.  Events without a time are
    left out; NULL keys are keys.

    Segments are balanced by row count, so no width is to be chosen and a burst
    inside a moment is spread.  Events pass one range partitioning, then one sort
    and one window per (segment, keys)."""
    keys = list(keys)
    gap_us = interval_micros(gap)
    ev = df.select(*keys, to_micros(ts).alias("_us")).filter(F.col("_us").isNotNull())
    ev = ordered_segments(ev, keys, ["_us"])
    w1 = Window.partitionBy("_seg", *keys).orderBy("_us")
    prev = F.lag("_us").over(w1)
    ev = ev.withColumn("_new", (prev.isNull() | (F.col("_us") - prev > gap_us)).cast("int"))
    ev = ev.withColumn("_sid", F.sum("_new").over(w1.rowsBetween(Window.unboundedPreceding, 0)))
    # the segment's last row marks its last session (same window, no extra sort)
    ev = ev.withColumn("_tail", F.lead("_us").over(w1).isNull().cast("int"))
    local = (ev.groupBy("_seg", *keys, "_sid")
             .agg(F.min("_us").alias("_s"), F.max("_us").alias("_e"), F.count(F.lit(1)).alias("_n"),
                  F.max("_tail").alias("_tail")))
    # inner sessions stay as they are in a partition of their own; the edge
    # sessions of a key meet in one.  One plan branch for both.
    edge = (F.col("_sid") == 1) | (F.col("_tail") == 1)
    out = _merge_runs(local.select(*keys, "_s", "_e", "_n", F.when(~edge, F.col("_s")).alias("_own")), [*keys, "_own"], gap_us)
    return out.select(*keys, from_micros(F.col("_s")).alias(start),
                      from_micros(F.col("_e") + gap_us).alias(end),
                      from_micros(F.col("_e")).alias(last), F.col("_n").cast("long").alias(count))


def _merge_runs(df: DataFrame, part: Sequence[str], gap_us: int) -> DataFrame:
    """Merge time-ordered runs (_s, _e, _n) within ``part`` whose distance is at
    most the gap.  Runs may touch at one time (a tie split between segments),
    so those of one start are ordered by their end."""
    w = Window.partitionBy(*part).orderBy("_s", "_e")
    pe = F.lag("_e").over(w)
    x = (df.withColumn("_new", (pe.isNull() | (F.col("_s") - pe > gap_us)).cast("int"))
         .withColumn("_mid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return (x.groupBy(*part, "_mid")
            .agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("_n").alias("_n")))


def avg_session_hits(sessions: DataFrame, *, host_like: str, host: str = "host", ip: str = "ip",
                     hits: str = "num_hits", out: str = "average_num_hits") -> DataFrame:
    """Average hits per session by ip and host for hosts matching a LIKE
    pattern (T7), rounded half up like PostgreSQL's integer cast (V3)."""
    return (sessions.filter(F.col(host).like(host_like)).groupBy(ip, host)
            .agg(round_half_away(F.avg(hits)).alias(out)))


def compare_hosts(sessions: DataFrame, hosts: Sequence[str], *, host: str = "host", ip: str = "ip",
                  hits: str = "num_hits") -> DataFrame:
    """Distinct ips, sessions, hits and average hits per host for a host list
    (T8, X14: the list is a parameter), the average rounded half up like
    PostgreSQL's integer cast (V3)."""
    g = (sessions.filter(F.col(host).isin(list(hosts))).groupBy(host)
         .agg(F.count_distinct(ip).alias("n_ips"), F.count(F.lit(1)).alias("n_sessions"),
              F.sum(hits).alias("total_hits")))
    return g.withColumn("avg_hits", round_half_away(F.col("total_hits") / F.col("n_sessions")))


def time_per_user_day(events: DataFrame, *, user: str = "user_id", ts: str = "ts",
                      gap: str = "30 minutes", out: str = "active_micros") -> DataFrame:
    """Engagement (M6): per user and day, the time covered by the user's
    sessions (first to last event of each session), with sessions split at
    midnight.  Microseconds as ``bigint`` keep the sum exact."""
    s = sessionize(events, ts, [user], gap, start="_st", end="_en", last="_la", count="_n")
    days = s.select(user, "_st", "_la", F.explode(F.sequence(F.to_date("_st"), F.to_date("_la"))).alias("day"))
    lo = F.greatest(to_micros("_st"), to_micros(F.col("day").cast("timestamp_ntz")))
    hi = F.least(to_micros("_la"), to_micros(F.date_add("day", 1).cast("timestamp_ntz")))
    return days.groupBy(user, "day").agg(F.sum(hi - lo).cast("long").alias(out))
