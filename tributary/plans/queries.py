"""Registered queries: each operator from SURVEY §2 run over the whole driver
tables.  Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns are scalar and named like the matching SQL in ``oracle.py``.

Doubles are rounded to 4 places; integer measures are ``bigint``; periods
are ``int``; dates are ``date``; timestamps are ``timestamp_ntz``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tributary import functions as fx
from tributary.operators import cumulative as cu
from tributary.operators import experiments as xp
from tributary.operators import facts
from tributary.operators import history as hs
from tributary.operators import joins as jn
from tributary.operators import monitoring as mo
from tributary.operators import patterns as pt
from tributary.operators import scd
from tributary.operators import sessions as ss
from tributary.plans import derive as dv
from tributary.session import shared_path
from tributary.sources import layout, merge, quarantine
from tributary.streaming import dedup_stream, replay, sessionize_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _r4(c):
    return F.round(c, 4)


# --- dimensions (D1-D13) ------------------------------------------------------

def film_segments(spark, sf_dir):
    """Film history in bounded segments with their sums, per actor and year."""
    return hs.history_segments(
        dv.actor_films(spark, sf_dir), ["actorid"], "year", ["film", "votes", "rating", "filmid"], order_by=["filmid"],
        sums={"total_votes": F.col("votes").cast("long"), "rating_sum": F.col("rating")}, carry=["actor"])


def film_periods(segments):
    """One row per actor and year from the segments' sums."""
    per = hs.period_summary(segments, ["actorid"], "year", sums=["total_votes", "rating_sum"], carry=["actor"])
    return per.select("actorid", "actor", "year", "n_items", F.col("first_item.filmid").alias("filmid_min"), F.col("last_item.filmid").alias("filmid_max"),
                      "total_votes", (F.col("rating_sum") / F.col("n_items")).alias("average_rating"))


def film_snapshots(per, end):
    s = cu.cumulate_range_summary(per, ["actorid"], period="year", end=end, measure="average_rating",
                                  running_sums=["n_items", "total_votes"], firsts=["filmid_min"], lasts=["filmid_max"], carry=["actor"])
    return s.select("actorid", "actor", "current_year", F.col("n_items").alias("n_films"), F.col("first_filmid_min").alias("first_filmid"),
                    F.col("last_filmid_max").alias("last_filmid"), "total_votes", "quality_class", "is_active")


def actor_classes(spark, sf_dir):
    """Class and activity per actor and year, for the consumers that read
    nothing else (SCD2, state change, account changes): the array-free
    snapshot, so no film history is built or moved."""
    per = (dv.actor_films(spark, sf_dir).groupBy("actorid", "year")
           .agg(F.avg("rating").alias("average_rating")))
    return cu.cumulate_range_summary(per, ["actorid"], period="year", end=dv.LAST_YEAR,
                                     measure="average_rating")


def season_snapshots(spark, sf_dir):
    ps = dv.player_seasons(spark, sf_dir).select(
        "player_id", "season", "pts",
        F.array(F.struct("season", "gp", "pts")).alias("current_items"))
    return cu.cumulate_range(ps, ["player_id"], period="season", 
                             end=dv.LAST_YEAR, out_period="current_season", history="season_stats",
                             measure="pts", class_col="scoring_class", thresholds=cu.SCORING_CLASSES,
                             idle_counter="years_since_last_season")


@register("dim_period_rollup")
def q_dim_period_rollup(spark, sf_dir):
    return film_periods(film_segments(spark, sf_dir)).select(
        "actorid", "year", F.col("n_items").alias("n_films"), F.col("filmid_min").alias("first_filmid"), F.col("filmid_max").alias("last_filmid"),
        _r4(F.col("average_rating")).alias("average_rating"), cu.classify("average_rating").alias("quality_class"))


@register("dim_cumulative_snapshot")
def q_dim_cumulative_snapshot(spark, sf_dir):
    """D2-D5 over the segmented history: an actor's snapshot of a year stands
    for all its segments up to that year."""
    return film_snapshots(film_periods(film_segments(spark, sf_dir)), dv.LAST_YEAR)


@register("dim_cumulative_summary")
def q_dim_cumulative_summary(spark, sf_dir):
    """D2-D5 without history arrays: per-period partial aggregates, then
    running window aggregates.  Same result as ``dim_cumulative_snapshot``."""
    per = (dv.actor_films(spark, sf_dir).groupBy("actorid", "year")
           .agg(F.count(F.lit(1)).alias("n_films"), F.min("filmid").alias("filmid_min"),
                F.max("filmid").alias("filmid_max"), F.sum("votes").cast("long").alias("total_votes"),
                F.avg("rating").alias("average_rating"), F.max("actor").alias("actor")))
    s = cu.cumulate_range_summary(per, ["actorid"], period="year", end=dv.LAST_YEAR,
                                  measure="average_rating", running_sums=["n_films", "total_votes"],
                                  firsts=["filmid_min"], lasts=["filmid_max"], carry=["actor"])
    return s.select("actorid", "actor", "current_year", "n_films",
                    F.col("first_filmid_min").alias("first_filmid"), F.col("last_filmid_max").alias("last_filmid"),
                    "total_votes", "quality_class", "is_active")


@register("dim_cumulative_step")
def q_dim_cumulative_step(spark, sf_dir):
    """D2 incremental step: the snapshot up to the year before, merged with
    the last year's segments, equals the last year of the one-pass range."""
    per = film_periods(film_segments(spark, sf_dir))
    prev = film_snapshots(per, dv.LAST_YEAR - 1).filter(F.col("current_year") == dv.LAST_YEAR - 1)
    cur = per.filter(F.col("year") == dv.LAST_YEAR).withColumnsRenamed({"n_items": "n_films", "filmid_min": "first_filmid", "filmid_max": "last_filmid"})
    return hs.cumulate_summary(prev, cur, ["actorid"], sums=["n_films", "total_votes"], firsts=["first_filmid"], lasts=["last_filmid"],
                               carry=["actor"], measure="average_rating")


@register("dim_cumulative_seasons")
def q_dim_cumulative_seasons(spark, sf_dir):
    s = season_snapshots(spark, sf_dir)
    return s.select("player_id", "current_season",
                    F.size("season_stats").cast("long").alias("n_seasons"),
                    F.aggregate("season_stats", F.lit(0).cast("long"), lambda acc, x: acc + x["gp"]).alias("total_gp"),
                    "scoring_class", "years_since_last_season", "is_active")


@register("dim_scd2_backfill")
def q_dim_scd2_backfill(spark, sf_dir):
    snap = actor_classes(spark, sf_dir)
    return scd.scd2_backfill(snap, "actorid", "current_year", ["quality_class", "is_active"],
                             as_of=dv.LAST_YEAR)


@register("dim_scd2_incremental")
def q_dim_scd2_incremental(spark, sf_dir):
    snap = actor_classes(spark, sf_dir)
    hist = scd.scd2_backfill(snap, "actorid", "current_year", ["quality_class", "is_active"],
                             as_of=dv.LAST_YEAR - 1)
    cur = snap.filter(F.col("current_year") == dv.LAST_YEAR)
    return scd.scd2_merge(hist, cur, "actorid", ["quality_class", "is_active"],
                          prev_as_of=dv.LAST_YEAR - 1, new_period=dv.LAST_YEAR)


@register("dim_scd2_stepwise")
def q_dim_scd2_stepwise(spark, sf_dir):
    """D8 as it runs every year: a backfill up to 1998, then a step a year that
    reads and writes one partition (the last one twice); equals the backfill."""
    snap = actor_classes(spark, sf_dir)
    path, attrs = shared_path(spark, "scd2", uuid.uuid4().hex), ["quality_class", "is_active"]
    first = dv.LAST_YEAR - 3
    merge.replace_partitions(scd.scd2_backfill(snap, "actorid", "current_year", attrs, as_of=first), path, "current_year")
    for year in (first + 1, first + 2, first + 3, first + 3):
        merge.scd2_step(path, snap.filter(F.col("current_year") == year), "actorid", attrs, period=year)
    return merge.scd2_as_of(spark, path, dv.LAST_YEAR)


@register("dim_unnest_history")
def q_dim_unnest_history(spark, sf_dir):
    """D11 over the segments of the last snapshot: no actor's history is ever
    one array."""
    rows = cu.unnest(film_segments(spark, sf_dir).filter(F.col("year") <= dv.LAST_YEAR), "items", ["actorid"], expand=True)
    return rows.select("actorid", "film", "votes", _r4(F.col("rating")).alias("rating"), "filmid")


@register("dim_unnest_points")
def q_dim_unnest_points(spark, sf_dir):
    """Whole season structs to rows, and one field of them."""
    snap = season_snapshots(spark, sf_dir).filter(F.col("current_season") == dv.LAST_YEAR)
    whole = cu.unnest(snap, "season_stats", ["player_id"], alias="stat").groupBy("player_id").agg(
        F.count("stat").alias("n_seasons"), F.sum("stat.gp").cast("long").alias("total_gp"))
    field = cu.unnest(snap, "season_stats", ["player_id"], field="season").groupBy("player_id").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    return whole.join(field, "player_id")


@register("dim_table_checks")
def q_dim_table_checks(spark, sf_dir):
    """Duplicate keys and labels outside the enum, per table."""
    snap, act = actor_classes(spark, sf_dir), device_activity(spark, sf_dir)
    ses = web_sessions(spark, sf_dir)

    def row(name, df, keys, bad=None):
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.lit(False) if bad is None else bad).alias("bad"))
        return per_key.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("duplicate_keys"), F.sum("bad").alias("bad_values")).select(
            F.lit(name).alias("table_name"), "n_rows", "duplicate_keys", "bad_values")

    return (row("actors", snap, ["actorid", "current_year"], ~F.col("quality_class").isin(cu.CLASS_ORDER))
            .unionByName(row("device_activity", act, [*DEVICE_KEYS, "date"]))
            .unionByName(row("sessions", ses, ["event_window_timestamp", "host", "ip"])))


@register("dim_growth_ratio")
def q_dim_growth_ratio(spark, sf_dir):
    snap = season_snapshots(spark, sf_dir).filter(F.col("current_season") == dv.LAST_YEAR)
    g = cu.growth_ratio(snap, "season_stats", "pts", ["player_id"], class_col="scoring_class",
                        only_class="star", out="pts_ratio")
    return g.select("player_id", _r4(F.col("first_pts")).alias("first_pts"),
                    _r4(F.col("last_pts")).alias("last_pts"), _r4(F.col("pts_ratio")).alias("pts_ratio"))


@register("dim_growth_ratio_summary")
def q_dim_growth_ratio_summary(spark, sf_dir):
    """D13 from the array-free season snapshot: first and latest points of
    each star player's active seasons, no season arrays."""
    per = dv.player_seasons(spark, sf_dir)
    s = cu.cumulate_range_summary(per, ["player_id"], period="season", end=dv.LAST_YEAR,
                                  out_period="current_season", measure="pts", class_col="scoring_class",
                                  thresholds=cu.SCORING_CLASSES, firsts=["pts"], lasts=["pts"])
    star = s.filter((F.col("current_season") == dv.LAST_YEAR) & (F.col("scoring_class") == "star"))
    den = F.when(F.col("first_pts") == 0, F.lit(1.0)).otherwise(F.col("first_pts"))
    return star.select("player_id", _r4(F.col("first_pts")).alias("first_pts"),
                       _r4(F.col("last_pts")).alias("last_pts"), _r4(F.col("last_pts") / den).alias("pts_ratio"))


@register("dim_profile_seasons")
def q_dim_profile_seasons(spark, sf_dir):
    """D15 profile: players per season and the first season overall.  The
    minimum is a window over the per-season rows (one row per season), not
    over the data."""
    ps = dv.player_seasons(spark, sf_dir)
    per = ps.groupBy("season").agg(F.count(F.lit(1)).alias("n_players"))
    return per.withColumn("first_season", F.min("season").over(Window.partitionBy()))


# --- facts (F1-F13) -----------------------------------------------------------

def _clock_text(q, ln):
    """``"MM:SS"`` text from quantity and line number, with the malformed
    shapes the reference meets ('' and minutes only)."""
    mins = q.cast("int").cast("string")
    return (F.when(ln == 7, F.lit("")).when(ln == 6, mins)
            .otherwise(F.concat(mins, F.lit(":"), F.lpad(((ln * 7) % 60).cast("string"), 2, "0"))))


@register("fact_dedup_game_details")
def q_fact_dedup_game_details(spark, sf_dir):
    li = dv.table(spark, sf_dir, "lineitem")
    o = dv.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority")
    d = facts.dedup(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    j = facts.enrich(d, o, on=["l_orderkey"], how="left")
    return facts.project(j, {
        "dim_game_id": "l_orderkey",
        "dim_line": "l_linenumber",
        "dim_game_date": F.to_date("o_orderdate"),
        "dim_season": F.year("o_orderdate"),
        "dim_team_id": "l_suppkey",
        "dim_player_id": "l_partkey",
        "dim_is_playing_at_home": (F.col("l_suppkey") % 30) == (F.col("o_custkey") % 30),
        "dim_did_not_play": fx.flag_contains("o_orderpriority", "URGENT"),
        "dim_did_not_dress": fx.flag_contains("o_orderpriority", "HIGH"),
        "dim_not_with_team": fx.flag_contains("o_orderpriority", "LOW"),
        "m_minutes": _r4(fx.clock_to_minutes(_clock_text(F.col("l_quantity"), F.col("l_linenumber")))),
        "m_pts": "l_quantity",
        "m_revenue": _r4(F.col("l_extendedprice") * (1 - F.col("l_discount"))),
    })


def device_activity(spark, sf_dir):
    return facts.daily_activity(dv.web_events(spark, sf_dir), dv.devices(spark, sf_dir))


DEVICE_KEYS = ["user_id", "device_id", "browser_type"]


@register("fact_daily_device_activity")
def q_fact_daily_device_activity(spark, sf_dir):
    return device_activity(spark, sf_dir)


@register("fact_device_datelist")
def q_fact_device_datelist(spark, sf_dir):
    dl = facts.datelist_range(device_activity(spark, sf_dir), DEVICE_KEYS, end=dv.EVENTS_AS_OF)
    first, last = cu.first_last("device_activity_datelist")
    return dl.select(*DEVICE_KEYS, "date", F.size("device_activity_datelist").cast("long").alias("n_days"),
                     first.alias("first_active"), last.alias("last_active"))


@register("fact_device_datelist_step")
def q_fact_device_datelist_step(spark, sf_dir):
    """F7 incremental step: yesterday's snapshot (one-pass range) plus
    today's activity equals today's snapshot."""
    act = device_activity(spark, sf_dir)
    prev = facts.datelist_range(act, DEVICE_KEYS, end=dv.EVENTS_DAY_BEFORE).filter(F.col("date") == F.lit(dv.EVENTS_DAY_BEFORE).cast("date"))
    dl = facts.datelist_cumulate(prev, act, DEVICE_KEYS, dv.EVENTS_AS_OF)
    # an earlier day and the same day again: replays change nothing
    for day in (dv.EVENTS_DAY_BEFORE, dv.EVENTS_AS_OF):
        dl = facts.datelist_cumulate(dl, act, DEVICE_KEYS, day, as_of=dv.EVENTS_AS_OF)
    first, last = cu.first_last("device_activity_datelist")
    return dl.select(*DEVICE_KEYS, "date", F.size("device_activity_datelist").cast("long").alias("n_days"),
                     first.alias("first_active"), last.alias("last_active"))


@register("fact_datelist_int")
def q_fact_datelist_int(spark, sf_dir):
    snap = facts.datelist_snapshot(device_activity(spark, sf_dir), DEVICE_KEYS, as_of=dv.EVENTS_AS_OF)
    res = facts.datelist_int(snap, "device_activity_datelist", dv.EVENTS_AS_OF)
    return res.select(*DEVICE_KEYS, "date", "datelist_int", "datelist_bits")


def _host_days(df):
    first, last = cu.first_last("host_activity_datelist")
    return df.select("host", "month_start", F.size("host_activity_datelist").cast("long").alias("n_days"),
                     first.alias("first_day"), last.alias("last_day"))


@register("fact_host_datelist")
def q_fact_host_datelist(spark, sf_dir):
    return _host_days(facts.host_datelist(dv.web_events(spark, sf_dir), as_of=dv.EVENTS_AS_OF))


@register("fact_host_datelist_upsert")
def q_fact_host_datelist_upsert(spark, sf_dir):
    ev = dv.web_events(spark, sf_dir)
    prev = facts.host_datelist(ev, as_of=dv.EVENTS_DAY_BEFORE)
    step = facts.host_datelist_step(prev, ev, dv.EVENTS_AS_OF)
    return _host_days(facts.upsert(prev, step, ["host", "month_start"]))


@register("fact_activity_bitmap")
def q_fact_activity_bitmap(spark, sf_dir):
    """F8 beyond 32 days: a bitmap per user and half of the month, merged; days
    active, and the bits of the first 64 days."""
    ev = dv.table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    half = ev.withColumn("half", F.day("day") > 15)
    parts = fx.activity_bitmaps(half, ["user_id", "half"], F.col("day"), anchor="2024-01-01")
    whole = fx.merge_bitmaps(parts, ["user_id"])
    return whole.select("user_id", fx.days_active("bitmap").alias("n_days"), fx.bitmap_days_hex("bitmap", 64).alias("days_hex"))


@register("fact_day_series")
def q_fact_day_series(spark, sf_dir):
    """the days from the first to the last event, with each day's events."""
    ev = dv.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    days = facts.days_between(ev.agg(F.min("date").alias("lo"), F.max("date").alias("hi")), "lo", "hi")
    return days.join(ev, days["series_date"] == ev["date"], "left").select("series_date", F.coalesce("n", F.lit(0)).alias("n_events"))


@register("fact_daily_host_metrics")
def q_fact_daily_host_metrics(spark, sf_dir):
    return facts.daily_host_metrics(dv.web_events(spark, sf_dir))


def _arrays_text(df):
    def txt(c):
        return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return df.select("host", "month_start", F.size("hit_array").cast("long").alias("n_slots"),
                     txt("hit_array").alias("hit_array"), txt("unique_visitors_array").alias("unique_visitors_array"))


@register("fact_host_activity_reduced")
def q_fact_host_activity_reduced(spark, sf_dir):
    daily = facts.daily_host_metrics(dv.web_events(spark, sf_dir))
    return _arrays_text(facts.monthly_arrays(daily, as_of=dv.EVENTS_AS_OF))


@register("fact_host_activity_incremental")
def q_fact_host_activity_incremental(spark, sf_dir):
    daily = facts.daily_host_metrics(dv.web_events(spark, sf_dir))
    snap = facts.monthly_arrays(daily, as_of=dv.EVENTS_DAY_BEFORE)
    # the next day, then an earlier day again: ON CONFLICT (host, month_start) DO UPDATE SET the two arrays
    for day in (dv.EVENTS_AS_OF, dv.EVENTS_DAY_BEFORE):
        step = facts.monthly_arrays_step(snap, daily, day, as_of=dv.EVENTS_AS_OF)
        snap = facts.upsert(snap, step, ["host", "month_start"], set_cols=["hit_array", "unique_visitors_array"])
    return _arrays_text(snap)


@register("fact_host_activity_merge")
def q_fact_host_activity_merge(spark, sf_dir):
    """F12, F13 on a table partitioned by month: the last day merged (twice)
    into the one month it touches; all months equal the batch."""
    daily = facts.daily_host_metrics(dv.web_events(spark, sf_dir))
    path = shared_path(spark, "monthly", uuid.uuid4().hex)
    before = facts.monthly_arrays(daily, as_of=dv.EVENTS_DAY_BEFORE)
    merge.replace_partitions(before, path, "month_start")
    table = spark.read.schema(before.schema).parquet(path)
    for _ in range(2):
        step = facts.monthly_arrays_step(table, daily, dv.EVENTS_AS_OF)
        table = merge.merge_partitions(path, step, ["host", "month_start"], "month_start")
    return _arrays_text(table)


def event_text(spark, sf_dir):
    """The event log as CSV text, as a collector would deliver it, with broken
    lines: every 97th lacks its last field, every 89th has a word for a user,
    every 83rd an unreadable time."""
    ev = dv.table(spark, sf_dir, "events")
    i = F.col("event_id")
    user = F.when(i % 89 == 0, F.lit("nobody")).otherwise(F.col("user_id").cast("string"))
    at = F.when(i % 83 == 0, F.lit("yesterday")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    fields = F.when(i % 97 == 0, F.concat_ws(",", i, user)).otherwise(F.concat_ws(",", i, user, at))
    path = shared_path(spark, "text", uuid.uuid4().hex)
    ev.select(fields.alias("value")).write.text(path)
    return path


@register("source_event_times")
def q_source_event_times(spark, sf_dir):
    """Delivered text read under a declared schema; rows, malformed rows
    and rows without a readable time, and the good rows' last event per day."""
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("event_time_text", StringType())])
    checked = quarantine.read_checked_csv(spark, event_text(spark, sf_dir), schema, time_col="event_time_text", header=False)
    good, bad = quarantine.split_faults(checked, shared_path(spark, "checked", uuid.uuid4().hex))
    per_day = good.groupBy(F.to_date("event_time").alias("day")).agg(F.lit("good").alias("part"), F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))
    faults_ = bad.groupBy(F.col(quarantine.FAULT).alias("part")).agg(F.lit(None).cast("date").alias("day"), F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.split_part(F.coalesce(quarantine.RAW, F.col("event_id").cast("string")), F.lit(","), F.lit(1)).cast("long")).alias("id_sum"))
    return per_day.select("part", "day", "n_rows", "id_sum").unionByName(faults_)


# --- analytical patterns (A1-A8) ----------------------------------------------

@register("pattern_state_change")
def q_pattern_state_change(spark, sf_dir):
    snap = actor_classes(spark, sf_dir)
    return pt.state_change(snap, "actorid", "current_year", "is_active", out="player_state",
                           years_out="n_years_active", last_out="last_active_year")


@register("pattern_grouping_sets")
def q_pattern_grouping_sets(spark, sf_dir):
    gd = dv.game_details(spark, sf_dir)
    return pt.grouping_sets(gd, [["player_id", "team_id"], ["player_id", "season"], ["team_id"]],
                            [F.sum("pts").alias("total_points"), F.count(F.lit(1)).alias("n_rows")])


@register("pattern_top_player_team")
def q_pattern_top_player_team(spark, sf_dir):
    return pt.top_n(dv.game_details(spark, sf_dir), ["player_id", "team_id"], F.sum("pts"), 1,
                    out="total_points")


@register("pattern_top_player_season")
def q_pattern_top_player_season(spark, sf_dir):
    return pt.top_n(dv.game_details(spark, sf_dir), ["player_id", "season"], F.sum("pts"), 1,
                    out="total_points")


@register("pattern_team_most_wins")
def q_pattern_team_most_wins(spark, sf_dir):
    sides = pt.game_sides(dv.games(spark, sf_dir))
    return pt.top_n(sides, ["team_id"], F.sum("win").cast("long"), 1, out="total_wins")


@register("pattern_best_90_game_stretch")
def q_pattern_best_90_game_stretch(spark, sf_dir):
    sides = pt.game_sides(dv.games(spark, sf_dir))
    return pt.best_stretch(sides, 90, out="max_wins_90_game_stretch")


@register("pattern_longest_streak")
def q_pattern_longest_streak(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events")
    return pt.longest_streak(ev, "user_id", ["ts", "event_id"], F.col("value") > 10)


@register("pattern_active_periods")
def q_pattern_active_periods(spark, sf_dir):
    """The list of years in which each actor was active so far."""
    snap = actor_classes(spark, sf_dir)
    w = Window.partitionBy("actorid").orderBy("current_year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    years = F.collect_list(F.when(F.col("is_active"), F.col("current_year"))).over(w)      # one number per year at most
    return snap.select("actorid", "current_year", F.array_join(F.transform(years, lambda y: y.cast("string")), ",").alias("years_active"))


# --- sessions (T4, T7, T8, M6) --------------------------------------------------

def web_sessions(spark, sf_dir):
    """host = event type, ip = user id mod 3 (text), 5-minute gap."""
    ev = dv.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("host"), (F.col("user_id") % 3).cast("string").alias("ip"), "ts")
    return ss.sessionize(ev, "ts", ["host", "ip"], "5 minutes",
                         start="event_window_timestamp", last="last_hit")


@register("stream_session_hits")
def q_stream_session_hits(spark, sf_dir):
    return web_sessions(spark, sf_dir).select("event_window_timestamp", "host", "ip", "num_hits", "last_hit")


@register("stream_avg_session_hits")
def q_stream_avg_session_hits(spark, sf_dir):
    return ss.avg_session_hits(web_sessions(spark, sf_dir), host_like="%e")


@register("stream_compare_hosts")
def q_stream_compare_hosts(spark, sf_dir):
    return ss.compare_hosts(web_sessions(spark, sf_dir), ["click", "view", "signup"])


@register("stream_replay_sessions")
def q_stream_replay_sessions(spark, sf_dir):
    """The event log replayed through the session stream, stopped
    and restarted from its checkpoint half way.  The batch sessions."""
    ev = dv.table(spark, sf_dir, "events").select(F.col("event_type").alias("host"), (F.col("user_id") % 3).cast("string").alias("ip"), "ts")
    ses = replay(ev, "ts", lambda s: sessionize_stream(s.withWatermark("ts", "15 seconds"), "ts"), name="sessions", close="event_window_timestamp")
    return ses.select("event_window_timestamp", "host", "ip", "num_hits", F.timestamp_add("MINUTE", F.lit(-5), F.col("session_end")).alias("last_hit"))


@register("stream_replay_dedup")
def q_stream_replay_dedup(spark, sf_dir):
    """M7 on a stream: the event log in three deliveries, each repeating the one
    before, with a restart at each; every event once."""
    ev = dv.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    out = replay(ev, "ts", lambda s: dedup_stream(s, ["event_id"], ts="ts", delay="1 hour"), name="dedup", slices=3, redeliver=True)
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("engagement_time_per_user_day")
def q_engagement_time_per_user_day(spark, sf_dir):
    return ss.time_per_user_day(dv.table(spark, sf_dir, "events"), gap="30 minutes")


# --- layout and joins (S2-S10, M13) ----------------------------------------------

@register("layout_broadcast_maps")
def q_layout_broadcast_maps(spark, sf_dir):
    return jn.lookup_join(dv.matches(spark, sf_dir), dv.maps(spark, sf_dir), "mapid")


@register("layout_broadcast_medals")
def q_layout_broadcast_medals(spark, sf_dir):
    return jn.lookup_join(dv.medals_matches_players(spark, sf_dir), dv.medals(spark, sf_dir), "medal_id")


@register("layout_bucket_join")
def q_layout_bucket_join(spark, sf_dir):
    """The three tables written once, bucketed and sorted by match, and
    joined from there without an exchange."""
    t = layout.bucketed_together({"matches": dv.matches(spark, sf_dir), "details": dv.match_details(spark, sf_dir),
                                  "medals": dv.medals_matches_players(spark, sf_dir)}, "match_id")
    with jn.co_partitioned(spark):
        rows = jn.bucket_join(t["matches"], t["details"], t["medals"], merge=True)
        return jn.planned(rows.select("match_id", "player_gamertag", "medal_id", "mapid", "playlist_id", "player_total_kills"))


@register("layout_sort_sizes")
def q_layout_sort_sizes(spark, sf_dir):
    """The medal rows under three sort layouts in 16 buckets: rows,
    files, and whether the layouts hold the same rows in other bytes."""
    sizes = layout.sort_layouts(dv.medals_matches_players(spark, sf_dir), "match_id",
                                {"by_match": ["match_id"], "by_medal": ["medal_id"], "by_player_medal": ["player_gamertag", "medal_id"]}, buckets=16)
    return sizes.select("layout", "n_rows", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"))


def medal_pairs(spark, sf_dir):
    return jn.rows_with_medal(dv.matches(spark, sf_dir), dv.match_details(spark, sf_dir), dv.medals_matches_players(spark, sf_dir))


@register("layout_avg_kills_per_game")
def q_layout_avg_kills_per_game(spark, sf_dir):
    return jn.avg_per_game(medal_pairs(spark, sf_dir), "match_id", "player_gamertag", "player_total_kills",
                           out="avg_kills_per_game")


@register("layout_top_playlist")
def q_layout_top_playlist(spark, sf_dir):
    return jn.top_value(medal_pairs(spark, sf_dir), "playlist_id", distinct_of="match_id", out="n_matches")


@register("layout_top_map")
def q_layout_top_map(spark, sf_dir):
    return jn.top_value(medal_pairs(spark, sf_dir), "mapid", distinct_of="match_id", out="n_matches")


@register("layout_top_killing_spree_map")
def q_layout_top_killing_spree_map(spark, sf_dir):
    """The medal rows are filtered first, before the three-way join."""
    spree = dv.medals(spark, sf_dir).filter(F.col("classification") == "PROMO")
    won = jn.lookup_join(dv.medals_matches_players(spark, sf_dir), spree, "medal_id")
    rows = jn.bucket_join(dv.matches(spark, sf_dir), dv.match_details(spark, sf_dir), won)
    return jn.top_value(rows, "mapid", out="n_medals")


@register("join_salted_hot_key")
def q_join_salted_hot_key(spark, sf_dir):
    """lineitem x orders with a third of all lineitems moved onto order 0."""
    li = dv.table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_orderkey")).alias("o_orderkey"),
        "l_quantity")
    o = dv.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    j = jn.salted_join(li, o, ["o_orderkey"], salts=8, min_rows=1000)
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.sum("l_quantity").alias("total_qty"))


# --- experiments (E1-E7) ----------------------------------------------------------

# The days on which the three experiments start.
LAUNCHES = {"note_suggestions": "2024-01-05", "table_editor": "2024-01-10", "mobile_performance": "2024-01-15"}


def exposures(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events")
    return xp.assign(ev, "user_id", xp.EXPERIMENTS, xp.HALF_SPLIT, ts="ts", launches=LAUNCHES)


@register("exp_user_hash")
def q_exp_user_hash(spark, sf_dir):
    u = dv.table(spark, sf_dir, "events").select("user_id").distinct()
    return u.select("user_id", fx.user_hash("user_id").alias("user_hash"))


@register("exp_assignment")
def q_exp_assignment(spark, sf_dir):
    return exposures(spark, sf_dir)


@register("exp_conversion")
def q_exp_conversion(spark, sf_dir):
    return xp.conversion(exposures(spark, sf_dir), dv.table(spark, sf_dir, "events"),
                         goal=F.col("event_type") == "purchase")


@register("exp_cell_filter")
def q_exp_cell_filter(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events").select("event_id", "user_id")
    shown = xp.cell_filter(ev.withColumn("cell", xp.cell_of("user_id", "button_color_v3", xp.COLOR_CELLS)), "event_id")
    return shown.groupBy("cell").agg(F.count(F.lit(1)).alias("n_events"),
                                     F.count_distinct("user_id").alias("n_users"))


@register("exp_leading_metrics")
def q_exp_leading_metrics(spark, sf_dir):
    ev = dv.table(spark, sf_dir, "events").select("user_id", "ts", F.col("event_type").alias("metric"), "value")
    return xp.metrics_by_cell(ev, xp.EXPERIMENTS, value_cents=F.round(F.col("value") * 100), launches=LAUNCHES)


@register("exp_time_to_find")
def q_exp_time_to_find(spark, sf_dir):
    """E5: time from every view to the user's next purchase, by cell."""
    per = xp.time_to_find(dv.table(spark, sf_dir, "events"), F.col("event_type") == "view", F.col("event_type") == "purchase")
    cells = F.array(*[F.struct(F.lit(e).alias("experiment"), xp.cell_of("user_id", e).alias("cell")) for e in xp.EXPERIMENTS])
    g = per.select("*", F.explode(cells).alias("x")).groupBy("x.experiment", "x.cell").agg(
        F.sum("n_starts").alias("n_starts"), F.sum("n_found").alias("n_found"), F.sum("micros").alias("micros"))
    return g.select("experiment", "cell", "n_starts", "n_found", fx.ratio4(F.col("micros"), F.col("n_found") * 1_000_000).alias("mean_seconds"))


@register("exp_adoption")
def q_exp_adoption(spark, sf_dir):
    """Share of users with a first signup since exposure, by day."""
    return xp.adoption(exposures(spark, sf_dir), dv.table(spark, sf_dir, "events"), F.col("event_type") == "signup", last_day=dv.EVENTS_AS_OF)


@register("exp_satisfaction")
def q_exp_satisfaction(spark, sf_dir):
    """Scores (an event's value) of treatment against control users."""
    ev = dv.table(spark, sf_dir, "events").select("user_id", "value")
    cells = F.array(*[F.struct(F.lit(e).alias("experiment"), xp.cell_of("user_id", e).alias("cell")) for e in xp.EXPERIMENTS])
    return xp.rank_sum(ev.select("value", F.explode(cells).alias("x")).select("x.experiment", "x.cell", "value"), "value")


@register("exp_two_proportion")
def q_exp_two_proportion(spark, sf_dir):
    """E7 for rates: users with a purchase above 200 since exposure."""
    goal = (F.col("event_type") == "purchase") & (F.col("value") > 200)
    return xp.two_proportion(xp.conversion(exposures(spark, sf_dir), dv.table(spark, sf_dir, "events"), goal=goal))


@register("exp_retention")
def q_exp_retention(spark, sf_dir):
    return xp.retention(exposures(spark, sf_dir), dv.table(spark, sf_dir, "events"), day_from=7, day_to=13)


@register("exp_compare_cells")
def q_exp_compare_cells(spark, sf_dir):
    """E7 on per-user means since exposure: events join one row per user, and
    each experiment's sums are taken side by side."""
    ev = dv.table(spark, sf_dir, "events").select("user_id", "ts", "value")
    j = ev.join(xp.exposure_times(ev, "user_id", xp.EXPERIMENTS, "ts", LAUNCHES), "user_id")
    means = [F.avg(F.when(F.col("ts") >= F.col(f"_x{i}"), F.col("value"))).alias(f"_m{i}") for i in range(len(xp.EXPERIMENTS))]
    per = j.groupBy("user_id").agg(*means)
    rows = F.array(*[F.struct(F.lit(e).alias("experiment"), xp.cell_of("user_id", e).alias("cell"), F.col(f"_m{i}").alias("user_mean")) for i, e in enumerate(xp.EXPERIMENTS)])
    return xp.compare_cells(per.select(F.explode(rows).alias("r")).select("r.*").filter("user_mean is not null"), "user_mean")


# --- pipeline checks (M1-M5, M7-M12) -------------------------------------------------

def _cents(c):
    """Money with 2 decimals as exact integer cents."""
    return F.round(c * 100).cast("long")


# Money is summed in integer units of 1/10,000 (cents x percent), so sums are
# exact at any scale and equal in every engine; one division at the end.
MONEY_UNIT = 10_000.0


def money_sides(spark, sf_dir):
    """Revenue and expenses of every lineitem side by side, and salaries."""
    li = dv.table(spark, sf_dir, "lineitem")
    o = dv.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = dv.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = dv.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    price = _cents(F.col("l_extendedprice"))
    income = (li.select("l_orderkey", (price * _cents(1 - F.col("l_discount"))).alias("revenue"), (price * _cents(F.col("l_tax"))).alias("expenses"))
              .join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
              .select(F.col("c_nationkey").alias("unit"), F.year("o_orderdate").alias("period"), "revenue", "expenses"))
    # supplier and year first, so the join meets one row per pair
    booked = li.groupBy("l_suppkey", F.year("l_shipdate").alias("period")).agg(F.sum(F.col("l_quantity").cast("long") * 10 * 10_000).alias("amount"))
    salaries = booked.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("unit"), "period", "amount")
    return income, salaries


def profit_report(spark, sf_dir):
    return mo.profit(*money_sides(spark, sf_dir), ["unit", "period"])


@register("ops_profit")
def q_ops_profit(spark, sf_dir):
    p = profit_report(spark, sf_dir)
    return p.select("unit", "period", "missing_revenue",
                    *[(F.col(c) / MONEY_UNIT).alias(c) for c in ("revenue", "expenses", "salaries", "profit")])


def reconciliation(spark, sf_dir):
    li = dv.table(spark, sf_dir, "lineitem")
    o = dv.table(spark, sf_dir, "orders")
    computed = (li.join(o, li.l_orderkey == o.o_orderkey).groupBy(F.year("o_orderdate").alias("period"))
                .agg(F.sum(_cents(F.col("l_extendedprice"))).alias("value")))
    reported = o.groupBy(F.year("o_orderdate").alias("period")).agg(F.sum(_cents(F.col("o_totalprice"))).alias("value"))
    return mo.reconcile(computed, reported, ["period"], tolerance=0.05)


@register("ops_reconcile")
def q_ops_reconcile(spark, sf_dir):
    r = reconciliation(spark, sf_dir)
    return r.select("period", (F.col("computed") / 100.0).alias("computed"),
                    (F.col("reported") / 100.0).alias("reported"),
                    _r4(F.col("rel_diff")).alias("rel_diff"), "within_tolerance")


def account_changes(spark, sf_dir):
    snap = actor_classes(spark, sf_dir).select(
        F.col("actorid").alias("account_id"), F.col("current_year").alias("period"),
        cu.class_rank("quality_class").alias("plan_rank"), "is_active")
    return mo.account_changes(snap, "account_id", "period")


@register("ops_account_changes")
def q_ops_account_changes(spark, sf_dir):
    return account_changes(spark, sf_dir)


@register("ops_churn")
def q_ops_churn(spark, sf_dir):
    return mo.churn(account_changes(spark, sf_dir), "period")


@register("ops_missing_periods")
def q_ops_missing_periods(spark, sf_dir):
    return mo.missing_periods(dv.actor_films(spark, sf_dir), "actorid", "year")


def clicks(spark, sf_dir):
    """Click log with an arrival time: event time + (id x 7919 mod 1200) s."""
    ev = dv.table(spark, sf_dir, "events")
    delay = ((F.col("event_id") * 7919) % 1200).cast("int")
    return ev.select("event_id", "user_id", "event_type", "ts",
                     F.timestamp_add("SECOND", delay, F.col("ts")).alias("arrival_ts"))


@register("ops_dedup_events")
def q_ops_dedup_events(spark, sf_dir):
    c = clicks(spark, sf_dir)
    redelivered = c.withColumn("arrival_ts", F.timestamp_add("HOUR", F.lit(1), F.col("arrival_ts")))
    both = c.unionByName(redelivered)
    return facts.dedup(both, ["event_id"], ["arrival_ts"])


@register("ops_lateness")
def q_ops_lateness(spark, sf_dir):
    return mo.lateness(clicks(spark, sf_dir), event_ts="ts", arrival_ts="arrival_ts")


@register("ops_gap_detection")
def q_ops_gap_detection(spark, sf_dir):
    """Holes of the whole event log longer than ten minutes."""
    return mo.find_gaps(dv.table(spark, sf_dir, "events"), "ts", "10 minutes")


@register("ops_gap_detection_per_user")
def q_ops_gap_detection_per_user(spark, sf_dir):
    """Per-user holes longer than 6 hours in the whole event log (keyed M9)."""
    ev = dv.table(spark, sf_dir, "events").select("user_id", "ts")
    return mo.find_gaps(ev, "ts", "6 hours", keys=["user_id"])


@register("ops_backfill")
def q_ops_backfill(spark, sf_dir):
    """The log's own holes filled from a second collector, which saw each event
    seven minutes later under an id of its own."""
    target = dv.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    source = target.select((F.col("event_id") + 1_000_000_000).alias("event_id"), "user_id",
                           F.timestamp_add("MINUTE", F.lit(7), F.col("ts")).alias("ts"))
    return mo.backfill(target, source, mo.find_gaps(target, "ts", "10 minutes"), ts="ts", key=["event_id"])


@register("ops_exec_summary")
def q_ops_exec_summary(spark, sf_dir):
    cust = dv.table(spark, sf_dir, "customer").select(F.col("c_custkey"), F.col("c_nationkey").alias("unit"))
    prof = profit_report(spark, sf_dir).groupBy("unit").agg((F.sum("profit") / MONEY_UNIT).alias("profit"))
    growth = (account_changes(spark, sf_dir).filter(F.col("change") == "new")
              .join(cust, F.col("account_id") == F.col("c_custkey"), "left")
              .groupBy(F.coalesce("unit", F.lit(-1)).alias("unit")).agg(F.count(F.lit(1)).alias("new_accounts")))
    eng = (ss.time_per_user_day(dv.table(spark, sf_dir, "events"))
           .join(cust, F.col("user_id") == F.col("c_custkey"), "left")
           .groupBy(F.coalesce("unit", F.lit(-1)).alias("unit")).agg(F.sum("active_micros").alias("engagement_micros")))
    return mo.exec_summary([prof, growth, eng], ["unit"])


@register("ops_report_gate")
def q_ops_report_gate(spark, sf_dir):
    """The profit report, the reconciliation and the event log's newest
    time, each written once with its rules counted on the way."""
    folder = shared_path(spark, "reports", uuid.uuid4().hex)
    newest = dv.table(spark, sf_dir, "events").agg(F.max("ts").alias("newest"))
    as_of_minus_48h = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    counts = mo.publish(profit_report(spark, sf_dir), f"{folder}/profit", {"missing_revenue": F.col("missing_revenue")})
    counts |= mo.publish(reconciliation(spark, sf_dir), f"{folder}/reconciliation", {
        "zero_denominator": F.coalesce(F.col("reported") == 0, F.lit(True)), "out_of_tolerance": ~F.col("within_tolerance")})
    counts |= mo.publish(newest, f"{folder}/newest", {"stale_events": F.col("newest") < as_of_minus_48h})
    return mo.gate(spark, counts)


@register("ops_freshness")
def q_ops_freshness(spark, sf_dir):
    t = lambda n: dv.table(spark, sf_dir, n)
    return mo.freshness([("events", t("events"), "ts", 48), ("orders", t("orders"), "o_orderdate", 168),
                         ("lineitem", t("lineitem"), "l_shipdate", 720)], as_of="2024-02-01 00:00:00")
