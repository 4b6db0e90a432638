"""Reference inputs derived from the driver tables.

The reference ships no data; every registered query reads the driver's
parquet tables and derives the reference's inputs from them with Spark, so
the work grows with the tables.  The same derivations appear as SQL in
``tributary.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.text import json_long

# As-of arguments of the snapshot queries, the last year of orders
# and the last day of events in the driver tables (equal at every scale factor).
# They are the only bounds: all earlier rows count.
LAST_YEAR = 2001
EVENTS_AS_OF = "2024-01-30"
EVENTS_DAY_BEFORE = "2024-01-29"
# Divisors that scale prices into ratings and points.  They are
# not powers of ten, so derived doubles never sit exactly on a rounding tie
# (Spark and DuckDB break ties differently).
RATING_DIVISOR = 49999.0
POINTS_DIVISOR = 19997.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """actor = customer, film = order, year = order year, rating = price / 49999."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("actorid"),
        F.concat(F.lit("cust-"), F.col("o_custkey").cast("string")).alias("actor"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderkey").cast("string").alias("film"),
        (F.col("o_orderkey") % 997).cast("int").alias("votes"),
        (F.col("o_totalprice") / RATING_DIVISOR).alias("rating"),
        F.col("o_orderkey").alias("filmid"),
    )


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """player = customer, season = order year, gp = orders, pts = price sum / 19997."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("player_id"), F.year("o_orderdate").alias("season"))
            .agg(F.count("*").cast("int").alias("gp"),
                 (F.sum("o_totalprice") / POINTS_DIVISOR).alias("pts")))


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: user, device = props.k mod 25, host = event type, event time."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id",
        (json_long("props", "$.k") % 25).alias("device_id"),
        F.col("event_type").alias("host"),
        F.col("ts").alias("event_time"),
        "value",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """devices dimension: device id = nation key, browser = nation name."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("device_id"),
                    F.col("n_name").alias("browser_type"))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """game = order; home = custkey mod 30, visitor = (custkey + 7) mod 30,
    home win = status F."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        (F.col("o_custkey") % 30).alias("home_team_id"),
        ((F.col("o_custkey") + 7) % 30).alias("visitor_team_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("home_team_wins"),
    )


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """player = part, team = supplier, season = ship year, pts = quantity."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("player_id"),
        F.col("l_suppkey").alias("team_id"),
        F.year("l_shipdate").alias("season"),
        F.col("l_quantity").alias("pts"),
    )


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("match_id"),
                    (F.col("o_custkey") % 25).cast("int").alias("mapid"),
                    F.col("o_orderpriority").alias("playlist_id"))


def maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("mapid"), F.col("n_name").alias("map_name"))


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_gamertag"))
            .agg(F.sum("l_quantity").cast("long").alias("player_total_kills")))


def medals_matches_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("player_gamertag"),
                     F.col("l_partkey").alias("medal_id"))


def medals(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("medal_id"), F.col("p_type").alias("classification"))
