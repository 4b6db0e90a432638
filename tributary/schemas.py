"""Table definitions and data checks.

Spark has no primary keys or enums: :func:`assert_unique` and
:func:`count_not_allowed` check them as distributed aggregations, and
:func:`validate` compares a DataFrame's columns with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, FloatType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


FILM = _s(("film", StringType()), ("votes", IntegerType()), ("rating", FloatType()), ("filmid", StringType()))
ACTORS = _s(("actor", StringType()), ("actorid", StringType()), ("current_year", IntegerType()),
            ("films", ArrayType(FILM)), ("quality_class", StringType()), ("is_active", BooleanType()))
ACTORS_KEY = ["actorid", "current_year"]
ACTORS_HISTORY_SCD = _s(("actorid", StringType()), ("is_active", BooleanType()), ("quality_class", StringType()),
                        ("current_year", IntegerType()), ("start_date", IntegerType()), ("end_date", IntegerType()))
SEASON_STATS = _s(("season", IntegerType()), ("gp", IntegerType()), ("pts", FloatType()), ("reb", FloatType()),
                  ("ast", FloatType()))
PLAYERS = _s(*[(c, StringType()) for c in ("player_name", "height", "college", "country", "draft_year",
                                          "draft_round", "draft_number")],
             ("season_stats", ArrayType(SEASON_STATS)), ("scoring_class", StringType()),
             ("years_since_last_season", IntegerType()), ("current_season", IntegerType()))
PLAYERS_KEY = ["player_name", "current_season"]
USER_DEVICES_CUMULATED = _s(("user_id", LongType()), ("device_id", LongType()), ("browser_type", StringType()),
                            ("date", DateType()), ("device_activity_datelist", ArrayType(DateType())))
USER_DEVICES_KEY = ["user_id", "device_id", "browser_type", "date"]   # X6: the date is part of the key
HOSTS_CUMULATED = _s(("host", StringType()), ("month_start", DateType()),
                     ("host_activity_datelist", ArrayType(DateType())))
HOST_ACTIVITY_REDUCED = _s(("host", StringType()), ("month_start", DateType()),
                           ("hit_array", ArrayType(LongType())), ("unique_visitors", ArrayType(LongType())))
MONTH_KEY = ["host", "month_start"]
PROCESSED_EVENTS_IP_AGGREGATED = _s(("event_window_timestamp", TimestampType()), ("host", StringType()),
                                    ("ip", StringType()), ("num_hits", LongType()))
EXPOSURES = _s(("experiment", StringType()), ("user_id", LongType()), ("cell", StringType()),
               ("ts", TimestampType()))
EXPERIMENT_FACTS = _s(("user_id", LongType()), ("metric", StringType()), ("value", DoubleType()),
                      ("ts", TimestampType()))

# Allowed enum labels in declaration order.
QUALITY_CLASS = ["star", "good", "average", "bad"]
SCORING_CLASS = ["star", "good", "average", "bad"]


def validate(df: DataFrame, schema: StructType, *, strict_types: bool = False) -> list[str]:
    """Problems between ``df``'s columns and ``schema`` (metadata only)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing column {f.name}" for f in schema.fields if f.name not in have]
    if strict_types:
        problems += [f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}"
                     for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    return problems


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (a partial aggregate over the keys)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Primary-key check: raises if any key repeats.  Only one offending key
    is brought to the driver."""
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key {dict(bad[0].asDict())} for {list(keys)}")


def count_not_allowed(df: DataFrame, col: str, allowed: Sequence[str]) -> int:
    """Rows whose non-NULL ``col`` is outside the enum (one aggregate)."""
    c = F.col(col)
    return df.agg(F.count(F.when(c.isNotNull() & ~c.isin(list(allowed)), 1))).first()[0]
