"""Join strategies.

* :func:`lookup_join` leaves the broadcast to Spark's byte statistics
  (``spark.sql.autoBroadcastJoinThreshold`` at planning, AQE at run time).
* :func:`salted_join` spreads sketched hot keys of the big side over
  ``salts`` sub-keys and replicates only those keys of the small side.
* :func:`co_partitioned` relaxes the all-keys co-partitioning rule so a
  bucketed three-way join (bucket key + one more key) needs no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "inner") -> DataFrame:
    """Fact x dimension join (S2, S3).  Catalyst broadcasts the dimension when
    its bytes are below ``spark.sql.autoBroadcastJoinThreshold``, AQE when its
    measured shuffle size is; otherwise it is a shuffled join.  No job runs
    while the plan is built."""
    return fact.join(dim, on=on, how=how)


#: Heavy keys that a sketch names at most, and keys that it tracks.
TOP_KEYS, TRACKED = 1024, 16_384


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int, *, top: int = TOP_KEYS, tracked: int = TRACKED) -> DataFrame:
    """Hashes of keys with at least about ``min_rows`` rows, heaviest first, as
    ``_hot``: a mergeable frequent-items sketch of fixed size, so no key but the
    sketches' own is shuffled, whatever the number of keys.  At most ``top``
    rows.  Counts are off by at most rows / (0.75 ``tracked``): a key with fewer
    rows than that may be missed or added, which costs balance, not rows."""
    sketch = df.select(F.xxhash64(*keys).alias("_k")).agg(F.expr(f"approx_top_k(_k, {top}, {tracked})").alias("_top"))
    return sketch.select(F.explode("_top").alias("_t")).filter(F.col("_t.count") >= min_rows).select(F.col("_t.item").alias("_hot"))


def salted_join(big: DataFrame, small: DataFrame, on: Sequence[str], *, how: str = "inner",
                salts: int = 16, min_rows: int = 100_000) -> DataFrame:
    """Skew-safe equi-join (M13).  Heavy keys of ``big`` (:func:`hot_keys`, NULL
    among them) get a deterministic salt in ``[0, salts)`` from a hash of the
    row, and their ``small`` rows are replicated once per salt; every other
    key joins with salt 0.  The result equals the plain join whatever keys are
    named heavy; row content decides the salt, so a recomputed task after an
    executor loss salts identically.  The list of heavy keys (``TOP_KEYS`` hashes
    at most) is broadcast.  ``how`` must keep ``big`` on the left (inner or left)."""
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins")
    on = list(on)
    hot = F.broadcast(hot_keys(big, on, min_rows))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])

    def marked(df: DataFrame) -> DataFrame:
        return df.join(hot, F.xxhash64(*on) == F.col("_hot"), "left")

    heavy = F.col("_hot").isNotNull()
    b = marked(big).withColumn("_salt", F.when(heavy, F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0))).drop("_hot")
    s = (marked(small).withColumn("_salt", F.explode(F.when(heavy, F.sequence(F.lit(0), F.lit(salts - 1)))
                                                     .otherwise(F.array(F.lit(0)))))
         .drop("_hot"))
    return b.join(s, on=[*on, "_salt"], how=how).drop("_salt")


@contextmanager
def co_partitioned(spark: SparkSession):
    """Let a join on (bucket key, other key) reuse bucketing on the bucket key
    alone (S6): no exchange for the three-way bucketed join."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


# --- bucket-join analytics (S6-S10) ---------------------------------------------

def bucket_join(matches: DataFrame, details: DataFrame, medals: DataFrame, *, key: str = "match_id",
                second: str = "player_gamertag", merge: bool = False) -> DataFrame:
    """matches x details on the bucket key, x medal rows on (bucket key,
    player) (S6).  On tables bucketed by ``key`` and read inside
    :func:`co_partitioned`, the plan has no exchange.

    Without a shuffle there is nothing for AQE to split, so a key holding a
    large share of the rows stays in one bucket task.  For such keys use
    :func:`salted_join`, or read the tables with
    ``spark.sql.sources.bucketing.enabled=false`` so the join shuffles and
    AQE's skew-join handling applies.  ``merge`` asks for sort-merge joins
    where a small table would be broadcast instead of read by bucket."""
    if merge:
        return matches.hint("merge").join(details, key).hint("merge").join(medals, [key, second])
    return matches.join(details, key).join(medals, [key, second])


def planned(df: DataFrame) -> DataFrame:
    """``df`` with its physical plan fixed now, under the settings that hold now
    (a plan without exchanges is not adapted when it runs)."""
    df._jdf.queryExecution().executedPlan()
    return df


def rows_with_medal(matches: DataFrame, details: DataFrame, medals: DataFrame, *, key: str = "match_id",
                    second: str = "player_gamertag") -> DataFrame:
    """One row per (match, player) with a medal (S7-S9): the medal rows only
    decide which pairs count, so they join as a semi join and multiply nothing."""
    return matches.join(details.join(medals.select(key, second), [key, second], "left_semi"), key)


def avg_per_game(df: DataFrame, game: str, player: str, measure: str, *, out: str = "avg_per_game") -> DataFrame:
    """Average of a per-game measure over each player's games (S7, X11):
    one value per (game, player) first, so joined medal rows do not weigh
    in; exact half-up to 4 places for integer measures."""
    from tributary.functions.nulls import ratio4
    per_game = df.select(game, player, measure).distinct()
    g = per_game.groupBy(player).agg(F.count(F.lit(1)).alias("n_games"), F.sum(measure).alias("_tot"))
    return g.select(player, "n_games", ratio4("_tot", "n_games").alias(out))


def top_value(df: DataFrame, col: str, *, distinct_of: str | None = None, n: int = 1,
              out: str = "n") -> DataFrame:
    """Most frequent value of ``col`` (S8-S10, X12): counts distinct
    ``distinct_of`` (e.g. matches) when given, else joined rows; ties broken
    by the value.  A bounded top-k over a partial aggregate."""
    cnt = F.count_distinct(distinct_of) if distinct_of else F.count(F.lit(1))
    g = df.groupBy(col).agg(cnt.alias(out))
    return g.orderBy(F.col(out).desc(), F.col(col).asc()).limit(n)
