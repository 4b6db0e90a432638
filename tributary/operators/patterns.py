"""Analytical patterns.

State-change labels, grouping sets, top-n reports, rolling windows over the
last N rows, and longest streaks.

The per-key sequence operators (:func:`best_stretch`, :func:`longest_streak`,
:func:`rolling_rows`) run over a key's whole history, which at scale can be a
large share of the table (30 teams share every game).  They therefore never put
one key's history into one window partition: rows are windowed per (segment,
key), with segments balanced by row count (:mod:`tributary.operators.scan`), and
only small per-segment summaries are combined per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.operators.scan import ordered_segments

# State labels.
NEW = "New"
CONTINUED = "Continued Playing"
RETIRED = "Retired"
STAYED_RETIRED = "Stayed Retired"
RETURNED = "Returned from Retirement"


# --- A1 ---------------------------------------------------------------------------

def state_change(df: DataFrame, key: str | Sequence[str], period: str, active: str, *,
                 out: str = "state", years_out: str = "n_years_active",
                 last_out: str = "last_active_period") -> DataFrame:
    """Five-way activity labels per key and period (A1, X15): New, Continued,
    Retired, Stayed Retired, Returned.  ``LAG`` of the flag plus "ever active
    before" replace the reference's correlated MAX/MIN subqueries (A2); the
    input is entity x period grain, so window partitions hold one row per
    period."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(period)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.lag(active).over(w)
    ever = F.coalesce(F.max(F.col(active).cast("int")).over(before), F.lit(0)) == 1
    a = F.col(active)
    label = (F.when(a & ~ever, F.lit(NEW))
             .when(a & prev, F.lit(CONTINUED))
             .when(a, F.lit(RETURNED))
             .when(prev.eqNullSafe(F.lit(True)), F.lit(RETIRED))
             .otherwise(F.lit(STAYED_RETIRED)))
    active_period = F.when(a, F.col(period))
    return df.select(*keys, period, a.alias(active), label.alias(out),
                     F.count(active_period).over(upto).alias(years_out),
                     F.max(active_period).over(upto).alias(last_out))


# --- A3-A6 ------------------------------------------------------------------------

def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], aggs: Sequence[Column],
                  gid: str = "gid") -> DataFrame:
    """Real GROUPING SETS with ``grouping_id`` (A3, X16): one scan, one
    shuffle, partial aggregation per set."""
    cols: list[str] = []
    for s in sets:
        for c in s:
            if c not in cols:
                cols.append(c)
    gsets = [[F.col(c) for c in s] for s in sets]
    return df.groupingSets(gsets, *[F.col(c) for c in cols]).agg(*aggs, F.grouping_id().alias(gid))


def top_n(df: DataFrame, group: Sequence[str], value: Column, n: int = 1, *,
          out: str = "total") -> DataFrame:
    """Top ``n`` groups by an aggregate, ties broken by the group columns
    (A4-A6).  The aggregate is partial; the ordering is a bounded top-k
    (TakeOrderedAndProject), never a global sort."""
    agg = df.groupBy(*group).agg(value.alias(out))
    return agg.orderBy(F.col(out).desc_nulls_last(), *[F.col(g).asc() for g in group]).limit(n)


def game_sides(games: DataFrame, *, game: str = "game_id", date: str = "game_date_est",
               home: str = "home_team_id", visitor: str = "visitor_team_id",
               home_win: str = "home_team_wins", extra: Sequence[str] = ()) -> DataFrame:
    """One row per team per game (A7a): the home side wins ``home_win``, the
    visitor ``1 - home_win``.  One scan with ``inline`` of two structs rather
    than a UNION ALL that reads the table twice."""
    w = F.col(home_win).cast("int")
    sides = F.array(
        F.struct(F.col(home).alias("team_id"), w.alias("win"), F.lit(True).alias("is_home")),
        F.struct(F.col(visitor).alias("team_id"), (F.lit(1) - w).alias("win"), F.lit(False).alias("is_home")),
    )
    return games.select(game, date, *extra, F.inline(sides))


# --- A7: rolling window over the last N rows ------------------------------------

def rolling_rows(df: DataFrame, key: str, order: Sequence[str], value: str, n: int, *,
                 bucket: Column, out: str = "rolling") -> DataFrame:
    """``sum(value) OVER (PARTITION BY key ORDER BY order ROWS n-1 PRECEDING)``
    without a per-key window partition (A7, X18: ``order`` must be total).

    Rows are windowed per (key, bucket) where ``bucket`` is an order-monotone
    expression (e.g. the date), as fine as the rows allow.  Each bucket also
    receives a *halo*: the last ``n - 1`` rows of the key before the bucket,
    copied only from bucket tails.  Which later buckets a tail row reaches
    follows from per-bucket row counts, a partial aggregate over a narrow
    second scan (a small key x bucket table).

    Shuffles: the rows are hash-partitioned once by (key, bucket); the halo is
    partitioned the same way, so the union keeps that partitioning and the
    final window needs no exchange.  Both use the session's
    ``spark.sql.shuffle.partitions`` explicitly (equal counts are what keeps
    the union co-partitioned; AQE does not coalesce such repartitions), so
    size it for the data, e.g. with ``session.scale_conf``.  Output: every input row
    with its sum."""
    order = list(order)
    nparts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(key, *order, value, bucket.alias("_b"))
    base = rows.repartition(nparts, key, "_b")
    # rank of each row from the end of its bucket (1 = last row).
    wb_desc = Window.partitionBy(key, "_b").orderBy(*[F.col(c).desc() for c in order])
    tails = base.withColumn("_rfe", F.row_number().over(wb_desc)).filter(F.col("_rfe") <= n - 1)
    # per-bucket counts; rows strictly before each bucket's start, per key.
    keyed = df.select(key, bucket.alias("_b"))
    counts = keyed.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(key).orderBy("_b")
    counts = counts.withColumn("_before", F.coalesce(
        F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # for each source bucket: the following buckets (at most n - 1 of them),
    # each with the number of rows between the source bucket's end and it.
    nxt = F.collect_list(F.struct(F.col("_b").alias("tb"), F.col("_before").alias("tbefore"))) \
        .over(wk.rowsBetween(1, max(n - 1, 1)))
    targets = (counts.select(key, F.col("_b").alias("_sb"), (F.col("_before") + F.col("_cnt")).alias("_end"),
                             nxt.alias("_t"))
               .select(F.col(key).alias("_tk"), "_sb", "_end", F.explode("_t").alias("t"))
               .select("_tk", "_sb", F.col("t.tb").alias("_tb"), (F.col("t.tbefore") - F.col("_end")).alias("_gap")))
    # null-safe keys: no not-null filter is inferred below the repartition, so
    # ``tails`` reuses the exchange of ``base`` instead of shuffling again.
    halo = (tails.join(targets, F.col(key).eqNullSafe(F.col("_tk")) & F.col("_b").eqNullSafe(F.col("_sb")))
            .filter(F.col("_rfe") - 1 + F.col("_gap") < n - 1)
            .select(key, *order, value, F.col("_tb").alias("_b"), F.lit(True).alias("_halo"))
            .repartition(nparts, key, "_b"))
    own = base.withColumn("_halo", F.lit(False))
    allrows = own.unionByName(halo)
    wr = Window.partitionBy(key, "_b").orderBy(*order).rowsBetween(-(n - 1), Window.currentRow)
    return (allrows.withColumn(out, F.sum(value).over(wr))
            .filter(~F.col("_halo")).drop("_halo", "_b"))


def best_stretch(sides: DataFrame, n: int = 90, *, key: str = "team_id",
                 order: Sequence[str] = ("game_date_est", "game_id"), value: str = "win",
                 out: str = "max_wins_stretch") -> DataFrame:
    """Most wins in any ``n``-game stretch per team (A7, X18: ``order`` is
    total), ``max(sum(value) OVER (... ROWS n - 1 PRECEDING))`` as a two-phase
    scan.

    Phase 1, per (segment, key): the best sum of ``n`` rows inside the segment,
    its row count, and its first and last ``n - 1`` rows (at most ``2 n - 2``
    structs).  Phase 2, per key over these: the edge rows at their places in the
    whole history; a window is taken where its rows are consecutive there, which
    covers every stretch across segments and the short ones at the start."""
    order = list(order)
    base = ordered_segments(sides.select(key, *order, F.col(value).alias("_v")), [key], order, unique=True)
    w = Window.partitionBy("_seg", key).orderBy(*order)
    back = Window.partitionBy("_seg", key).orderBy(*[F.col(c).desc() for c in order])
    rows = (base.withColumn("_rn", F.row_number().over(w))
            .withColumn("_sum", F.sum("_v").over(w.rowsBetween(-(n - 1), Window.currentRow)))
            .withColumn("_rfe", F.row_number().over(back)))
    at_edge = (F.col("_rn") < n) | (F.col("_rfe") < n)
    per = rows.groupBy("_seg", key).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("_rn") >= n, F.col("_sum"))).alias("_best"),
        F.collect_list(F.when(at_edge, F.struct("_rn", "_v"))).alias("_edge"))
    wk = Window.partitionBy(key).orderBy("_seg")
    per = per.withColumn("_before", F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    edge = per.select(key, "_best", "_before", F.explode_outer("_edge").alias("_r"))
    edge = edge.select(key, "_best", (F.col("_before") + F.col("_r._rn")).alias("_at"), F.col("_r._v").alias("_v"))
    last_n = Window.partitionBy(key).orderBy("_at").rowsBetween(-(n - 1), Window.currentRow)
    edge = (edge.withColumn("_low", F.min("_at").over(last_n)).withColumn("_size", F.count("_at").over(last_n))
            .withColumn("_sum", F.sum("_v").over(last_n)))
    whole = (F.col("_at") - F.col("_low") + 1 == F.col("_size")) & ((F.col("_size") == n) | (F.col("_low") == 1))
    return edge.groupBy(key).agg(F.max(F.greatest("_best", F.when(whole, F.col("_sum")))).alias(out))


# --- A8: longest streak -------------------------------------------------------------

def longest_streak(df: DataFrame, key: str, order: Sequence[str], cond: Column, *,
                   bucket: Column | None = None, out: str = "longest_streak") -> DataFrame:
    """Longest run of consecutive rows (per key, in ``order``, which is total)
    meeting ``cond`` (A8, X19: rows are numbered before filtering; a NULL
    condition is not met).

    Buckets are ordered segments balanced by row count, unless an
    order-monotone ``bucket`` is given.  Phase 1, per (key, bucket), in one
    windowed pass: row number and running
    count of qualifying rows give each run a constant ``rn - count`` id; two
    grouped aggregations on the same partitioning summarise every bucket
    (row count, leading run, trailing run, longest inner run), including
    buckets with no qualifying row, which break streaks.  Phase 2, per key
    over bucket summaries only: the run carried into each bucket from the
    previous ones.  One shuffle of the rows; keys with no qualifying row give 0."""
    order = list(order)
    base = df.select(key, *order, F.coalesce(cond, F.lit(False)).alias("_c"), *([] if bucket is None else [bucket.alias("_b")]))
    if bucket is None:
        base = ordered_segments(base, [key], order, segment="_b", unique=True)
    wb = Window.partitionBy(key, "_b").orderBy(*order)
    base = (base.withColumn("_rn", F.row_number().over(wb))
            .withColumn("_ct", F.sum(F.col("_c").cast("int")).over(wb.rowsBetween(Window.unboundedPreceding, 0))))
    grp = F.when(F.col("_c"), F.col("_rn") - F.col("_ct"))
    runs = (base.groupBy(key, "_b", grp.alias("_grp"))
            .agg(F.min("_rn").alias("_s"), F.max("_rn").alias("_e"), F.count(F.lit(1)).alias("_len")))
    is_run = F.col("_grp").isNotNull()
    per_b = runs.groupBy(key, "_b").agg(
        F.max("_e").alias("_n"),
        F.coalesce(F.max(F.when(is_run, F.col("_len"))), F.lit(0)).alias("_best"),
        F.coalesce(F.max(F.when(is_run & (F.col("_s") == 1), F.col("_len"))), F.lit(0)).alias("_prefix"),
        F.max(F.when(is_run, F.struct("_e", "_len"))).alias("_lastrun"))
    summ = per_b.select(key, "_b", "_n", "_best", "_prefix",
                        F.when(F.col("_lastrun._e") == F.col("_n"), F.col("_lastrun._len")).otherwise(F.lit(0))
                        .alias("_suffix"))
    full = F.col("_prefix") == F.col("_n")
    wk = Window.partitionBy(key).orderBy("_b")
    # segment = number of non-full buckets so far; the run carried into a
    # bucket is the running sum, within the previous bucket's segment, of
    # (trailing run of the non-full bucket that opened it, then whole sizes
    # of the full buckets after it).
    summ = (summ.withColumn("_seg", F.sum((~full).cast("int")).over(wk.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("_contrib", F.when(full, F.col("_n")).otherwise(F.col("_suffix"))))
    summ = summ.withColumn("_S", F.sum("_contrib").over(
        Window.partitionBy(key, "_seg").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
    summ = summ.withColumn("_carry", F.coalesce(F.lag("_S").over(wk), F.lit(0)))
    cand = F.greatest(F.col("_best"), F.col("_carry") + F.col("_prefix"))
    return summ.groupBy(key).agg(F.max(cand).cast("long").alias(out))
