"""Pipeline checks from the maintenance runbook (SURVEY §2.7: M1-M5,
M7-M12; M6 lives in ``sessions``, M13 in ``joins``).

Every check is a distributed aggregation that returns a small DataFrame; as-of
times are arguments, never ``now()``, so reruns are reproducible.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions.nulls import ratio4
from tributary.operators.sessions import interval_micros, to_micros, from_micros


# --- M1, M2, M10: profit, reconciliation, executive summary --------------------

def profit(income: DataFrame, salaries: DataFrame, keys: Sequence[str], *, revenue: str = "revenue", expenses: str = "expenses",
           amount: str = "amount") -> DataFrame:
    """Profit = revenue - expenses - salaries per key (M1).  ``income`` holds
    revenue and expense amounts side by side, so both come from one pass and one
    partial aggregation; salaries are booked under keys of their own and meet
    them in one full outer join of the small results.  A side missing for a key
    counts as 0.  Pass amounts in integer minor units for exact sums."""
    keys = list(keys)
    both = income.groupBy(*keys).agg(F.sum(revenue).alias("revenue"), F.sum(expenses).alias("expenses"))
    j = both.join(salaries.groupBy(*keys).agg(F.sum(amount).alias("salaries")), keys, "full_outer")
    r, e, s = (F.coalesce(F.col(c), F.lit(0)) for c in ("revenue", "expenses", "salaries"))
    return j.select(*keys, F.col("revenue").isNull().alias("missing_revenue"),
                    r.alias("revenue"), e.alias("expenses"), s.alias("salaries"), (r - e - s).alias("profit"))


def reconcile(computed: DataFrame, reported: DataFrame, keys: Sequence[str], *, value: str = "value",
              tolerance: float = 0.05) -> DataFrame:
    """Computed vs filed numbers (M2): relative difference over the reported
    value; rows beyond ``tolerance`` or present on one side only fail."""
    keys = list(keys)
    c = computed.select(*keys, F.col(value).alias("computed"))
    r = reported.select(*keys, F.col(value).alias("reported"))
    j = c.join(r, keys, "full_outer")
    rel = F.try_divide(F.col("computed") - F.col("reported"), F.col("reported"))
    ok = F.coalesce(F.abs(rel) <= F.lit(tolerance), F.lit(False))
    return j.select(*keys, "computed", "reported", rel.alias("rel_diff"), ok.alias("within_tolerance"))


def exec_summary(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Executive aggregate (M10): already-aggregated parts joined by key with
    full outer joins; missing measures become 0."""
    keys = list(keys)
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "full_outer")
    measures = [c for c in out.columns if c not in keys]
    return out.select(*keys, *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])


# --- M3, M4, M5: growth, churn, skipped periods -----------------------------------

# Account change labels.
CHANGE_LABELS = ["new", "upgrade", "downgrade", "renew", "cancel", "reactivate", "churned"]


def account_changes(accounts: DataFrame, key: str, period: str, *, plan_rank: str = "plan_rank",
                    active: str = "is_active", out: str = "change") -> DataFrame:
    """Per account and period (M3): new, upgrade (lower rank number = better
    plan), downgrade, renew, cancel, reactivate, churned.  Entity x period
    grain, so window partitions hold one row per period."""
    w = Window.partitionBy(key).orderBy(period)
    pa, pr = F.lag(active).over(w), F.lag(plan_rank).over(w)
    a, r = F.col(active), F.col(plan_rank)
    label = (F.when(pa.isNull(), F.when(a, F.lit("new")).otherwise(F.lit("churned")))
             .when(pa & ~a, F.lit("cancel"))
             .when(~pa & ~a, F.lit("churned"))
             .when(~pa & a, F.lit("reactivate"))
             .when(r < pr, F.lit("upgrade"))
             .when(r > pr, F.lit("downgrade"))
             .otherwise(F.lit("renew")))
    return accounts.select(key, period, plan_rank, active, label.alias(out))


def churn(changes: DataFrame, period: str, *, change: str = "change", active: str = "is_active") -> DataFrame:
    """Churn and renewal rates per period (M4): cancels and renewals over the
    accounts active in the previous period."""
    per = changes.groupBy(period).agg(
        F.sum(F.col(active).cast("int")).cast("long").alias("n_active"),
        F.count(F.when(F.col(change) == "cancel", 1)).alias("n_cancel"),
        F.count(F.when(F.col(change).isin("renew", "upgrade", "downgrade"), 1)).alias("n_renew"),
        F.count(F.when(F.col(change) == "new", 1)).alias("n_new"))
    prev = per.select((F.col(period) + 1).alias(period), F.col("n_active").alias("n_active_prev"))
    j = per.join(prev, period, "left")
    return j.select(period, "n_active", "n_new", "n_cancel", "n_renew",
                    F.coalesce("n_active_prev", F.lit(0)).cast("long").alias("n_active_prev"),
                    ratio4("n_cancel", "n_active_prev").alias("churn_rate"),
                    ratio4("n_renew", "n_active_prev").alias("renewal_rate"))


def missing_periods(df: DataFrame, key: str, period: str) -> DataFrame:
    """Skipped steps (M5): per key, runs of integer periods absent between
    the first and last present period.  Distinct periods first, so windows
    hold one row per present period."""
    p = df.select(key, period).distinct()
    w = Window.partitionBy(key).orderBy(period)
    nxt = F.lead(period).over(w)
    return (p.select(key, (F.col(period) + 1).alias("missing_from"), (nxt - 1).alias("missing_to"))
            .filter(F.col("missing_to") >= F.col("missing_from"))
            .withColumn("n_missing", (F.col("missing_to") - F.col("missing_from") + 1).cast("long")))


# --- M7, M8, M9: dedup, lateness, gaps and backfill ---------------------------------

def lateness(df: DataFrame, *, event_ts: str, arrival_ts: str,
             bounds_s: Sequence[int] = (60, 300, 900)) -> DataFrame:
    """Arrival minus event time (M8), counted per lateness band with the
    band's mean and max in whole seconds.  Arrivals before their event time
    (clock skew) have a band of their own, ``early``."""
    late = (to_micros(arrival_ts) - to_micros(event_ts)) / F.lit(1_000_000)
    late = F.floor(late).cast("long")
    band = F.when(late < 0, F.lit("early"))
    lo = 0
    for b in bounds_s:
        band = band.when(late < b, F.lit(f"{lo}-{b}s"))
        lo = b
    band = band.otherwise(F.lit(f">={lo}s"))
    g = df.select(late.alias("_late"), band.alias("band")).groupBy("band").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("_late").cast("long").alias("_sum"),
        F.max("_late").alias("max_lateness_s"))
    return g.select("band", "n_events", ratio4("_sum", "n_events").alias("avg_lateness_s"), "max_lateness_s")


def find_gaps(df: DataFrame, ts: str, min_gap: str, *, keys: Sequence[str] = (),
              fanout: int = 1024) -> DataFrame:
    """Holes longer than ``min_gap`` between consecutive events (M9), per
    ``keys`` or over the whole stream.

    Buckets of width ``min_gap`` are reduced to (min, max) by a partial
    aggregate; a hole longer than a bucket cannot lie inside one bucket, so
    the holes are exactly the spans between consecutive non-empty buckets
    that exceed ``min_gap``.  Those spans are found in two levels: between
    buckets inside a super-bucket of ``fanout`` buckets (one window per
    super-bucket), and between the last bucket of one super-bucket and the
    first of the next non-empty one (a window over super-bucket ends only).
    No window ever holds the events, and the top level holds
    time span / (min_gap x fanout) rows."""
    keys = list(keys)
    g_us = interval_micros(min_gap)
    b = (df.select(*keys, to_micros(ts).alias("_us")).filter(F.col("_us").isNotNull())
         .groupBy(*keys, F.floor(F.col("_us") / F.lit(g_us)).alias("_b"))
         .agg(F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
         .withColumn("_sb", F.floor(F.col("_b") / F.lit(fanout))))
    w_in = Window.partitionBy(*keys, "_sb").orderBy("_b")
    inside = b.select(*keys, F.col("_hi").alias("_s"), F.lead("_lo").over(w_in).alias("_e"))
    ends = b.groupBy(*keys, "_sb").agg(F.min("_lo").alias("_first"), F.max("_hi").alias("_last"))
    w_out = Window.partitionBy(*keys).orderBy("_sb") if keys else Window.orderBy("_sb")
    across = ends.select(*keys, F.col("_last").alias("_s"), F.lead("_first").over(w_out).alias("_e"))
    spans = inside.unionByName(across)
    return (spans.filter(F.col("_e") - F.col("_s") > g_us)
            .select(*keys, from_micros(F.col("_s")).alias("gap_start"), from_micros(F.col("_e")).alias("gap_end"),
                    ((F.col("_e") - F.col("_s")) / F.lit(60_000_000)).cast("long").alias("gap_minutes")))


def backfill(target: DataFrame, source: DataFrame, gaps: DataFrame, *, ts: str, key: Sequence[str],
             bucket: str = "1 hour") -> DataFrame:
    """Fill detected holes from a replay source (M9): source rows strictly
    inside a gap and absent from the target (left anti on ``key``), appended
    to the target.

    Each gap is expanded to the coarse time buckets it covers, and source rows
    are matched on their bucket (a hash equi-join) before the range check, so
    a row is compared only with the gaps of its own bucket, never with the
    whole gap list.  Whether the gap table is broadcast is left to Spark's own
    size statistics."""
    key = list(key)
    b_us = interval_micros(bucket)
    gb = (gaps.select("gap_start", "gap_end")
          .withColumn("_gb", F.explode(F.sequence(F.floor(to_micros("gap_start") / b_us),
                                                  F.floor(to_micros("gap_end") / b_us)))))
    sb = source.withColumn("_gb", F.floor(to_micros(ts) / b_us))
    inside_gap = (sb["_gb"] == gb["_gb"]) & (F.col(ts) > F.col("gap_start")) & (F.col(ts) < F.col("gap_end"))
    inside = sb.join(gb, inside_gap, "left_semi").drop("_gb")
    missing = inside.join(target.select(*key), key, "left_anti")
    return target.unionByName(missing.select(*target.columns))


# --- M11, M12: report gate and freshness ---------------------------------------

def validate_report(checks: Sequence[tuple[str, DataFrame, Column]]) -> DataFrame:
    """Report gate (M11): each rule is (name, frame, bad-row predicate).  Rules
    on one frame are counted in one pass over it; one row per rule."""
    frames: dict[int, tuple[DataFrame, list[tuple[str, Column]]]] = {}
    for name, df, bad in checks:
        frames.setdefault(id(df), (df, []))[1].append((name, bad))
    out = None
    for df, rules in frames.values():
        counts = df.agg(*[F.count(F.when(bad, 1)).alias(f"_r{i}") for i, (_, bad) in enumerate(rules)])
        r = counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("n_bad")) for i, (name, _) in enumerate(rules)])).alias("r"))
        r = r.select("r.rule", "r.n_bad", (F.col("r.n_bad") == 0).alias("passed"))
        out = r if out is None else out.unionByName(r)
    return out


def publish(report: DataFrame, path: str, rules: Mapping[str, Column]) -> dict[str, int]:
    """Write a report and count its bad rows on what was written (M11): the
    report is planned, scanned and computed once, and all rules are one pass over
    its (small) result.  Bad rows by rule; the caller releases the path if all
    are 0 (:func:`gate`).

    Not by ``Observation``: a session that has used one can no longer run Spark
    ML models, as their tasks carry the session and its observations do not
    serialise."""
    report.write.mode("overwrite").parquet(path)
    written = report.sparkSession.read.schema(report.schema).parquet(path)
    return written.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules.items()]).first().asDict()


def gate(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """One row per rule from the counts of :func:`publish`."""
    return spark.createDataFrame([(name, int(n), n == 0) for name, n in counts.items()], "rule string, n_bad bigint, passed boolean")


def freshness(tables: Sequence[tuple[str, DataFrame, str, int]], as_of: str) -> DataFrame:
    """Freshness SLA (M12): per (name, frame, time column, SLA hours), the
    newest value, its age in seconds at ``as_of``, and whether it is within
    the SLA.  ``as_of`` is an argument, never the wall clock."""
    ref = to_micros(F.lit(as_of).cast("timestamp_ntz"))
    out = None
    for name, df, col, sla_h in tables:
        r = df.agg(F.max(F.col(col).cast("timestamp_ntz")).alias("newest")).select(
            F.lit(name).alias("table_name"), "newest",
            ((ref - to_micros("newest")) / F.lit(1_000_000)).cast("long").alias("age_s"),
            F.lit(sla_h).alias("sla_hours"))
        r = r.withColumn("fresh", F.col("age_s") <= F.col("sla_hours") * 3600)
        out = r if out is None else out.unionByName(r)
    return out
