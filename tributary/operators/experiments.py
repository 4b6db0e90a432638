"""Experiment operators, re-aimed from the lab service
and the prose specs as DataFrame jobs.

Assignment is a pure function of (experiment, user) through md5, so it is
stable across processes and engines (X20) and needs no lookup table.  All
per-cell statistics are moments from one grouped aggregation; test
statistics are column arithmetic on those few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.hashing import bucket_of
from tributary.functions.nulls import ratio4
from tributary.functions.statistics import normal_two_sided, student_two_sided
from tributary.operators.scan import ordered_segments

# The reference's three experiments, each split 50%-50%.
EXPERIMENTS = ["note_suggestions", "table_editor", "mobile_performance"]
HALF_SPLIT = [("control", 50), ("treatment", 50)]
# The lab's button-colour cells; even ids are shown to the
# first two, odd ids to the rest.  Unknown assignment falls back to blue.
COLOR_CELLS = [("Red", 25), ("Orange", 25), ("Blue", 25), ("Green", 25)]
EVEN_CELLS = ["Red", "Orange"]
DEFAULT_CELL = "blue"


def assign_cell(bucket: Column, cells: Sequence[tuple[str, int]], default: str = DEFAULT_CELL) -> Column:
    """Cell from a bucket in [0, 100) by cumulative weights."""
    expr, upper = None, 0
    for name, weight in cells:
        upper += weight
        cond = bucket < F.lit(upper)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(default))


def cell_of(user: str, experiment: str, cells: Sequence[tuple[str, int]] = HALF_SPLIT) -> Column:
    """A user's cell as an expression of its id: no table of assignments and no
    join is needed to know it (E2)."""
    return assign_cell(bucket_of(F.col(user), experiment), cells)


def assign(users: DataFrame, user: str, experiments: Sequence[str],
           cells: Sequence[tuple[str, int]] = HALF_SPLIT, *, ts: str | None = None,
           launches: Mapping[str, str] | None = None) -> DataFrame:
    """One exposure row per user and experiment (E1, E2): bucket =
    md5(experiment:user) mod 100, salted by experiment so experiments are
    independent.  With ``ts``, the exposure time is the user's first event, at
    or after the experiment's launch where ``launches`` names one; users not
    seen since are not exposed.  Experiments expand per row from a literal
    array: no cross join."""
    if ts is None:
        base = users.select(user).distinct().select(user, F.explode(F.array(*[F.lit(e) for e in experiments])).alias("experiment"))
        extra = []
    else:
        per = exposure_times(users, user, experiments, ts, launches)
        seen = F.array(*[F.struct(F.lit(e).alias("experiment"), F.col(f"_x{i}").alias("exposure_ts")) for i, e in enumerate(experiments)])
        base = per.select(user, F.explode(seen).alias("_e")).select(user, "_e.experiment", "_e.exposure_ts").filter("exposure_ts is not null")
        extra = ["exposure_ts"]
    b = bucket_of(F.col(user), F.col("experiment"))
    return base.select("experiment", user, *extra, b.alias("bucket"), assign_cell(b, cells).alias("cell"))


def exposure_times(events: DataFrame, user: str, experiments: Sequence[str], ts: str, launches: Mapping[str, str] | None = None) -> DataFrame:
    """One row per user, with the exposure time of experiment ``i`` as ``_xi``
    (NULL: not exposed): one partial aggregate."""
    launches = launches or {}
    first = [F.min(F.when(F.col(ts) >= F.lit(launches[e]).cast("timestamp_ntz"), F.col(ts)) if e in launches else F.col(ts)).alias(f"_x{i}") for i, e in enumerate(experiments)]
    return events.groupBy(user).agg(*first)


def conversion(exposures: DataFrame, events: DataFrame, *, user: str = "user_id", ts: str = "ts",
               goal: Column, exposure_ts: str = "exposure_ts") -> DataFrame:
    """Per experiment and cell: exposed users, users with a goal event at or
    after exposure, and the rate (E3).  The goal side is reduced to each
    user's latest goal time (a partial aggregate) before the join: a user
    converts iff that time is >= the exposure."""
    last_goal = events.filter(goal).groupBy(user).agg(F.max(ts).alias("_last_goal"))
    j = exposures.join(last_goal, on=user, how="left")
    conv = (F.col("_last_goal") >= F.col(exposure_ts)).cast("int")
    g = j.groupBy("experiment", "cell").agg(F.count(F.lit(1)).alias("n_users"),
                                           F.coalesce(F.sum(conv), F.lit(0)).cast("long").alias("n_converted"))
    return g.withColumn("conversion_rate", ratio4("n_converted", "n_users"))


def cell_filter(df: DataFrame, id_col: str, cell: str = "cell", even_cells: Sequence[str] = EVEN_CELLS) -> DataFrame:
    """Rows the cell shows (E4): even ids for ``even_cells``, odd otherwise."""
    want = F.when(F.col(cell).isin(list(even_cells)), F.lit(0)).otherwise(F.lit(1))
    return df.filter(F.pmod(F.col(id_col), F.lit(2)) == want)


def cell_metrics(exposures: DataFrame, facts: DataFrame, *, user: str = "user_id", ts: str = "ts",
                 metric: str = "metric", value_cents: Column, exposure_ts: str = "exposure_ts",
                 quantiles: Sequence[float] = (), accuracy: int = 10_000) -> DataFrame:
    """Leading metrics per experiment, cell and metric (E5): count, mean,
    sample standard deviation, min, max over facts at or after exposure.
    Means use integer cents so they are exact.  ``quantiles`` adds
    ``percentile_approx`` columns (``p50`` ...): a fixed-size sketch per
    group, so a large cell never gathers its values in one task."""
    j = exposures.join(facts, on=user, how="inner").filter(F.col(ts) >= F.col(exposure_ts))
    value = value_cents / 100.0
    qs = [F.percentile_approx(value, q, accuracy).alias(f"p{round(q * 100)}") for q in quantiles]
    g = j.groupBy("experiment", "cell", metric).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value_cents).cast("long").alias("_sum_cents"),
        F.stddev_samp(value).alias("_sd"),
        F.min(value_cents).alias("_min"), F.max(value_cents).alias("_max"), *qs)
    return g.select("experiment", "cell", metric, "n",
                    ratio4(F.col("_sum_cents"), F.col("n") * 100).alias("mean"),
                    F.round("_sd", 4).alias("stddev"),
                    (F.col("_min") / 100.0).alias("min_value"), (F.col("_max") / 100.0).alias("max_value"),
                    *[f"p{round(q * 100)}" for q in quantiles])


def retention(exposures: DataFrame, activity: DataFrame, *, user: str = "user_id", ts: str = "ts",
              day_from: int = 7, day_to: int = 13, exposure_ts: str = "exposure_ts") -> DataFrame:
    """Lagging metric (E6): share of exposed users active between
    ``day_from`` and ``day_to`` days after their exposure day.  The activity
    side is reduced to distinct (user, day) before the join."""
    days = activity.select(user, F.to_date(ts).alias("_day")).distinct()
    ex = exposures.withColumn("_d0", F.to_date(exposure_ts))
    j = ex.join(days, on=user, how="left")
    off = F.datediff("_day", "_d0")
    hit = ((off >= day_from) & (off <= day_to)).cast("int")
    per_user = j.groupBy("experiment", "cell", user).agg(F.coalesce(F.max(hit), F.lit(0)).alias("_ret"))
    g = per_user.groupBy("experiment", "cell").agg(F.count(F.lit(1)).alias("n_users"),
                                                   F.sum("_ret").cast("long").alias("n_retained"))
    return g.withColumn("retention_rate", ratio4("n_retained", "n_users"))


def metrics_by_cell(events: DataFrame, experiments: Sequence[str], cells: Sequence[tuple[str, int]] = HALF_SPLIT, *, user: str = "user_id",
                    ts: str = "ts", metric: str = "metric", value_cents: Column, launches: Mapping[str, str] | None = None) -> DataFrame:
    """:func:`cell_metrics` over all experiments at once, for users assigned by
    :func:`assign`: the events join one row per user and are summed per user and
    metric for every experiment side by side; only these sums expand by
    experiment.  Sums of cents and of their squares are whole numbers, so means
    are exact and deviations lose no digits."""
    times = exposure_times(events, user, experiments, ts, launches)
    cents = value_cents.cast("long")
    facts = events.select(user, ts, metric, cents.alias("_c")).join(times, user)
    sums = []
    for i in range(len(experiments)):
        c = F.when(F.col(ts) >= F.col(f"_x{i}"), F.col("_c"))
        sums += [F.count_if(F.col(ts) >= F.col(f"_x{i}")).alias(f"_n{i}"), F.count(c).alias(f"_k{i}"), F.sum(c).alias(f"_s{i}"),
                 F.sum(c.cast("decimal(20,0)") * c.cast("decimal(18,0)")).cast("decimal(38,0)").alias(f"_q{i}"), F.min(c).alias(f"_lo{i}"), F.max(c).alias(f"_hi{i}")]
    per = facts.groupBy(user, metric).agg(*sums)
    parts = [F.struct(F.lit(e).alias("experiment"), cell_of(user, e, cells).alias("cell"), *[F.col(f"_{x}{i}").alias(x) for x in ("n", "k", "s", "q", "lo", "hi")])
             for i, e in enumerate(experiments)]
    rows = per.select(metric, F.explode(F.array(*parts)).alias("_e")).select(metric, "_e.*").filter("n > 0")
    g = rows.groupBy("experiment", "cell", metric).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("s").alias("s"), F.sum("q").cast("decimal(38,0)").alias("q"),
                                                       F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    # (k q - s^2) / (k (k - 1)): the numerator exact in decimals as long as it fits, else null
    spread = F.try_subtract(F.col("k").cast("decimal(18,0)") * F.col("q").cast("decimal(20,0)"), F.col("s").cast("decimal(19,0)") * F.col("s").cast("decimal(19,0)"))
    sd = F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0)) / (F.col("k").cast("double") * (F.col("k") - 1))) / 100.0
    return g.select("experiment", "cell", metric, "n", ratio4(F.col("s"), F.col("k") * 100).alias("mean"),
                    F.round(F.when(F.col("k") > 1, sd), 4).alias("stddev"), (F.col("lo") / 100.0).alias("min_value"), (F.col("hi") / 100.0).alias("max_value"))


def time_to_find(events: DataFrame, start: Column, goal: Column, *, user: str = "user_id", ts: str = "ts", order: str = "event_id") -> DataFrame:
    """Per user (E5): ``n_starts``, ``n_found`` and ``micros``, the time from
    every start event to the user's next goal event, summed: a forward as-of
    join without a window over a user's whole log.

    Rows are walked in ordered segments (time, then the unique ``order``).  In a
    segment a start takes the next goal there; starts after the segment's last
    goal stay open and are summed up with their number.  Per user, each
    segment's open starts take the first goal of the segments behind it."""
    from tributary.operators.sessions import to_micros

    rows = events.select(user, to_micros(ts).alias("_us"), order, F.coalesce(start, F.lit(False)).alias("_start"), F.coalesce(goal, F.lit(False)).alias("_goal"))
    rows = ordered_segments(rows.filter("_us is not null and (_start or _goal)"), [user], ["_us", order], unique=True)
    ahead = Window.partitionBy("_seg", user).orderBy("_us", order).rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("_next", F.min(F.when(F.col("_goal"), F.col("_us"))).over(ahead))
    found, left = F.col("_start") & F.col("_next").isNotNull(), F.col("_start") & F.col("_next").isNull()
    per = rows.groupBy("_seg", user).agg(
        F.count_if("_start").alias("_n"), F.count_if(found).alias("_f"), F.sum(F.when(found, F.col("_next") - F.col("_us"))).alias("_m"),
        F.count_if(left).alias("_o"), F.sum(F.when(left, F.col("_us")).cast("decimal(38,0)")).alias("_os"), F.min(F.when(F.col("_goal"), F.col("_us"))).alias("_first"))
    behind = Window.partitionBy(user).orderBy("_seg").rowsBetween(1, Window.unboundedFollowing)
    per = per.withColumn("_first", F.min("_first").over(behind))
    late = F.when(F.col("_first").isNotNull() & (F.col("_o") > 0), F.col("_first").cast("decimal(20,0)") * F.col("_o").cast("decimal(18,0)") - F.col("_os")).cast("bigint")
    return per.groupBy(user).agg(
        F.sum("_n").alias("n_starts"), F.sum(F.col("_f") + F.when(F.col("_first").isNotNull(), F.col("_o")).otherwise(0)).alias("n_found"),
        (F.coalesce(F.sum("_m"), F.lit(0)) + F.coalesce(F.sum(late), F.lit(0))).alias("micros"))


def adoption(exposures: DataFrame, events: DataFrame, goal: Column, *, last_day: str, user: str = "user_id", ts: str = "ts",
             exposure_ts: str = "exposure_ts") -> DataFrame:
    """Adoption over time (E6): Kaplan-Meier estimate of the share of users who
    have not yet met ``goal``, per experiment, cell and day since exposure.  A
    user adopts on the day of the first goal event at or after exposure; others
    are censored at ``last_day``.  ``at_risk``, ``n_adopted``, ``n_censored`` of
    the day, and ``adopted`` = 1 minus the product of (1 - adopted / at risk).

    Events are reduced per user and experiment first; the windows see one row
    per day."""
    goals = events.filter(goal).select(F.col(user).alias("_u"), F.col(ts).alias("_g"))
    j = exposures.join(goals, (F.col(user) == F.col("_u")) & (F.col("_g") >= F.col(exposure_ts)), "left")
    first = j.groupBy("experiment", "cell", user).agg(F.min("_g").alias("_g"), F.min(exposure_ts).alias("_e"))
    day = F.datediff(F.coalesce(F.to_date("_g"), F.to_date(F.lit(last_day))), F.to_date("_e"))
    per = first.groupBy("experiment", "cell", day.alias("day")).agg(F.count("_g").alias("n_adopted"), F.count_if(F.col("_g").isNull()).alias("n_censored"))
    w = Window.partitionBy("experiment", "cell").orderBy("day")
    at_risk = F.sum(F.col("n_adopted") + F.col("n_censored")).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("at_risk", at_risk)
    stay = F.lit(1.0) - F.col("n_adopted") / F.col("at_risk")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    survive = F.when(F.min(stay).over(upto) <= 0, F.lit(0.0)).otherwise(F.exp(F.sum(F.when(stay > 0, F.log(stay))).over(upto)))
    return per.select("experiment", "cell", "day", "at_risk", "n_adopted", "n_censored", F.round(F.lit(1.0) - survive, 6).alias("adopted"))


def rank_sum(scores: DataFrame, value: str, *, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """Satisfaction (E6): Mann-Whitney U of treatment over control scores per
    experiment, with middle ranks for ties, the tie-corrected z and its
    two-sided p, and the probability that a treatment score is the higher one.

    Scores are counted per (experiment, value) first; the values are walked in
    ordered segments, each summing the control scores below its treatment scores,
    and per experiment only one row a segment is left."""
    c, t = F.count_if(F.col("cell") == control), F.count_if(F.col("cell") == treatment)
    counts = scores.filter(F.col(value).isNotNull()).groupBy("experiment", value).agg(c.alias("_c"), t.alias("_t"))
    big = lambda x: F.col(x).cast("decimal(18,0)")
    rows = ordered_segments(counts, ["experiment"], [value], unique=True)
    below = F.coalesce(F.sum("_c").over(Window.partitionBy("_seg", "experiment").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_below", below).withColumn("_both", F.col("_c") + F.col("_t"))
    per = rows.groupBy("_seg", "experiment").agg(
        F.sum("_c").alias("_c"), F.sum("_t").alias("_t"), F.sum(big("_t") * (F.col("_below") * 2 + F.col("_c")).cast("decimal(19,0)")).cast("decimal(38,0)").alias("_u2"),
        F.sum(F.col("_both").cast("double") * (F.col("_both").cast("double") * F.col("_both") - 1.0)).alias("_ties"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy("experiment").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("_before", before)
    g = per.groupBy("experiment").agg(F.sum("_c").alias("n_c"), F.sum("_t").alias("n_t"), F.sum("_ties").alias("_ties"),
                                      (F.sum("_u2") + F.sum(big("_t") * (F.col("_before") * 2).cast("decimal(19,0)"))).cast("double").alias("_u2"))
    n = (F.col("n_c") + F.col("n_t")).cast("double")
    pairs = F.col("n_c").cast("double") * F.col("n_t")
    var = pairs / 12.0 * (n + 1.0 - F.try_divide(F.col("_ties"), n * (n - 1.0)))
    z = F.try_divide(F.col("_u2") / 2.0 - pairs / 2.0, F.sqrt(F.greatest(var, F.lit(0.0))))
    return g.select("experiment", "n_c", "n_t", (F.col("_u2") / 2.0).alias("u_stat"), F.round(F.try_divide(F.col("_u2") / 2.0, pairs), 6).alias("prob_higher"),
                    F.round(z, 6).alias("z_stat"), F.round(normal_two_sided(z), 6).alias("p_value"))


def two_proportion(rates: DataFrame, n: str = "n_users", hits: str = "n_converted", *, control: str = "control", treatment: str = "treatment") -> DataFrame:
    """Null vs alternative for rates (E7): pooled two-proportion z test of
    treatment against control per experiment, from one row per cell."""
    pick = lambda col, cell: F.max(F.when(F.col("cell") == cell, F.col(col)))
    g = rates.groupBy("experiment").agg(pick(n, control).alias("n_c"), pick(hits, control).alias("x_c"), pick(n, treatment).alias("n_t"), pick(hits, treatment).alias("x_t"))
    pc, pt_ = F.try_divide(F.col("x_c"), F.col("n_c")), F.try_divide(F.col("x_t"), F.col("n_t"))
    pool = F.try_divide(F.col("x_c") + F.col("x_t"), F.col("n_c") + F.col("n_t"))
    z = F.try_divide(pt_ - pc, F.sqrt(pool * (F.lit(1.0) - pool) * (F.try_divide(F.lit(1.0), F.col("n_c")) + F.try_divide(F.lit(1.0), F.col("n_t")))))
    return g.select("experiment", "n_c", "x_c", "n_t", "x_t", F.round(pt_ - pc, 6).alias("rate_difference"), F.round(z, 6).alias("z_stat"), F.round(normal_two_sided(z), 6).alias("p_value"))


def compare_cells(per_user: DataFrame, value: str, *, control: str = "control",
                  treatment: str = "treatment") -> DataFrame:
    """Null vs alternative (E7): Welch's t statistic for the difference of
    per-user means, its Welch-Satterthwaite degrees of freedom, and the exact
    two-sided tail of Student's t with them.
    ``per_user`` has (experiment, cell, value) rows; everything after the
    grouped moments is arithmetic on two rows per experiment."""
    m = per_user.groupBy("experiment").agg(
        F.count(F.when(F.col("cell") == control, F.col(value))).alias("n_c"),
        F.count(F.when(F.col("cell") == treatment, F.col(value))).alias("n_t"),
        F.avg(F.when(F.col("cell") == control, F.col(value))).alias("_mc"),
        F.avg(F.when(F.col("cell") == treatment, F.col(value))).alias("_mt"),
        F.var_samp(F.when(F.col("cell") == control, F.col(value))).alias("_vc"),
        F.var_samp(F.when(F.col("cell") == treatment, F.col(value))).alias("_vt"))
    se2 = F.col("_vc") / F.col("n_c") + F.col("_vt") / F.col("n_t")
    t = F.try_divide(F.col("_mt") - F.col("_mc"), F.sqrt(se2))
    df_ = F.try_divide(se2 * se2, F.pow(F.col("_vc") / F.col("n_c"), 2) / (F.col("n_c") - 1)
                       + F.pow(F.col("_vt") / F.col("n_t"), 2) / (F.col("n_t") - 1))
    return m.select("experiment", "n_c", "n_t", F.round("_mc", 4).alias("mean_control"),
                    F.round("_mt", 4).alias("mean_treatment"), F.round(t, 4).alias("t_stat"),
                    F.round(df_, 2).alias("dof"), F.round(student_two_sided(t, df_), 4).alias("p_value"))
