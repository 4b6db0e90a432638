"""Fact operators.

Dedup, enrichment and projection of fact rows; daily activity, cumulative
datelists and their 32-bit masks; monthly host datelists and reduced metric
arrays; and the upsert that replaces PostgreSQL's ``ON CONFLICT``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.bits import datelist_mask, mask_bits
from tributary.functions.nulls import concat_arrays, null_safe_on
from tributary.operators.joins import lookup_join


# --- F1-F5: dedup, enrich, project -------------------------------------------

def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep, per key, the first row in the caller's total order (F1, X5),
    ascending or descending, whatever the types of the other columns.

    ``row_number() = 1`` plans a WindowGroupLimit on both sides of the shuffle
    (a plan test asserts it), so a key with a third of all rows leaves each
    map task as one row."""
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).filter(F.col("_nth") == 1).drop("_nth")


def enrich(detail: DataFrame, parent: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Attach parent attributes; orphan details stay (F2)."""
    return detail.join(parent, on=on, how=how)


def project(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Rename / compute output columns, e.g. ``dim_*`` and ``m_*``."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


# --- F6-F9: daily activity, datelists, masks ---------------------------------

def daily_activity(events: DataFrame, devices: DataFrame, *, user: str = "user_id",
                   device: str = "device_id", ts: str = "event_time", browser: str = "browser_type",
                   day: str | None = None) -> DataFrame:
    """One row per user x device x browser x day; NULL ids dropped."""
    ev = events.filter(F.col(user).isNotNull() & F.col(device).isNotNull())
    ev = ev.select(user, device, F.to_date(ts).alias("date"))
    if day is not None:
        ev = ev.filter(F.col("date") == F.to_date(F.lit(day)))
    ev = ev.distinct()
    j = lookup_join(ev, devices.select(device, browser), [device], how="left")
    return j.select(user, device, browser, "date").distinct()


def datelist_cumulate(prev: DataFrame, today: DataFrame, keys: Sequence[str], day: str, *,
                      as_of: str | None = None, date_col: str = "date",
                      list_col: str = "device_activity_datelist", null_safe: bool = True) -> DataFrame:
    """One day of the cumulative datelist (F7): the keys active on ``day`` get
    it as a set member of their sorted list, idle keys are carried.  Every row
    is dated ``as_of`` (default ``day``), so skipped days do not split a
    snapshot; rerunning ``day``, or an earlier day with the snapshot's own date
    as ``as_of``, gives the same snapshot again (X8).  Keys match NULL-safely (X6: a NULL browser
    still matches), and the date is part of the output key.  With keys
    declared non-NULL, ``null_safe=False`` joins on plain equality, which lets
    a snapshot bucketed by the keys skip its shuffle."""
    y = prev.alias("y")
    d, snapshot = F.to_date(F.lit(day)), F.to_date(F.lit(as_of or day))
    t = today.filter(F.col(date_col) == d).select(*keys).distinct().withColumn("_t", F.lit(True)).alias("t")
    if null_safe:
        cond = null_safe_on(y, t, keys)
    else:
        cond = None
        for k in keys:
            c = F.col(f"y.{k}") == F.col(f"t.{k}")
            cond = c if cond is None else cond & c
    j = y.join(t, cond, "full_outer")
    cols = [F.coalesce(F.col(f"t.{k}"), F.col(f"y.{k}")).alias(k) for k in keys]
    cols.append(snapshot.alias(date_col))
    today_arr = F.when(F.col("t._t").isNotNull(), F.array(d))
    cols.append(F.array_sort(F.array_distinct(concat_arrays(F.col(f"y.{list_col}"), today_arr))).alias(list_col))
    return j.select(*cols)


def datelist_range(activity: DataFrame, keys: Sequence[str], *, end: str, date_col: str = "date",
                   list_col: str = "device_activity_datelist") -> DataFrame:
    """Every daily snapshot up to ``end`` in one pass; equals folding
    :func:`datelist_cumulate` day by day (tested).  Each active day expands to
    the idle days before the key's next active day (``lead``), and a running
    ``collect_list`` builds the list; both windows share the key partitioning."""
    end_d = F.to_date(F.lit(end))
    act = activity.select(*keys, date_col).filter(F.col(date_col) <= end_d).distinct()
    w = Window.partitionBy(*keys).orderBy(date_col)
    last = F.coalesce(F.date_sub(F.lead(date_col).over(w), 1), end_d)
    exp = (act.withColumn("_span", F.sequence(F.col(date_col), last))
           .select(*keys, date_col, F.posexplode("_span").alias("_p", "_d")))
    exp = exp.select(*keys, F.col("_d").alias("_day"), F.when(F.col("_p") == 0, F.col(date_col)).alias("_act"))
    wc = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return exp.select(*keys, F.col("_day").alias(date_col), F.collect_list("_act").over(wc).alias(list_col))


def datelist_snapshot(activity: DataFrame, keys: Sequence[str], *, as_of: str, date_col: str = "date",
                      list_col: str = "device_activity_datelist") -> DataFrame:
    """The single snapshot at ``as_of`` (what F7 yields on that day): the
    sorted distinct active days per key.  Bounded by days per key."""
    a = activity.filter(F.col(date_col) <= F.to_date(F.lit(as_of)))
    return (a.groupBy(*keys).agg(F.sort_array(F.collect_set(date_col)).alias(list_col))
            .withColumn(date_col, F.to_date(F.lit(as_of))))


def datelist_int(df: DataFrame, list_col: str, as_of: str | Column, *, out: str = "datelist_int",
                 bits_out: str | None = "datelist_bits") -> DataFrame:
    """32-bit activity mask from a datelist (F8): bit 31 = as-of day.  Array
    arithmetic per row; no day series cross join."""
    ref = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    res = df.withColumn(out, datelist_mask(list_col, ref))
    if bits_out:
        res = res.withColumn(bits_out, mask_bits(out))
    return res


def day_series(spark, start: str, end: str, name: str = "series_date") -> DataFrame:
    """Inclusive day series (F9), generated on executors from one row."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias(name))


def days_between(spans: DataFrame, first: str, last: str, name: str = "series_date") -> DataFrame:
    """The days of each row's span, both ends included (F9 from data)."""
    return spans.select(F.explode(F.sequence(first, last)).alias(name))


# --- F10-F13: host datelists, metric arrays, upsert ---------------------------

def host_datelist_step(prev: DataFrame, events: DataFrame, day: str, *, host: str = "host",
                       ts: str = "event_time", list_col: str = "host_activity_datelist") -> DataFrame:
    """One day of the monthly host datelist (F10).  Rerunning a day leaves the
    list unchanged (X8): the day is added as a set member and kept sorted."""
    d = F.to_date(F.lit(day))
    month = F.trunc(d, "month")
    today = (events.filter(F.to_date(ts) == d).select(host).distinct()
             .select(F.col(host).alias("_host"), F.lit(True).alias("_t")))
    y = prev.filter(F.col("month_start") == month).select(host, "month_start", list_col)
    j = y.join(today, F.col(host).eqNullSafe(F.col("_host")), how="full_outer")
    added = F.when(F.col("_t").isNotNull(), F.array(d))
    return j.select(F.coalesce(host, "_host").alias(host), F.coalesce(F.col("month_start"), month).alias("month_start"),
                    F.array_sort(F.array_distinct(concat_arrays(F.col(list_col), added))).alias(list_col))


def host_datelist(events: DataFrame, *, as_of: str, host: str = "host", ts: str = "event_time",
                  list_col: str = "host_activity_datelist") -> DataFrame:
    """Batch form of F10: per host and month up to ``as_of`` the sorted active
    days; equal to the daily upserts."""
    e = events.filter(F.to_date(ts) <= F.to_date(F.lit(as_of)))
    days = e.select(host, F.to_date(ts).alias("_d"))
    # collect_set deduplicates map-side: one shuffle of at most one row per
    # host and day per task.
    return (days.groupBy(host, F.trunc("_d", "month").alias("month_start"))
            .agg(F.sort_array(F.collect_set("_d")).alias(list_col)))


def daily_host_metrics(events: DataFrame, *, host: str = "host", user: str = "user_id",
                       ts: str = "event_time") -> DataFrame:
    """Hits and distinct users per host and day (F11).  Spark plans the
    distinct count with an extra (host, day, user) aggregation, which spreads
    a hot host over many tasks."""
    return (events.groupBy(host, F.to_date(ts).alias("date"))
            .agg(F.count(F.lit(1)).alias("hits"), F.count_distinct(user).alias("unique_visitors")))


def monthly_arrays_step(prev: DataFrame, today: DataFrame, day: str, *, as_of: str | None = None, host: str = "host",
                        metrics: Sequence[str] = ("hits", "unique_visitors"),
                        arrays: Sequence[str] = ("hit_array", "unique_visitors_array")) -> DataFrame:
    """Put one day into the monthly metric arrays.

    The slot is placed by day of month: a host first seen mid-month is padded
    with ``day - 1`` zeros (X9), an idle day gets 0 and a skipped day is zero
    padded.  Rerunning a day, the last or an earlier one, replaces its slot and
    keeps all others (X8); ``as_of`` (default ``day``, same month) is the day
    up to which every array reaches, for reruns on a later snapshot."""
    d = F.to_date(F.lit(day))
    month = F.trunc(d, "month")
    dom, upto = F.dayofmonth(d), F.dayofmonth(F.to_date(F.lit(as_of or day)))
    t = today.filter(F.col("date") == d).select(F.col(host).alias("_host"), *metrics)
    y = prev.filter(F.col("month_start") == month).select(host, "month_start", *arrays)
    j = y.join(t, F.col(host).eqNullSafe(F.col("_host")), how="full_outer")

    def place(arr: str, metric: str) -> Column:
        base = F.coalesce(F.col(arr), F.array().cast("array<bigint>"))
        padded = concat_arrays(base, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.greatest(dom, upto) - F.size(base), F.lit(0))))
        value = F.coalesce(F.col(metric).cast("long"), F.lit(0).cast("long"))
        return F.transform(padded, lambda x, i: F.when(i == dom - 1, value).otherwise(x))

    return j.select(F.coalesce(host, "_host").alias(host), F.coalesce(F.col("month_start"), month).alias("month_start"),
                    *[place(a, m).alias(a) for a, m in zip(arrays, metrics)])


def monthly_arrays(daily: DataFrame, *, as_of: str, host: str = "host",
                   metrics: Sequence[str] = ("hits", "unique_visitors"),
                   arrays: Sequence[str] = ("hit_array", "unique_visitors_array")) -> DataFrame:
    """Batch form of F12 for every month up to ``as_of``: one slot per day of
    the month (up to the day of ``as_of`` in its month), 0 where idle.  Groups
    hold at most 31 pre-aggregated day rows."""
    d = F.to_date(F.lit(as_of))
    src = daily.filter(F.col("date") <= d)
    g = src.groupBy(host, F.trunc("date", "month").alias("month_start")).agg(*[F.map_from_entries(F.collect_list(F.struct(F.dayofmonth("date"), F.col(m).cast("long"))))
                                .alias(f"_m{i}") for i, m in enumerate(metrics)])
    slots = F.sequence(F.lit(1), F.dayofmonth(F.least(F.last_day("month_start"), d)))

    def fill(k: int) -> Column:
        return F.transform(slots, lambda i: F.coalesce(F.element_at(F.col(f"_m{k}"), i), F.lit(0).cast("long")))

    return g.select(host, "month_start",
                    *[fill(k).alias(a) for k, a in enumerate(arrays)])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           set_cols: Sequence[str] | None = None, *, null_safe: bool = True) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` (F13) without MERGE: target
    rows whose key is not in the source, plus the source rows.  With
    ``set_cols``, conflicting rows keep their other target columns and take
    only ``set_cols`` from the source.  NULL keys match each other (V7); with
    keys declared non-NULL, ``null_safe=False`` joins on plain equality, which
    a bucketed target needs to skip its shuffle.  Write the result to a new
    snapshot path; never overwrite the path being read."""
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_k_{k}")) if null_safe else F.col(k) == F.col(f"_k_{k}")
        cond = c if cond is None else cond & c
    if set_cols is None:
        return target.join(source.select(*named), cond, "left_anti").unionByName(source.select(*target.columns))
    keep = [c for c in target.columns if c not in keys and c not in set_cols]
    s = source.select(*named, *[F.col(c).alias(f"_s_{c}") for c in set_cols], F.lit(True).alias("_s"))
    j = target.join(s, cond, "full_outer")
    cols = [*[F.coalesce(k, f"_k_{k}").alias(k) for k in keys], *keep, *[F.when(F.col("_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
                            for c in set_cols]]
    return j.select(*cols).select(*target.columns)
