"""Hot-key measurement: one (host, ip) holding every event (the sf0.1 events
re-keyed and replicated 20x with 31-day shifts, about 2M rows, derived for this
measurement only).  Runs the chunked ``sessionize`` against Spark's native
batch ``session_window`` and a per-key ``lag`` window, and the chunked rolling
window and longest streak against their plain per-key window forms, dedup
against ``row_number``, the salted join against a plain join, and the
cumulative snapshot with history arrays against the array-free summary, each into
the noop sink with the event log on.  Reports for each the slowest task and
the share of the rows read by the busiest task of the stages that shuffle the
rows.

usage: python tools/hot_key_check.py [sf_dir]
"""

import glob
import json
import sys
import tempfile
import time

sys.path.insert(0, ".")

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tributary.operators import cumulative as cu  # noqa: E402
from tributary.operators import facts  # noqa: E402
from tributary.operators import joins as jn  # noqa: E402
from tributary.operators import patterns as pt  # noqa: E402
from tributary.operators import sessions as ss  # noqa: E402
from tributary.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="hotkey-log-")
    # partition coalescing off: at this size AQE would merge the 16 shuffle
    # partitions, hiding how the rows spread; at scale partitions are large.
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                 "spark.eventLog.compress": "false",
                                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts")
    hot = None
    for k in range(20):
        part = ev.select(F.lit("hot").alias("host"), F.lit("1").alias("ip"),
                         F.timestamp_add("DAY", F.lit(31 * k), F.col("ts")).alias("ts"))
        hot = part if hot is None else hot.unionByName(part)
    hot = hot.repartition(16).cache()
    n_rows = hot.count()
    w = Window.partitionBy("host", "ip").orderBy("ts")
    lagw = (hot.withColumn("_n", (F.col("ts") > F.timestamp_add("MINUTE", F.lit(5), F.lag("ts").over(w))).cast("int"))
            .withColumn("_s", F.sum(F.coalesce("_n", F.lit(1))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("host", "ip", "_s").count())
    val = hot.withColumn("v", (F.second("ts") % 2).cast("int"))
    dim = spark.createDataFrame([("hot", "x")], "host string, label string")
    # one actor with every row; a "year" per month of events
    films = val.select(F.col("host").alias("actorid"),
                       ((F.year("ts") - 2024) * 12 + F.month("ts")).alias("year"),
                       F.col("ts").cast("string").alias("film"), F.col("v").alias("votes"),
                       (F.col("v") * 9.0).alias("rating"), F.unix_micros(F.col("ts").cast("timestamp")).alias("filmid"))
    last_period = 40
    wk = Window.partitionBy("host").orderBy("ts")
    plain_roll = val.withColumn("r", F.sum("v").over(wk.rowsBetween(-89, 0))).groupBy("host").agg(F.max("r"))
    rn = F.row_number().over(wk)
    plain_streak = (val.withColumn("_rn", rn).filter(F.col("v") == 1)
                    .withColumn("_g", F.col("_rn") - F.row_number().over(wk))
                    .groupBy("host", "_g").count().groupBy("host").agg(F.max("count")))
    runs = {
        "chunked sessionize (1h buckets)": ss.sessionize(hot, "ts", ["host", "ip"], "5 minutes"),
        "native session_window groupBy": hot.groupBy(F.session_window(F.col("ts").cast("timestamp"), "5 minutes"),
                                                     "host", "ip").count(),
        "per-key lag window": lagw,
        "chunked rolling 90 rows (daily)": pt.rolling_rows(val, "host", ["ts"], "v", 90, bucket=F.to_date("ts"))
                                           .groupBy("host").agg(F.max("rolling")),
        "per-key rolling window": plain_roll,
        "chunked longest streak (daily)": pt.longest_streak(val, "host", ["ts"], F.col("v") == 1,
                                                            bucket=F.to_date("ts")),
        "per-key gap-and-island": plain_streak,
        "dedup min(struct) partial aggregate": facts.dedup(val, ["host"], ["ts", "v"]),
        "dedup row_number window": val.withColumn("_r", F.row_number().over(Window.partitionBy("host")
                                                                            .orderBy("ts", "v"))).filter("_r = 1"),
        "salted join (hot key salted 16 ways)": jn.salted_join(val, dim, ["host"], salts=16, min_rows=100_000)
                                                .groupBy("label").count(),
        "plain join": val.join(dim, "host").groupBy("label").count(),
        "cumulative snapshot, history arrays": cu.cumulate_range(
            cu.period_rollup(films, ["actorid"], "year", ["film", "votes", "rating", "filmid"], avg_col="rating",
                             cluster_by_keys=True), ["actorid"], period="year", end=last_period)
        .select("actorid", "current_year", F.size("films").alias("n")),
        "cumulative snapshot, array-free summary": cu.cumulate_range_summary(
            films.groupBy("actorid", "year").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("average_value")),
            ["actorid"], period="year", end=last_period, running_sums=["n"]),
    }
    wall = {}
    for name, df in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        wall[name] = time.perf_counter() - t0
    spark.stop()
    path = glob.glob(f"{log_dir}/*/events_*")[0]
    stage_group, stats = {}, {}
    for line in open(path):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerJobStart":
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = (e.get("Properties") or {}).get("spark.jobGroup.id")
        elif e.get("Event") == "SparkListenerTaskEnd":
            sr = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            dur = e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"]
            stats.setdefault(e["Stage ID"], []).append((dur, sr.get("Total Records Read", 0)))
    print(f"rows: {n_rows}")
    for name in runs:
        worst, share = 0, 0.0
        for sid, ts in stats.items():
            recs = [r for _, r in ts]
            if stage_group.get(sid) == name and sum(recs) >= n_rows // 2:
                worst = max(worst, max(d for d, _ in ts))
                share = max(share, max(recs) / sum(recs))
        if share == 0.0:
            print(f"{name:36s} wall {wall[name]:5.2f} s   rows reduced map-side before any shuffle")
        else:
            print(f"{name:36s} wall {wall[name]:5.2f} s   max task {worst:5d} ms   busiest task reads {share:6.1%}")


if __name__ == "__main__":
    main()
