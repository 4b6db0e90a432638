"""Per-query stage skew from a Spark event log (written by bench.py with
BENCH_EVENT_LOG_DIR): for every stage, task count, max and median task time,
and max / median shuffle-read bytes.  Flags stages whose slowest task is far
above the median (a hot partition).

usage: python tools/stage_report.py <event-log-file> [min_ratio]
"""

import json
import statistics
import sys
from collections import defaultdict


def _open(path):
    """Event logs are zstd-compressed by default in Spark 4."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(path, "rb")), encoding="utf-8")
    return open(path, encoding="utf-8")


def main():
    path = sys.argv[1]
    min_ratio = float(sys.argv[2]) if len(sys.argv) > 2 else 3.0
    stage_group, tasks = {}, defaultdict(list)
    job_group = {}
    with _open(path) as f:
        for line in f:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
                job_group[ev["Job ID"]] = group
            elif kind == "SparkListenerTaskEnd":
                info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
                dur = info["Finish Time"] - info["Launch Time"]
                sr = metrics.get("Shuffle Read Metrics") or {}
                read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                tasks[ev["Stage ID"]].append((dur, read))
    per_query = defaultdict(lambda: [0, 0])
    flagged = {"scan": 0, "shuffle": 0}
    print(f"{'query':36s} {'stage':>5s} {'kind':>7s} {'tasks':>5s} {'max ms':>7s} {'med ms':>7s} "
          f"{'max read':>9s} {'med read':>9s}")
    for sid, ts in sorted(tasks.items()):
        q = stage_group.get(sid, "?")
        durs, reads = [d for d, _ in ts], [r for _, r in ts]
        mx, med = max(durs), statistics.median(durs)
        kind = "shuffle" if sum(reads) > 0 else "scan"
        per_query[q][0] += 1
        per_query[q][1] += len(ts)
        if len(ts) > 1 and mx > 50 and mx > min_ratio * max(med, 1):
            flagged[kind] += 1
            print(f"{q:36s} {sid:5d} {kind:>7s} {len(ts):5d} {mx:7d} {med:7.0f} {max(reads):9d} "
                  f"{statistics.median(reads):9.0f}")
    print("flagged stages by kind:", flagged)
    print("stages / tasks per query:", {q: tuple(v) for q, v in per_query.items()})


if __name__ == "__main__":
    main()
