"""Merges that write only the partitions a step touches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import facts, scd
from tributary.sources import merge


def stamps(path):
    """Data files of each partition with their times."""
    out = {}
    for d, _, files in os.walk(path):
        if "=" in os.path.basename(d):
            out[os.path.basename(d)] = {f: os.path.getmtime(os.path.join(d, f)) for f in files if f.endswith(".parquet")}
    return out


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("set_cols", [None, ["v"]])
def test_merge_equals_upsert_and_touches_two_partitions(spark, scratch, set_cols):
    rnd, path = random.Random(1), os.path.join(scratch, "t")
    schema = "k string, month string, v long, w long"
    target = spark.createDataFrame([(k, m, rnd.randrange(99), 1) for k in [*"abcdef", None] for m in ["m1", "m2", "m3", None]], schema)
    source = spark.createDataFrame([("a", "m2", 500, 2), ("z", "m2", 501, 2), (None, None, 502, 2), ("b", None, 503, 2)], schema)
    merge.replace_partitions(target, path, "month")
    want = rows(facts.upsert(target, source, ["k", "month"], set_cols))
    before = stamps(path)
    for _ in range(2):                                                 # and again
        assert rows(merge.merge_partitions(path, source, ["k", "month"], "month", set_cols=set_cols)) == want
    after = stamps(path)
    same = {p for p in before if before[p] == after[p]}
    assert same == {"month=m1", "month=m3"} and set(after) == set(before)


def test_merge_adds_partitions_and_ignores_an_empty_source(spark, scratch):
    path = os.path.join(scratch, "t")
    t = spark.createDataFrame([("a", 1, 10)], "k string, p int, v int")
    merge.replace_partitions(t, path, "p")
    assert rows(merge.merge_partitions(path, t.limit(0), ["k", "p"], "p")) == rows(t)
    new = spark.createDataFrame([("a", 2, 20)], "k string, p int, v int")
    assert rows(merge.merge_partitions(path, new, ["k", "p"], "p")) == rows(t.union(new))
    with pytest.raises(ValueError):
        merge.merge_partitions(path, new, ["k"], "p")


def test_scd2_steps_equal_the_backfill_and_keep_old_partitions(spark, scratch):
    """Keys that start late, pause, change and are NULL; every step run twice,
    and the history of each earlier period still readable."""
    rnd, path = random.Random(7), os.path.join(scratch, "scd")
    data = []
    for k in [*range(40), None]:
        cls = rnd.choice("xyz")
        for y in range(rnd.randrange(2000, 2004), 2007):
            cls = rnd.choice("xyz") if rnd.random() < 0.4 else cls
            if rnd.random() < 0.85:
                data.append((k, y, cls, rnd.random() < 0.5))
    snap = spark.createDataFrame(data, "k long, current_year int, cls string, act boolean").cache()
    attrs, cols = ["cls", "act"], ["k", "cls", "act", "start_date", "end_date", "current_year"]
    history = scd.scd2_backfill(snap, "k", "current_year", attrs, as_of=2001)
    merge.replace_partitions(history.filter("end_date <= 2001"), path, "current_year")
    want = {}
    for y in range(2002, 2007):
        cur = snap.filter(F.col("current_year") == y)
        history = scd.scd2_merge(history, cur, "k", attrs, prev_as_of=y - 1, new_period=y).checkpoint()
        want[y] = rows(history.select(cols))
        before = stamps(path)
        for _ in range(2):
            merge.scd2_step(path, cur, "k", attrs, period=y)
        after = stamps(path)
        assert all(after[p] == before[p] for p in before) and set(after) - set(before) == {f"current_year={y}"}
    for y in range(2002, 2007):
        assert rows(merge.scd2_as_of(spark, path, y).select(cols)) == want[y], y
