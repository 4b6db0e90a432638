"""Segmented history (D1, D2, D5, D11) against the array form and brute force."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tributary.operators import cumulative as cu
from tributary.operators import history as hs
from tributary.sources.merge import replace_partitions


@pytest.fixture(scope="module")
def films(spark):
    """One actor holds half of all films, most of them in one year."""
    rnd = random.Random(4)
    rows = [(rnd.choice(["hot"] * 5 + ["a", "b", "c", None, "d"]), 2000 + (0 if rnd.random() < 0.6 else rnd.randrange(5)), f"f{i}", rnd.randrange(100), float(rnd.randrange(40, 100)) / 8, i)
            for i in range(4000)]
    return spark.createDataFrame(rows, "actorid string, year int, film string, votes int, rating double, filmid long").repartition(6)


def segments(films, size):
    return hs.history_segments(films, ["actorid"], "year", ["film", "votes", "rating", "filmid"], order_by=["filmid"], size=size,
                               sums={"total_votes": F.col("votes").cast("long"), "rating_sum": F.col("rating")})


@pytest.mark.parametrize("size", [1, 7, 100, 100_000])
def test_segments_hold_every_item_in_order(films, size):
    out = segments(films, size).collect()
    assert all(len(r["items"]) == r.n_items <= size and [x.filmid for x in r["items"]] == sorted(x.filmid for x in r["items"]) for r in out)
    assert all(r.total_votes == sum(x.votes for x in r["items"]) for r in out)
    got, want = {}, {}
    for r in sorted(out, key=lambda r: r.segment):
        got.setdefault((r.actorid, r.year), []).extend(x.filmid for x in r["items"])
    for r in films.orderBy("filmid").collect():
        want.setdefault((r.actorid, r.year), []).append(r.filmid)
    assert got == want


def test_snapshots_equal_the_array_form(films):
    per = hs.period_summary(segments(films, 50), ["actorid"], "year", sums=["total_votes", "rating_sum"])
    per = per.select("actorid", "year", "n_items", "total_votes", F.col("first_item.filmid").alias("f"), F.col("last_item.filmid").alias("l"), (F.col("rating_sum") / F.col("n_items")).alias("m"))
    got = cu.cumulate_range_summary(per, ["actorid"], period="year", end=2006, measure="m", running_sums=["n_items", "total_votes"], firsts=["f"], lasts=["l"])
    roll = cu.period_rollup(films, ["actorid"], "year", ["film", "votes", "rating", "filmid"], avg_col="rating", order_by=["filmid"])
    want = cu.cumulate_range(roll, ["actorid"], period="year", end=2006)
    want = want.select("actorid", "current_year", "is_active", F.size("films").cast("long"), F.aggregate("films", F.lit(0).cast("long"), lambda a, x: a + x["votes"]),
                       F.element_at("films", 1)["filmid"], F.element_at("films", -1)["filmid"], "quality_class")
    rows = lambda df: sorted(map(str, map(tuple, df.collect())))
    assert rows(got.select("actorid", "current_year", "is_active", "n_items", "total_votes", "first_f", "last_l", "quality_class")) == rows(want)


def test_steps_equal_the_range(films):
    per = hs.period_summary(segments(films, 50), ["actorid"], "year", sums=["total_votes", "rating_sum"])
    per = per.select("actorid", "year", F.col("n_items").alias("n"), (F.col("rating_sum") / F.col("n_items")).alias("average_value"), F.col("first_item.filmid").alias("f"), F.col("last_item.filmid").alias("l")).cache()
    whole = cu.cumulate_range_summary(per, ["actorid"], period="year", end=2005, running_sums=["n"], firsts=["f"], lasts=["l"])
    whole = whole.select("actorid", "current_year", "n", F.col("first_f").alias("f"), F.col("last_l").alias("l"), "quality_class", "is_active").cache()
    snap = whole.filter("current_year = 2001")
    for year in range(2002, 2006):
        snap = hs.cumulate_summary(snap, per.filter(F.col("year") == year), ["actorid"], sums=["n"], firsts=["f"], lasts=["l"])
        want = whole.filter(F.col("current_year") == year)
        assert sorted(map(str, snap.select(want.columns).collect())) == sorted(map(str, want.collect())), year


def test_hot_entity_spreads_over_tasks(spark, films):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = segments(films, 50).groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n_items").alias("n")).collect()
        ranges = segments(films, 50).filter("actorid = 'hot' and year = 2000").select((F.col("segment") / (1 << 32)).cast("int").alias("s")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert ranges >= 2 and max(r.n for r in per_task) < 0.5 * 4000


def test_a_step_writes_its_own_period_and_reruns(spark, films, scratch):
    path = os.path.join(scratch, "segments")
    replace_partitions(segments(films.filter("year < 2004"), 50), path, "year")
    before = {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if "year=2003" in d}
    for _ in range(2):
        replace_partitions(segments(films.filter("year = 2004"), 50), path, "year")
    replace_partitions(segments(films.filter("year = 2001"), 9), path, "year")
    assert before == {f: os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if "year=2003" in d}
    got = spark.read.parquet(path).select("actorid", F.explode("items").alias("x")).select("actorid", "x.filmid")
    assert sorted(map(str, got.collect())) == sorted(map(str, films.select("actorid", "filmid").collect()))


def test_empty_input(films):
    assert segments(films.limit(0), 5).collect() == []
