"""Cumulative snapshots and SCD2 (D1-D13) on hand-made rows (FIXTURES §4)
and incremental-equals-batch checks."""

from pyspark.sql import functions as F

from tributary.operators import cumulative as cu
from tributary.operators import scd
from tributary.plans import derive as dv

FILM_COLS = ["film", "votes", "rating", "filmid"]


def _films(spark, rows):
    return spark.createDataFrame(rows, "actorid string, actor string, year int, film string, votes int, "
                                       "rating double, filmid string")


def test_classify_strict_bounds(spark):
    df = spark.createDataFrame([(8.0,), (8.01,), (7.0,), (6.5,), (6.0,), (None,)], "x double")
    got = [r[0] for r in df.select(cu.classify("x")).collect()]
    assert got == ["good", "star", "average", "average", "bad", None]


def test_cumulate_fixture_d2(spark):
    prev = spark.createDataFrame(
        [("A", "a", 2020, [("f1", 1, 9.0, "1")], "star", True),
         ("B", "b", 2020, [("f2", 1, 5.0, "2")], "bad", True)],
        "actor string, actorid string, current_year int, "
        "films array<struct<film:string,votes:int,rating:double,filmid:string>>, quality_class string, "
        "is_active boolean")
    films = _films(spark, [("a", "A", 2021, "f3", 1, 6.5, "3"), ("c", "C", 2021, "f4", 1, 8.0, "4")])
    cur = cu.period_rollup(films, ["actorid"], "year", FILM_COLS, avg_col="rating", carry=["actor"],
                           avg_out="average_value")
    out = {r.actorid: r for r in cu.cumulate(prev, cur, ["actorid"], carry=["actor"]).collect()}
    assert [f.film for f in out["a"].films] == ["f1", "f3"] and out["a"].quality_class == "average"
    assert out["a"].is_active and out["a"].actor == "A"
    assert [f.film for f in out["b"].films] == ["f2"] and out["b"].quality_class == "bad"
    assert not out["b"].is_active
    assert out["c"].quality_class == "good" and out["c"].is_active          # 8.0 is not > 8
    assert {r.current_year for r in out.values()} == {2021}


def test_cumulate_range_equals_fold(spark):
    """Folding the incremental step over the years equals the one-pass range."""
    roll = cu.period_rollup(dv.actor_films(spark, "/root/testdata/sf0.001").filter(F.col("actorid") < 40), ["actorid"], "year",
                            ["film", "votes", "rating", "filmid"], avg_col="rating", order_by=["filmid"], avg_out="average_rating", carry=["actor"])
    batch = cu.cumulate_range(roll, ["actorid"], period="year", start=1995, end=2001, carry=["actor"],
                              measure="average_rating")
    empty = spark.createDataFrame([], "actorid long, actor string, current_year int, films array<struct<film:string,"
                                      "votes:int,rating:double,filmid:bigint>>, quality_class string, "
                                      "is_active boolean")
    snaps, prev = [], empty
    for y in range(1995, 2002):
        cur = roll.filter(F.col("year") == y)
        prev = cu.cumulate(prev, cur, ["actorid"], carry=["actor"], measure="average_rating").checkpoint()
        snaps.append(prev)
    fold = snaps[0]
    for s in snaps[1:]:
        fold = fold.unionByName(s)

    def norm(df):
        return sorted((r.actorid, r.current_year, tuple(f.filmid for f in r.films), r.quality_class, r.is_active)
                      for r in df.select("actorid", "current_year", "films", "quality_class", "is_active").collect())
    assert norm(batch) == norm(fold)


def test_idle_counter_and_growth(spark):
    ps = spark.createDataFrame([(1, 2000, 0.0), (1, 2001, 12.0), (2, 2000, 10.0), (2, 2002, 25.0)],
                               "player_id int, season int, pts double")
    ps = ps.withColumn("current_items", F.array(F.struct("season", "pts")))
    snap = cu.cumulate_range(ps, ["player_id"], period="season", end=2002, out_period="current_season",
                             history="season_stats", measure="pts", class_col="scoring_class",
                             thresholds=cu.SCORING_CLASSES, idle_counter="years_since_last_season")
    rows = {(r.player_id, r.current_season): r for r in snap.collect()}
    assert rows[(1, 2002)].years_since_last_season == 1 and rows[(1, 2002)].scoring_class == "average"
    assert rows[(2, 2001)].years_since_last_season == 1 and rows[(2, 2002)].years_since_last_season == 0
    g = cu.growth_ratio(snap.filter("current_season = 2002"), "season_stats", "pts", ["player_id"], out="r")
    got = {r.player_id: r.r for r in g.collect()}
    assert got == {1: 12.0, 2: 2.5}                                       # 0 -> 1 guard (D13)


def test_unnest_variants(spark):
    df = spark.createDataFrame([(1, [(2000, 5.0), (2001, 7.0)])], "k int, a array<struct<season:int,pts:double>>")
    assert cu.unnest(df, "a", ["k"]).count() == 2
    assert [r.pts for r in cu.unnest(df, "a", ["k"], field="pts").collect()] == [5.0, 7.0]
    assert cu.unnest(df, "a", ["k"], expand=True).columns == ["k", "season", "pts"]
    first, last = cu.first_last(F.array().cast("array<int>"))
    assert spark.range(1).select(first, last).first() == (None, None)      # V4: no error


def _scd_input(spark, rows):
    return spark.createDataFrame(rows, "k string, y int, quality_class string, is_active boolean")


def test_scd2_backfill_fixtures(spark):
    df = _scd_input(spark, [("a", 2018, "star", True), ("a", 2019, "star", True), ("a", 2020, "good", True),
                            ("a", 2021, "good", False)])
    got = sorted(tuple(r) for r in scd.scd2_backfill(df, "k", "y", ["quality_class", "is_active"], as_of=2021)
                 .select("quality_class", "is_active", "start_date", "end_date").collect())
    assert got == [("good", False, 2021, 2021), ("good", True, 2020, 2020), ("star", True, 2018, 2019)]
    nulls = _scd_input(spark, [("a", 2018, "star", True), ("a", 2019, None, True), ("a", 2020, "star", True)])
    out = scd.scd2_backfill(nulls, "k", "y", ["quality_class", "is_active"], as_of=2020)
    assert out.count() == 3                                                # X3: NULL is a change


def test_scd2_merge_fixture(spark):
    hist = spark.createDataFrame(
        [("a", "star", True, 2020, 2024), ("b", "good", True, 2022, 2024), ("c", "bad", False, 2019, 2021),
         ("e", None, True, 2023, 2024), ("g", "good", True, 2024, 2024)],
        "k string, quality_class string, is_active boolean, start_date int, end_date int"
    ).withColumn("current_year", F.lit(2024))
    cur = spark.createDataFrame([("a", "star", True), ("b", "bad", True), ("d", "good", True), ("e", "star", True)],
                                "k string, quality_class string, is_active boolean")
    out = scd.scd2_merge(hist, cur, "k", ["quality_class", "is_active"], prev_as_of=2024, new_period=2025)
    got = sorted((r.k, r.quality_class or "", r.start_date, r.end_date) for r in out.collect())
    assert got == [("a", "star", 2020, 2025), ("b", "bad", 2025, 2025), ("b", "good", 2022, 2024),
                   ("c", "bad", 2019, 2021), ("d", "good", 2025, 2025), ("e", "", 2023, 2024),
                   ("e", "star", 2025, 2025), ("g", "good", 2024, 2024)]


def test_summary_form_equals_array_form(spark):
    """cumulate_range_summary (no arrays) gives the same counts, first/last
    items, class and activity as summarising cumulate_range's arrays."""
    from tributary.plans.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    a = QUERIES["dim_cumulative_snapshot"](spark, sf)
    b = QUERIES["dim_cumulative_summary"](spark, sf)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_summary_form_idle_counter_matches_seasons(spark):
    """The idle counter, points class and running games of the array-free
    form equal the season snapshot built with arrays (D6)."""
    from tributary.plans import derive as dv
    from tributary.plans.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    arrays = QUERIES["dim_cumulative_seasons"](spark, sf).select(
        "player_id", "current_season", "total_gp", "scoring_class", "years_since_last_season", "is_active")
    per = dv.player_seasons(spark, sf).withColumn("gp", F.col("gp").cast("long"))
    summ = cu.cumulate_range_summary(per, ["player_id"], period="season", start=1995, end=2001,
                                     out_period="current_season", measure="pts", class_col="scoring_class",
                                     thresholds=cu.SCORING_CLASSES, running_sums=["gp"],
                                     idle_counter="years_since_last_season")
    summ = summ.select("player_id", "current_season", F.col("gp").alias("total_gp"), "scoring_class",
                       "years_since_last_season", "is_active")
    assert sorted(map(tuple, arrays.collect())) == sorted(map(tuple, summ.collect()))


def test_null_keys_are_one_entity_in_steps(spark):
    """V7: a NULL key in the snapshot and in the new period is one entity."""
    prev = spark.createDataFrame([(None, 2020, [("f0", 1, 9.0, "f0")], "star", True)],
                                 "actorid string, current_year int, films array<struct<film:string,votes:int,rating:double,filmid:string>>, quality_class string, is_active boolean")
    cur = spark.createDataFrame([(None, 2021, [("f1", 1, 5.0, "f1")], 5.0)],
                                "actorid string, year int, current_items array<struct<film:string,votes:int,rating:double,filmid:string>>, average_value double")
    out = cu.cumulate(prev, cur, ["actorid"]).collect()
    assert len(out) == 1 and len(out[0].films) == 2 and out[0].is_active and out[0].quality_class == "bad"
    hist = spark.createDataFrame([(None, "star", True, 2020, 2020, 2020)],
                                 "k string, quality_class string, is_active boolean, start_date int, end_date int, current_year int")
    now = spark.createDataFrame([(None, "star", True)], "k string, quality_class string, is_active boolean")
    got = scd.scd2_merge(hist, now, "k", ["quality_class", "is_active"], prev_as_of=2020, new_period=2021).collect()
    assert [(r.k, r.start_date, r.end_date) for r in got] == [(None, 2020, 2021)]
