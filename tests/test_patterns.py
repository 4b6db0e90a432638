"""Analytical patterns (A1-A8): fixtures, and the chunked operators against a
plain per-key window on random data."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary.operators import patterns as pt


def test_state_change_labels(spark):
    df = spark.createDataFrame([("p", 2000 + i, a) for i, a in enumerate([True, True, False, False, True])],
                               "k string, y int, active boolean")
    got = [r.state for r in pt.state_change(df, "k", "y", "active").orderBy("y").collect()]
    assert got == ["New", "Continued Playing", "Retired", "Stayed Retired", "Returned from Retirement"]


def test_team_wins_counts_games_not_player_rows(spark):
    games = spark.createDataFrame([(1, dt.date(2020, 1, 1), 7, 8, 1), (2, dt.date(2020, 1, 2), 9, 7, 0)],
                                  "game_id long, game_date_est date, home_team_id long, visitor_team_id long, "
                                  "home_team_wins int")
    top = pt.top_n(pt.game_sides(games), ["team_id"], F.sum("win"), 1, out="wins").first()
    assert (top.team_id, top.wins) == (7, 2)


def test_longest_streak_fixture(spark):
    pts = [12, 15, 8, 20, 30, 11]
    df = spark.createDataFrame([("p", i, float(v)) for i, v in enumerate(pts)], "k string, g int, pts double")
    got = pt.longest_streak(df, "k", ["g"], F.col("pts") > 10, bucket=F.floor(F.col("g") / 2)).first()
    assert got.longest_streak == 3                                        # X19: not 5


def _random_rows(n_keys=4, n=400, seed=7):
    rnd = random.Random(seed)
    return [(rnd.randrange(n_keys), i, rnd.randrange(50), rnd.random() < 0.6) for i in range(n)]


def test_rolling_rows_matches_plain_window(spark):
    rows = _random_rows()
    df = spark.createDataFrame(rows, "k int, o int, v int, c boolean")
    for n, width in [(5, 3), (20, 7), (90, 11), (1, 5)]:
        got = pt.rolling_rows(df, "k", ["o"], "v", n, bucket=F.floor(F.col("o") / width), out="r")
        want = df.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("o").rowsBetween(-(n - 1), 0)))
        assert sorted(tuple(r) for r in got.select("k", "o", "r").collect()) == \
            sorted(tuple(r) for r in want.select("k", "o", "r").collect())


def _brute_streak(rows):
    best, cur, out = {}, {}, {}
    for k, o, v, c in sorted(rows, key=lambda r: (r[0], r[1])):
        cur[k] = cur.get(k, 0) + 1 if c else 0
        best[k] = max(best.get(k, 0), cur[k])
    return best


def test_longest_streak_matches_brute_force(spark):
    for seed, width in [(1, 3), (2, 17), (3, 1), (4, 1000)]:
        rows = _random_rows(seed=seed)
        df = spark.createDataFrame(rows, "k int, o int, v int, c boolean")
        got = {r.k: r.longest_streak for r in
               pt.longest_streak(df, "k", ["o"], F.col("c"), bucket=F.floor(F.col("o") / width)).collect()}
        assert got == _brute_streak(rows)


def test_grouping_sets_ids(spark):
    df = spark.createDataFrame([(1, 10, 2000, 3.0), (1, 10, 2001, 4.0), (2, 10, 2000, 5.0)],
                               "player_id int, team_id int, season int, pts double")
    g = pt.grouping_sets(df, [["player_id", "team_id"], ["player_id", "season"], ["team_id"]],
                         [F.sum("pts").alias("total")])
    rows = {(r.player_id, r.team_id, r.season, r.gid): r.total for r in g.collect()}
    assert rows[(1, 10, None, 1)] == 7.0 and rows[(None, 10, None, 5)] == 12.0 and rows[(1, None, 2000, 2)] == 3.0


def test_best_stretch_and_streak_equal_brute_force_over_segments(spark):
    """A hot key with most rows, negative values, keys shorter than the stretch;
    any number of segments."""
    rnd = random.Random(9)
    rows = [(rnd.choice(["hot"] * 6 + ["b", "c", None]), i, rnd.choice([0, 1, 1, -2]), rnd.choice([True, True, True, False, None])) for i in range(900)]
    rows += [("short", i, -1, True) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, o int, v int, c boolean").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for parts in (1, 4, 60):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for n in (1, 2, 7, 90, 2000):
                want = {}
                for k in {r[0] for r in rows}:
                    v = [r[2] for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1])]
                    want[k] = max(sum(v[max(0, i - n + 1):i + 1]) for i in range(len(v)))
                assert {r.k: r.m for r in pt.best_stretch(df, n, key="k", order=["o"], value="v", out="m").collect()} == want, (parts, n)
            want = {}
            for k in {r[0] for r in rows}:
                run = best = 0
                for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
                    run = run + 1 if r[3] else 0
                    best = max(best, run)
                want[k] = best
            assert {r.k: r.longest_streak for r in pt.longest_streak(df, "k", ["o"], F.col("c")).collect()} == want, parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
