"""Experiments."""

from pyspark.sql import functions as F

from tributary import functions as fx
from tributary.operators import experiments as xp


def test_user_hash_matches_md5_prefix(spark):
    assert spark.range(1).select(fx.user_hash(F.lit("42"))).first()[0] == 2714814184


def test_assignment_is_stable_and_balanced(spark):
    users = spark.range(4000).withColumnRenamed("id", "user_id")
    a = xp.assign(users, "user_id", ["exp_a", "exp_b"])
    b = xp.assign(users, "user_id", ["exp_a", "exp_b"])
    assert a.exceptAll(b).count() == 0
    share = a.groupBy("experiment").agg(F.avg((F.col("cell") == "treatment").cast("double")).alias("s")).collect()
    assert all(0.45 < r.s < 0.55 for r in share)
    both = a.groupBy("user_id").agg(F.countDistinct("cell").alias("c")).filter("c = 2").count()
    assert 1500 < both < 2500                                  # experiments are salted independently


def test_cell_filter_parity(spark):
    df = spark.createDataFrame([(i, c) for i in range(4) for c in ("Red", "Blue")], "id int, cell string")
    got = sorted((r.id, r.cell) for r in xp.cell_filter(df, "id").collect())
    assert got == [(0, "Red"), (1, "Blue"), (2, "Red"), (3, "Blue")]


def test_compare_cells_detects_shift(spark):
    rows = [("e", "control", float(i % 10)) for i in range(2000)] + \
           [("e", "treatment", float(i % 10) + 1.0) for i in range(2000)]
    r = xp.compare_cells(spark.createDataFrame(rows, "experiment string, cell string, v double"), "v").first()
    assert r.t_stat > 10 and r.p_value < 1e-4
    same = [("e", c, float(i % 10)) for c in ("control", "treatment") for i in range(2000)]
    r2 = xp.compare_cells(spark.createDataFrame(same, "experiment string, cell string, v double"), "v").first()
    assert r2.t_stat == 0.0 and r2.p_value == 1.0


def test_cell_metrics_quantiles(spark):
    import datetime as dt
    exp = spark.createDataFrame([("e", 1, "control", dt.datetime(2024, 1, 1))],
                                "experiment string, user_id long, cell string, exposure_ts timestamp_ntz")
    facts = spark.createDataFrame([(1, "m", float(v), dt.datetime(2024, 1, 2)) for v in range(1, 101)],
                                  "user_id long, metric string, value double, ts timestamp_ntz")
    r = xp.cell_metrics(exp, facts, value_cents=F.round(F.col("value") * 100).cast("long"),
                        quantiles=[0.5, 0.9]).first()
    assert r.n == 100 and r.mean == 50.5 and r.p50 == 50.0 and r.p90 == 90.0


def test_tails_equal_closed_forms(spark):
    """Student's t against the closed forms for 1 to 4 degrees of freedom and the
    normal tail against erfc, all within 1e-9; many degrees approach the normal."""
    import math

    from tributary.functions.statistics import incomplete_beta, log_gamma, normal_two_sided, student_two_sided
    ts = [0.0, 1e-6, 0.1, -0.5, 1.0, 1.96, -2.5, 4.0, 12.7, 63.66, 1000.0]
    df = spark.createDataFrame([(t, float(v)) for t in ts for v in (1, 2, 3, 4)], "t double, v double")

    def exact(t, v):
        t = abs(t)
        a = math.atan(t / math.sqrt(v))
        s, c = math.sin(a), math.cos(a)
        return 1 - {1: 2 * a / math.pi, 2: s, 3: 2 / math.pi * (a + s * c), 4: s * (1 + c * c / 2)}[int(v)]
    for r in df.select("t", "v", student_two_sided(F.col("t"), F.col("v")).alias("p")).collect():
        assert abs(r.p - exact(r.t, r.v)) < 1e-9, r
    z = spark.createDataFrame([(x,) for x in (0.0, 1e-9, 0.3, -1.0, 1.959963984540054, 3.0, -5.5, 7.9, 20.0, None)], "z double")
    for r in z.select("z", normal_two_sided(F.col("z")).alias("p"), student_two_sided(F.col("z"), F.lit(1e7)).alias("q")).collect():
        if r.z is None:
            assert r.p is None and r.q is None
        else:
            assert abs(r.p - math.erfc(abs(r.z) / math.sqrt(2))) < 1e-12 and abs(r.p - r.q) < 1e-6, r
    # a fixed reference: two-sided 5 % and 1 % points of t with 5, 10 and 30 degrees
    ref = spark.createDataFrame([(2.570581835636314, 5.0, 0.05), (4.032142983557536, 5.0, 0.01), (2.2281388519649385, 10.0, 0.05), (3.169272667175838, 10.0, 0.01), (2.0422724563012373, 30.0, 0.05)], "t double, v double, p double")
    assert all(abs(r.got - r.p) < 1e-9 for r in ref.select("p", student_two_sided(F.col("t"), F.col("v")).alias("got")).collect())
    g = spark.createDataFrame([(x,) for x in (0.25, 0.5, 1.0, 2.0, 7.5, 400.0)], "x double").select("x", log_gamma(F.col("x")).alias("g")).collect()
    assert all(abs(r.g - math.lgamma(r.x)) < 1e-11 * max(1, abs(r.g)) for r in g)
    assert spark.range(1).select(incomplete_beta(F.lit(0.0), F.lit(2.0), F.lit(3.0)), incomplete_beta(F.lit(1.0), F.lit(2.0), F.lit(3.0))).first()[:] == (0.0, 1.0)


def test_exposure_waits_for_the_launch(spark):
    import datetime as dt
    at = lambda d: dt.datetime(2024, 1, d)
    ev = spark.createDataFrame([(1, at(2)), (1, at(6)), (1, at(9)), (2, at(3))], "user_id long, ts timestamp_ntz")
    got = {(r.experiment, r.user_id, r.exposure_ts.day) for r in xp.assign(ev, "user_id", ["a", "b"], ts="ts", launches={"a": "2024-01-05"}).collect()}
    assert got == {("a", 1, 6), ("b", 1, 2), ("b", 2, 3)}


def test_cell_of_equals_the_assignment(spark):
    users = spark.range(500).withColumnRenamed("id", "user_id")
    a = xp.assign(users, "user_id", ["e1"], xp.COLOR_CELLS)
    assert a.filter(F.col("cell") != xp.cell_of("user_id", "e1", xp.COLOR_CELLS)).count() == 0


def _events(seed, n, users=12):
    import datetime as dt
    import random
    rnd = random.Random(seed)
    hot = lambda: 0 if rnd.random() < 0.4 else rnd.randrange(users)
    return [(i, hot(), rnd.choice(["view", "purchase", "other"]), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(3000)), rnd.choice([None, float(rnd.randrange(8))])) for i in range(n)]


def test_time_to_find_equals_brute_force_at_any_partitioning(spark):
    rows = _events(5, 800)
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp_ntz, value double").repartition(4)
    want = {}
    for u in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == u), key=lambda r: (r[3], r[0]))
        n = found = micros = 0
        for i, r in enumerate(own):
            if r[2] == "view":
                n += 1
                nxt = next((x for x in own[i + 1:] if x[2] == "purchase"), None)
                if nxt:
                    found, micros = found + 1, micros + int((nxt[3] - r[3]).total_seconds() * 1_000_000)
        want[u] = (n, found, micros)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for parts in (1, 5, 60):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {r.user_id: (r.n_starts, r.n_found, r.micros) for r in xp.time_to_find(df, F.col("event_type") == "view", F.col("event_type") == "purchase").collect()}
            assert got == want, parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_metrics_by_cell_equal_the_long_join(spark):
    rows = _events(9, 900, users=40)
    ev = spark.createDataFrame(rows, "event_id long, user_id long, metric string, ts timestamp_ntz, value double")
    cents, launches = F.round(F.col("value") * 100).cast("long"), {"e1": "2024-01-01 20:00:00"}
    got = xp.metrics_by_cell(ev, ["e1", "e2"], value_cents=cents, launches=launches)
    ex = xp.assign(ev, "user_id", ["e1", "e2"], ts="ts", launches=launches)
    j = ex.join(ev, "user_id").filter("ts >= exposure_ts")
    want = j.groupBy("experiment", "cell", "metric").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 3).alias("m"), F.round(F.stddev_samp("value"), 4).alias("sd"), F.min("value"), F.max("value"))
    norm = lambda df: sorted(tuple(round(v, 3) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert norm(got) == norm(want) and got.count() > 8


def test_adoption_is_the_product_limit(spark):
    import datetime as dt
    day = lambda d: dt.datetime(2024, 1, d, 12)
    ex = spark.createDataFrame([("e", u, "c", day(1 + u % 3)) for u in range(12)], "experiment string, user_id long, cell string, exposure_ts timestamp_ntz")
    goals = {0: 1, 1: 2, 2: 9, 3: 4, 4: 4, 5: 8}
    ev = spark.createDataFrame([(u, "g", day(d)) for u, d in goals.items()] + [(3, "g", day(9)), (7, "g", dt.datetime(2024, 1, 1))], "user_id long, kind string, ts timestamp_ntz")
    got = xp.adoption(ex, ev, F.col("kind") == "g", last_day="2024-01-20").orderBy("day").collect()
    times = [(goals[u] - (1 + u % 3), True) if u in goals else (20 - (1 + u % 3), False) for u in range(12)]
    stay = 1.0
    for r in got:
        risk, hit = sum(t >= r.day for t, _ in times), sum(t == r.day and a for t, a in times)
        stay *= 1 - hit / risk
        assert (r.at_risk, r.n_adopted) == (risk, hit) and abs(r.adopted - (1 - stay)) < 1e-6
    assert sum(r.n_adopted + r.n_censored for r in got) == 12


def test_rank_sum_equals_pairs(spark):
    """Against all pairs, with ties, at several numbers of segments."""
    import random
    rnd = random.Random(3)
    rows = [(e, rnd.choice(["control", "treatment"]), rnd.choice([None, float(rnd.randrange(30)), rnd.random() * 30])) for e in ("a", "b") for _ in range(300)]
    df = spark.createDataFrame(rows, "experiment string, cell string, v double").repartition(3)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for parts in (1, 7, 50):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for r in xp.rank_sum(df, "v").collect():
                c, t = ([x[2] for x in rows if x[0] == r.experiment and x[1] == k and x[2] is not None] for k in ("control", "treatment"))
                u = sum((y > x) + 0.5 * (y == x) for x in c for y in t)
                assert (r.n_c, r.n_t, r.u_stat) == (len(c), len(t), u) and abs(r.prob_higher - u / len(c) / len(t)) < 1e-6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    same = spark.createDataFrame([("e", k, 1.0) for k in ("control", "treatment")] * 5, "experiment string, cell string, v double")
    assert xp.rank_sum(same, "v").first().p_value is None              # no spread, no test


def test_two_proportion_known_case(spark):
    r = xp.two_proportion(spark.createDataFrame([("e", "control", 200, 40), ("e", "treatment", 300, 90)], "experiment string, cell string, n_users long, n_converted long")).first()
    import math
    z = 0.1 / math.sqrt(0.26 * 0.74 * (1 / 200 + 1 / 300))
    assert abs(r.z_stat - z) < 1e-6 and abs(r.p_value - math.erfc(z / math.sqrt(2))) < 1e-6
    assert xp.two_proportion(spark.createDataFrame([("e", "control", 20, 20), ("e", "treatment", 30, 30)], "experiment string, cell string, n_users long, n_converted long")).first().p_value is None
