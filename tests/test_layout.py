"""Joins and layout (S1-S12, M13): fixtures, plan assertions, salted join."""

import os

from pyspark.sql import functions as F

from tributary.operators import joins as jn
from tributary.sources import layout as ly

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_avg_kills_counts_each_game_once(spark):
    rows = spark.createDataFrame([(1, "p", 10, m) for m in ("a", "b", "c")] + [(2, "p", 20, "a")],
                                 "match_id int, player string, kills long, medal string")
    got = jn.avg_per_game(rows, "match_id", "player", "kills", out="avg").first()
    assert (got.n_games, got.avg) == (2, 15.0)


def test_top_value_counts_matches(spark):
    rows = spark.createDataFrame([("A", 1)] * 3 + [("B", 2), ("B", 3)], "playlist string, match_id int")
    top = jn.top_value(rows, "playlist", distinct_of="match_id").first()
    assert (top.playlist, top.n) == ("B", 2)
    assert jn.top_value(rows, "playlist").first().playlist == "A"          # joined-row count option


def test_lookup_join_follows_the_byte_threshold(spark):
    fact = spark.read.parquet(f"{SF}/orders.parquet").withColumn("mapid", (F.col("o_custkey") % 25).cast("int"))
    dim = spark.read.parquet(f"{SF}/nation.parquet").withColumnRenamed("n_nationkey", "mapid")
    assert "BroadcastHashJoin" in _plan(jn.lookup_join(fact, dim, "mapid"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        assert "BroadcastHashJoin" not in _plan(jn.lookup_join(fact, dim, "mapid"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_salted_join_equals_plain_join(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("l_orderkey")).alias("k"),
        "l_quantity", "l_linenumber")
    o = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    salted = jn.salted_join(li, o, ["k"], salts=8, min_rows=100)
    plain = li.join(o, "k")
    cols = ["k", "l_quantity", "l_linenumber", "o_orderpriority"]
    assert sorted(map(tuple, salted.select(cols).collect())) == sorted(map(tuple, plain.select(cols).collect()))


def test_bucketed_three_way_join_has_no_exchange(spark):
    from tributary.plans import derive as dv
    ly.disable_auto_broadcast(spark)
    try:
        m = ly.write_bucketed(dv.matches(spark, SF), "t_matches_b", "match_id", 16)
        d = ly.write_bucketed(dv.match_details(spark, SF), "t_details_b", "match_id", 16)
        p = ly.write_bucketed(dv.medals_matches_players(spark, SF), "t_medals_b", "match_id", 16)
        with jn.co_partitioned(spark):
            j = jn.bucket_join(m, d, p)
            plan = _plan(j)
            n = j.count()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert n == dv.medals_matches_players(spark, SF).count()
        sizes = ly.table_bytes(spark.table("t_matches_b")).first()
        assert sizes.files >= 16 and sizes.bytes > 0
        v2 = ly.write_bucketed(dv.matches(spark, SF), "t_matches_b2", "match_id", 16,
                               sort_cols=["playlist_id", "match_id"])
        assert v2.count() == m.count()
        sizes = {r.table_name: (r.files, r.bytes) for r in ly.layout_sizes(spark, ["t_matches_b", "t_matches_b2"]).collect()}
        assert set(sizes) == {"t_matches_b", "t_matches_b2"} and all(b > 0 for _, b in sizes.values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_round_trip(spark, scratch):
    path = os.path.join(scratch, "maps_csv")
    spark.read.parquet(f"{SF}/nation.parquet").write.option("header", True).csv(path)
    inferred = ly.read_csv(spark, path)
    declared = ly.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    assert inferred.count() == declared.count() == 25
    assert dict(inferred.dtypes)["n_nationkey"] == "int"


def test_scan_prunes_columns_and_pushes_filters(spark):
    from tributary.plans.queries import QUERIES
    plan = QUERIES["ops_gap_detection"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_registered_bucket_join_reads_buckets_without_exchange(spark):
    """The query writes three external tables in the shared folder; the join it
    returns has no exchange, one number of buckets and one file each."""
    from tributary.plans.queries import QUERIES
    df = QUERIES["layout_bucket_join"](spark, SF)
    plan = _plan(df)
    assert "Exchange" not in plan and "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2 and "SelectedBucketsCount" in plan
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "true"
    from tributary.plans import derive as dv
    want = jn.bucket_join(dv.matches(spark, SF), dv.match_details(spark, SF), dv.medals_matches_players(spark, SF)).select(df.columns)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    files = spark.table([t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_") and t.name.endswith("_medals")][-1])
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared in files.select("_metadata.file_path").first()[0] and ly.table_bytes(files).first().files == spark.sparkContext.defaultParallelism


def test_bucket_count_follows_the_bytes(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert ly.bucket_count([df], least=1) == 1 and ly.bucket_count([df, df.limit(1)], bucket_bytes=size // 40, least=8) in (40, 41)


def test_sort_layouts_hold_the_same_rows(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey")
    out = {r.layout: r for r in ly.sort_layouts(df, "l_orderkey", {"a": ["l_orderkey"], "b": ["l_suppkey", "l_partkey"]}, buckets=5).collect()}
    assert {r.n_rows for r in out.values()} == {df.count()} and {r.n_files for r in out.values()} == {5} and all(r.n_bytes > 0 for r in out.values())


def test_medals_only_select_pairs(spark):
    """Semi join of the medal rows equals the distinct pairs of the full join."""
    from tributary.plans import derive as dv
    m, d, p = dv.matches(spark, SF), dv.match_details(spark, SF), dv.medals_matches_players(spark, SF).filter("medal_id % 3 = 0")
    cols = ["match_id", "player_gamertag", "player_total_kills", "mapid"]
    got = jn.rows_with_medal(m, d, p).select(cols)
    want = jn.bucket_join(m, d, p).select(cols).distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_cluster_session_must_name_the_shared_folder(monkeypatch):
    import pytest
    from tributary.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_heavy_keys_come_from_a_sketch(spark):
    """All keys above the threshold are named, few others; the only exchange is
    the one of the sketches (a single row a task), not of the keys."""
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, 7, if(id % 11 = 0, null, id)) as k", "id as v")
    hot = jn.hot_keys(df, ["k"], 10_000)
    want = {r[0] for r in df.groupBy("k").count().filter("count >= 10000").select(F.xxhash64("k")).collect()}
    assert {r[0] for r in hot.collect()} == want and len(want) == 2
    plan = _plan(hot).split("Initial Plan")[-1]
    assert "hashpartitioning" not in plan
    small = spark.createDataFrame([(7, "a"), (8, "b"), (None, "c")], "k long, name string")
    cols = ["k", "v", "name"]
    for how in ("inner", "left"):
        got, plain = jn.salted_join(df, small, ["k"], how=how, min_rows=10_000, salts=5), df.join(small, "k", how)
        assert got.select(cols).exceptAll(plain.select(cols)).count() == 0 and got.count() == plain.count()
