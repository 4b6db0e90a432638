import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tributary.llm import mixing as mx
from tributary.llm import sharding as sh
from tributary.llm.queries import QUERIES, mixing_sql, sharding_sql

SF = "/root/testdata/sf0.01"


def oracle(sql, docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in con.sql(sql).fetchall())


def rows(df):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """One source with two fifths of all rows."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    return d.withColumn("source", F.when(F.col("doc_id") % 5 < 2, "hot").otherwise(F.col("source"))).cache()


@pytest.mark.parametrize("limit", [1 << 14, 1 << 17, 1 << 20, 1 << 26])
def test_shards_equal_the_sql(spark, limit):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sh.shard(docs, limit=limit).select("doc_id", "_shard.name", "_shard.depth", "_shard.bytes")
    assert rows(got) == oracle(sharding_sql(limit), docs)


def test_every_shard_fits_and_only_full_buckets_split(spark):
    docs, limit = spark.read.parquet(f"{SF}/documents.parquet"), 1 << 16
    got = sh.shard(docs, limit=limit).select("_shard.*").collect()
    size, n = Counter(), Counter()
    for r in got:
        size[r.name] += r.bytes
        n[r.name] += 1
    assert all(b <= limit or n[k] == 1 for k, b in size.items()) and len(got) == docs.count()
    whole = Counter()
    for r in got:
        for d in range(r.depth):
            whole[r.name[:d]] += r.bytes
    assert all(b > limit for b in whole.values())                  # every inner bucket was too large


def test_repeated_ids_go_to_overflow_pages(spark):
    docs = spark.createDataFrame([(7, "x" * 900)] * 40 + [(7, "y" * 3000)] * 3 + [(7, "z" * 9000)] + [(i, "a b") for i in range(50)], "doc_id long, text string")
    size, n = Counter(), Counter()
    for r in sh.shard(docs, limit=4096).select("_shard.*").collect():
        size[r.name] += r.bytes
        n[r.name] += 1
    assert sum(n.values()) == 94 and all(b <= 4096 or n[k] == 1 for k, b in size.items())
    assert any("+" in k for k in size) and sum("-" in k for k in size) == 4


def test_deep_buckets_open_in_rounds(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "t" * 100) for i in range(3000)], "doc_id long, text string")
    whole = rows(sh.shard(docs, limit=200).select("doc_id", "_shard.name"))
    monkeypatch.setattr(sh.math, "ceil", lambda x: -2)               # three bits a round
    assert rows(sh.shard(docs, limit=200).select("doc_id", "_shard.name")) == whole


@pytest.mark.parametrize("repeat", [1.5, 2.0, 4.0])
def test_mixture_equals_the_sql(skewed, repeat):
    got = mx.realise(skewed.select("doc_id", "source", "text"), max_repeat=repeat, block_tokens=5000, slice_rows=20)
    got = got.select("doc_id", "source", "_mix.epoch", "_mix.block", "_mix.place", "_mix.tokens", F.round("_mix.weight", 9))
    assert rows(got) == oracle(mixing_sql(repeat, 5000), skewed.select("doc_id", "source", "text"))


def test_first_epoch_keeps_every_document(spark):
    big = spark.range(300).selectExpr("id as doc_id", "'hot' as source", "repeat('w ', 20000) as text")        # six million tokens
    last = spark.range(300, 2300).selectExpr("id as doc_id", "'hot' as source", "if(id % 2 = 0, 'one', null) as text")
    few = spark.range(5000, 5040).selectExpr("id as doc_id", "'few' as source", "if(id % 2 = 0, 'a b c', '') as text")
    docs = big.union(last).union(few)
    got = mx.realise(docs, max_repeat=2.0).select("doc_id", "source", "_mix.epoch").collect()
    assert Counter(r.doc_id for r in got if r.epoch == 1) == Counter(r.doc_id for r in docs.collect())
    assert Counter((r.source, r.epoch) for r in got) == {("hot", 1): 2300, ("few", 1): 40, ("few", 2): 40}


def test_weights_meet_their_targets(skewed):
    narrow = skewed.select("source", mx.tokens(F.col("text")).alias("tokens"))
    per = mx.source_tokens(narrow)
    p = {r.source: r.p for r in per.collect()}
    a = mx.exponent(per, max_repeat=2.0)
    assert max(v ** (a - 1) for v in p.values()) / min(v ** (a - 1) for v in p.values()) == pytest.approx(2.0)
    for target in (0.9, 0.97):
        a = mx.exponent(per, entropy_share=target)
        z = sum(v ** a for v in p.values())
        h = -sum(v ** a / z * math.log(v ** a / z) for v in p.values()) / math.log(len(p))
        assert h == pytest.approx(target, abs=1e-9) or (a == 1.0 and h >= target)
    assert mx.exponent(per) == 1.0 and mx.exponent(per, max_repeat=1e9) == 0.0


def test_no_document_is_lost_and_quotas_hold(skewed):
    out = mx.realise(skewed, max_repeat=3.0)
    got = out.select("doc_id", "source", "_mix.*").collect()
    assert {r.doc_id for r in got} == {r.doc_id for r in skewed.select("doc_id").collect()}
    once = Counter((r.doc_id, r.epoch) for r in got)
    assert max(once.values()) == 1 and out.drop("_mix").columns == skewed.columns
    total, weight = Counter(), {}
    for r in got:
        total[r.source] += r.tokens
        weight[r.source] = r.weight
    every = sum(total.values())
    assert all(abs(total[s] / every - w) < 0.02 for s, w in weight.items())
    small = mx.realise(skewed, max_repeat=3.0, budget=20_000)
    assert abs(sum(r.t for r in small.select(F.col("_mix.tokens").alias("t")).collect()) - 20_000) < 20 * 4000


def test_blocks_hold_each_source_in_its_weight(skewed):
    got = mx.realise(skewed, max_repeat=2.0, block_tokens=40_000).select("source", "_mix.*").collect()
    block = defaultdict(Counter)
    for r in got:
        block[r.block][r.source] += r.tokens
    full = [b for b in sorted(block)][:-2]
    w = {r.source: r.weight for r in got}
    assert full and all(abs(block[b]["hot"] / sum(block[b].values()) - w["hot"]) < 0.1 for b in full)


def test_odd_and_empty_tables(odd_docs, empty_docs):
    out = mx.realise(odd_docs)
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in odd_docs.collect()} and mx.realise(empty_docs).count() == 0
    assert out.filter("doc_id = 5").count() % 2 == 0
    s = sh.shard(odd_docs, limit=1 << 16)
    assert s.count() == odd_docs.count() and sh.shard(empty_docs).count() == 0 and s.drop("_shard").columns != []
    assert "op1_extendible_shards" in QUERIES
