"""One query per operator, over its whole table with production parameters,
and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (conversation_repair, decontaminate, divergence, lm_score, mixing, near_dedup, pii, quality, secrets, sharding, substring_dedup, toxicity,
                           url_filter)

#: Bytes of text in a shard, as is usual for training shards.
SHARD_BYTES = 64 << 20
#: Times a scarce source is repeated at most.
MAX_REPEAT = 2.0
# The url rules (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), limit=SHARD_BYTES)
    return rows.select("doc_id", F.col("_shard.name").alias("shard"), F.col("_shard.depth").alias("depth"), F.col("_shard.bytes").alias("n_bytes"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.realise(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), max_repeat=MAX_REPEAT)
    return rows.select("doc_id", "source", F.col("_mix.epoch").alias("epoch"), F.col("_mix.block").alias("block"), F.col("_mix.place").alias("place"), F.col("_mix.tokens").alias("tokens"), F.round("_mix.weight", 9).alias("weight"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.train(secrets.labelled_findings(spark)))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"), damaged=True)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extendible_shards": op1, "op2_toxic_lexicon": op2, "op3_dart_minhash": op3, "op4_benchmark_alignment": op4, "op5_quality_ratio": op5,
    "op6_context_tree": op6, "op7_temperature_mix": op7, "op8_pii_crf": op8, "op9_secret_forest": op9, "op10_link_trust": op10,
    "op11_quadtree_divergence": op11, "op12_integer_repair": op12, "op13_sketch_substrings": op13,
}


def sharding_sql(limit: int = SHARD_BYTES) -> str:
    """Smallest prefix whose bytes fit, for every document (no overflow pages)."""
    return f"""
WITH keyed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15))::BIGINT AS h
  FROM documents),
levels AS (SELECT k.*, d.depth, h >> (60 - d.depth) AS prefix FROM keyed k, (SELECT unnest(range(0, 41)) AS depth) d),
buckets AS (
  SELECT depth, prefix FROM levels GROUP BY depth, prefix
  HAVING sum(n_bytes) <= {limit} OR min(h) = max(h)),
placed AS (
  SELECT l.doc_id, l.h, l.n_bytes, l.prefix, CAST(l.depth AS INTEGER) AS depth,
         row_number() OVER (PARTITION BY l.doc_id, l.h ORDER BY l.depth) AS nth
  FROM levels l JOIN buckets b ON l.depth = b.depth AND l.prefix = b.prefix)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 60, '0'), depth) END AS shard, depth, n_bytes
FROM placed WHERE nth = 1"""


def mixing_sql(max_repeat: float = MAX_REPEAT, block_tokens: int = 1 << 20, seed: int = 11) -> str:
    """The exponent in closed form: the largest repetition is (p_max / p_min) ** (1 - a)."""
    return f"""
WITH counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
shares AS (
  SELECT source, sum(tokens) AS total, sum(tokens) / (SELECT sum(tokens) FROM counted) AS p FROM counted GROUP BY source),
warm AS (
  SELECT CASE WHEN max(p) / min(p) <= {max_repeat} THEN 0.0 ELSE 1 - ln({max_repeat}) / ln(max(p) / min(p)) END AS a FROM shares WHERE p > 0),
scaled AS (
  SELECT source, total, CASE WHEN p > 0 THEN pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, warm WHERE p > 0) ELSE 0 END AS w FROM shares, warm),
quota AS (
  SELECT source, total, w, w * (SELECT coalesce(max(total / w), 0) FROM scaled WHERE w > 0) AS tokens_due FROM scaled),
drawn AS (
  SELECT c.*, q.total, q.w, q.tokens_due, e.epoch,
         substr(md5('{seed}:' || e.epoch || ':' || coalesce(CAST(c.doc_id AS VARCHAR), '')), 1, 15) AS place
  FROM counted c JOIN quota q ON c.source IS NOT DISTINCT FROM q.source, (SELECT unnest(range(1, 1 + CAST(ceil({max_repeat}) AS BIGINT))) AS epoch) e
  WHERE e.epoch = 1 OR (q.total > 0 AND e.epoch <= ceil((q.tokens_due - {mixing.SUB_TOKEN}) / q.total))),
placed AS (
  SELECT *, (epoch - 1) * total + coalesce(sum(tokens) OVER (
      PARTITION BY source, epoch ORDER BY place, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM drawn)
SELECT doc_id, source, CAST(epoch AS INTEGER) AS epoch, CAST(CASE WHEN w > 0 THEN floor(begins / (w * {block_tokens})) ELSE 0 END AS BIGINT) AS block, place,
       CAST(tokens AS BIGINT) AS tokens, round(w, 9) AS weight
FROM placed
WHERE epoch = 1 OR tokens = 0 OR epoch * total <= tokens_due + {mixing.SUB_TOKEN} OR begins < tokens_due - {mixing.SUB_TOKEN}"""


ORACLE: dict[str, str] = {
    "op1_extendible_shards": sharding_sql(), "op7_temperature_mix": mixing_sql(), "op11_quadtree_divergence": divergence.audit_sql(),
    "op12_integer_repair": conversation_repair.repair_sql(), "op13_sketch_substrings": substring_dedup.digests_sql(),
}
