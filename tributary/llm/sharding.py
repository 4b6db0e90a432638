"""Sharding by extendible hashing.

A document's key hashes to 60 bits.  A bucket is a prefix of those bits; the
directory starts as one bucket, and only a bucket above the byte limit splits on
its next bit, until every bucket fits or holds one hash alone.  Bytes are summed
per cell (prefix of ``bits`` bits, more than enough for an even hash) in one
aggregation, buckets are found on the cells, and each cell points to its bucket
as an entry of the directory does.  Cells that are still too large are opened
further, round by round, without touching the others.

A bucket of one hash (repeated ids) cannot split; its rows go to overflow pages,
as in the textbook scheme: rows above half the limit get a page each, the others
fill pages of half the limit by running bytes, counted per partition of a
checkpointed frame first, so that no task holds the bucket.  A page then fits
the limit unless a single document is larger, which no sharding can split.

Defined results: null and empty texts have 0 bytes; a null id hashes the text
instead (null: ''); repeated rows go to overflow pages only where their bucket
is too large; extra columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import cut, free

BITS = 60


def key_hash(id_col: str, text: str) -> Column:
    """First 60 bits of the md5 of the id as text (null: of the text)."""
    key = F.coalesce(F.col(id_col).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def open_cells(keys: DataFrame, root: int, bits: int, limit: int) -> DataFrame:
    """Directory of the keys (h, bytes) below buckets of ``root`` bits:
    (cell, bucket, depth, fits).  ``bucket`` is null where a cell is too large."""
    deep = root + bits
    cells = keys.groupBy(F.shiftright("h", BITS - deep).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.min("h").alias("low"), F.max("h").alias("high"))
    up = cells.select(F.explode(F.sequence(F.lit(root), F.lit(deep))).alias("depth"), "cell", "bytes", "low", "high")
    prefix = F.expr(f"shiftright(cell, {deep} - depth)")
    nodes = up.groupBy("depth", prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high"))
    nodes = nodes.select("depth", "prefix", ((F.col("bytes") <= limit) | (F.col("low") == F.col("high"))).alias("fits"))
    above = nodes.filter("fits").select((F.col("depth") + 1).alias("depth"), F.explode(F.expr("array(prefix * 2, prefix * 2 + 1)")).alias("prefix"))
    leaves = nodes.filter("fits").join(above, ["depth", "prefix"], "left_anti")
    # each cell under a leaf; a leaf's cells are its directory entries
    entries = leaves.select("depth", "prefix", F.explode(F.expr(f"sequence(shiftleft(prefix, {deep} - depth), shiftleft(prefix + 1, {deep} - depth) - 1)")).alias("cell"))
    return cells.select("cell").join(entries, "cell", "left").select("cell", F.col("prefix").alias("bucket"), "depth")


def paged(rows: DataFrame, limit: int) -> DataFrame:
    """Rows (bucket, depth, bytes, ...) of one-hash buckets with their page."""
    rows = cut(rows)                               # fixed partitions: places in them are stable from here on
    rows = rows.withColumn("_part", F.spark_partition_id()).withColumn("_nth", F.monotonically_increasing_id())
    small = F.col("bytes") <= limit // 2
    rows = rows.withColumn("_small", F.when(small, F.col("bytes")).otherwise(0)).withColumn("_large", F.when(small, 0).otherwise(1))
    per = rows.groupBy("depth", "bucket", "_part").agg(F.sum("_small").alias("s"), F.sum("_large").alias("l"))
    over = Window.partitionBy("depth", "bucket").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("depth", "bucket", "_part", F.coalesce(F.sum("s").over(over), F.lit(0)).alias("_s"), F.coalesce(F.sum("l").over(over), F.lit(0)).alias("_l"))
    inside = Window.partitionBy("depth", "bucket", "_part").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(per, ["depth", "bucket", "_part"])
    fill = F.floor((F.col("_s") + F.coalesce(F.sum("_small").over(inside), F.lit(0))) / max(1, limit // 2))
    own = -1 - F.col("_l") - F.coalesce(F.sum("_large").over(inside), F.lit(0))
    return rows.withColumn("page", F.when(F.col("_large") == 0, fill).otherwise(own).cast("long")).drop("_part", "_nth", "_small", "_large", "_s", "_l")


def shard(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", limit: int = 64 << 20) -> DataFrame:
    """``docs`` with ``_shard``: a struct of name (the bits of the bucket, then
    ``+page`` or ``-page`` for an overflow page), depth, hash and bytes
    (``__shard`` and so on where the input has a column of that name)."""
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), key_hash(id_col, text).alias("h"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes"))
    keys = cut(keyed.select("h", "bytes"))
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    bits = min(20, max(1, math.ceil(math.log2(max(2, total / limit))) + 4))
    root, todo, parts = 0, keys, []
    while True:
        bits = min(bits, BITS - root)
        directory = cut(open_cells(todo, root, bits, limit))
        root += bits
        parts.append((root, directory))
        large = directory.filter("bucket is null").select("cell")
        if root == BITS or large.isEmpty():
            break
        todo = todo.withColumn("cell", F.shiftright("h", BITS - root)).join(large, "cell", "left_semi").drop("cell")
    out = keyed
    names = []
    for k, (deep, directory) in enumerate(parts):
        out = out.withColumn("_c", F.shiftright("h", BITS - deep)).join(directory.select(F.col("cell").alias("_c"), F.col("bucket").alias(f"_b{k}"), F.col("depth").alias(f"_d{k}")), "_c", "left").drop("_c")
        names.append(k)
    out = out.withColumn("bucket", F.coalesce(*[f"_b{k}" for k in names])).withColumn("depth", F.coalesce(*[f"_d{k}" for k in names])).drop(*[f"_{x}{k}" for k in names for x in "bd"])
    # buckets of one hash above the limit: overflow pages
    full = keys.groupBy("h").agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).filter((F.col("b") > limit) & (F.col("n") > 1)).select("h")
    bits_name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("right(lpad(bin(bucket), 60, '0'), depth)"))
    if not full.isEmpty():
        pages = paged(out.join(full, "h", "left_semi"), limit)
        out = out.join(full, "h", "left_anti").withColumn("page", F.lit(None).cast("long")).unionByName(pages)
        bits_name = F.concat(bits_name, F.when(F.col("page").isNull(), "").when(F.col("page") >= 0, F.concat(F.lit("+"), F.col("page"))).otherwise(F.col("page").cast("string")))
    return out.select("_row.*", F.struct(bits_name.alias("name"), F.col("depth").cast("int").alias("depth"), F.col("h").alias("hash"), F.col("bytes")).alias(free("_shard", docs.columns)))
