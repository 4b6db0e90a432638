"""Mixing sources to target weights by temperature, DataFrame functions only.

Token shares p of the sources are raised to an exponent in [0, 1] and
normalised: 1 keeps the natural shares, 0 makes all sources equal.  The exponent
is bisected (sixteen sections a pass, one aggregation each) to the largest that
meets a target entropy (a share of the largest possible), or to the smallest at
which no source is repeated more than ``max_repeat`` times.  A budget of tokens
then gives each source a quota.  Without a budget it is the smallest that uses
every source whole at least once, so nothing of the corpus is lost and scarce
sources are repeated up to the limit.

The mixture is realised as block permutations: each pass (epoch) over a source
is a permutation of its documents by a hash of seed, epoch and document; a
document belongs to the epoch while the tokens before it are below what is left
of the quota.  The budget is cut into blocks, each with every source in its
weight; inside a block the order is a hash again.

Token sums before a document are running sums in (source, epoch, slice) with
slices of the permutation of about ``slice_rows`` documents, plus a running sum
over the slices of a source, so a source with a third of all rows is spread over
many tasks.

Defined results: a null source is a source of its own; null and empty texts
have no tokens, so they are placed in every epoch that is begun and take no
budget; null ids hash as ''; repeated rows are separate documents; a source
without tokens has no share and appears once; extra columns pass through in
``realise``; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import cut, free

#: Sections of the interval that one aggregation tries, and passes at most.
SECTIONS, PASSES = 16, 12
#: Above so many sources their table is joined by a shuffle.
MAX_BROADCAST_SOURCES = 100_000
#: Part of a token that rounding may add to a quota or take from it.
SUB_TOKEN = 1e-3


def tokens(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \t\n\x0b\x0c\r]+")), F.lit(0)).cast("long")


def source_tokens(rows: DataFrame) -> DataFrame:
    """(source, tokens, docs, p) of each source of ``rows`` (source, tokens)."""
    per = cut(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")))
    every = per.agg(F.sum("tokens")).first()[0] or 0
    return per.withColumn("p", F.col("tokens") / float(max(1, every)))


def exponent(sources: DataFrame, *, entropy_share: float | None = None, max_repeat: float | None = None) -> float:
    """The bisected exponent.  Both measures are monotone in it."""
    has = sources.filter("p > 0")

    def measures(points: list[float]) -> list[tuple[float, float]]:
        # the exponents are data, so all passes share one compiled plan
        at = has.select("p", F.posexplode(F.array(*map(F.lit, points))).alias("k", "a"))
        w, repeat = F.pow("p", F.col("a")), F.pow("p", F.col("a") - 1)
        # budget / tokens of a source = (w / p) / (w / p of the source that is repeated least)
        found = at.groupBy("k").agg(F.sum(w).alias("z"), F.sum(w * F.log(w)).alias("h"), (F.max(repeat) / F.min(repeat)).alias("r"), F.log(F.count("*")).alias("most"))
        by = {r["k"]: r for r in found.collect()}
        if not by:
            return [(1.0, 1.0)] * len(points)
        return [((math.log(r["z"]) - r["h"] / r["z"]) / r["most"] if r["most"] else 1.0, r["r"]) for r in (by[k] for k in range(len(points)))]

    if entropy_share is None and max_repeat is None:
        return 1.0
    entropy = entropy_share is not None
    met = (lambda m: m[0] >= entropy_share) if entropy else (lambda m: m[1] <= max_repeat)
    lo, hi = 0.0, 1.0                         # entropy: the largest exponent that meets it; repetition: the smallest
    if met(measures([1.0 if entropy else 0.0])[0]):
        return 1.0 if entropy else 0.0
    for _ in range(PASSES):
        points = [lo + (hi - lo) * k / SECTIONS for k in range(1, SECTIONS)]
        good = [met(m) for m in measures(points)]
        if entropy:                           # met at lo, not at hi
            k = good.index(False) if False in good else len(points)
            lo, hi = (points[k - 1] if k else lo), (points[k] if k < len(points) else hi)
        else:                                 # met at hi, not at lo
            k = good.index(True) if True in good else len(points)
            lo, hi = (points[k - 1] if k else lo), (points[k] if k < len(points) else hi)
        if hi - lo < 1e-12:
            break
    return lo if entropy else hi


def quotas(sources: DataFrame, alpha: float, budget: int | None) -> DataFrame:
    """(source, tokens, w, quota, epochs): normalised weights and budget shares."""
    z, least, every = sources.filter("p > 0").agg(F.sum(F.pow("p", F.lit(alpha))), F.max(F.pow("p", F.lit(1 - alpha))), F.sum("tokens")).first()
    if budget is None:                     # every source whole: budget * w >= tokens, so budget >= all * z * p^(1 - alpha)
        budget = (every or 0) * (z or 0.0) * (least or 0.0)
    w = F.when(F.col("p") > 0, F.pow("p", F.lit(alpha)) / F.lit(z or 1.0)).otherwise(0.0)
    q = sources.withColumn("w", w).withColumn("quota", w * F.lit(float(budget)))
    epochs = F.when(F.col("tokens") > 0, F.greatest(F.lit(1), F.ceil((F.col("quota") - SUB_TOKEN) / F.col("tokens")))).otherwise(1).cast("int")
    return q.select("source", "tokens", "w", "quota", epochs.alias("epochs"))


def permutation(seed: int, id_col: str) -> Column:
    """Fifteen hexadecimal digits that order a source's documents in an epoch."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 15)


def realise(docs: DataFrame, *, id_col: str = "doc_id", source: str = "source", text: str = "text", seed: int = 11, budget: int | None = None,
            block_tokens: int = 1 << 20, slice_rows: int = 5_000, entropy_share: float | None = None, max_repeat: float | None = 2.0) -> DataFrame:
    """``docs`` repeated and ordered as the mixture: the input's columns and a
    struct ``_mix`` of epoch, block, place (hash that orders a block) and weight
    (``__mix`` and so on where the input has a column of that name)."""
    narrow = cut(docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), tokens(F.col(text)).alias("tokens")))
    per = source_tokens(narrow)
    alpha = exponent(per, entropy_share=entropy_share, max_repeat=None if entropy_share is not None else max_repeat)
    number = F.row_number().over(Window.orderBy("source")).alias("_s")                      # sources only
    q = cut(quotas(per, alpha, budget).select(number, F.col("source").alias("_source"), F.col("tokens").alias("_all"), "w", "quota", "epochs"))
    n, rows = per.agg(F.count("*"), F.max("docs")).first()
    digits = 1
    while 16 ** digits * slice_rows < (rows or 0):
        digits += 1

    def drawn(frame: DataFrame, name: str) -> DataFrame:
        q_side = F.broadcast(q) if n <= MAX_BROADCAST_SOURCES else q
        d = frame.join(q_side, F.col(name).eqNullSafe(F.col("_source"))).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
        d = d.withColumn("place", permutation(seed, "_id"))
        return d.withColumn("slice", F.substring("place", 1, digits))

    sums = drawn(narrow.withColumnRenamed("id", "_id"), "source").groupBy("_s", "epoch", "slice").agg(F.sum("tokens").alias("_n"))
    before = Window.partitionBy("_s", "epoch").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_s", "epoch", "slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_sum"))
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col(source).alias("_own"), F.col(id_col).alias("_id"), tokens(F.col(text)).alias("_tokens"))
    d = drawn(named, "_own").join(sums, ["_s", "epoch", "slice"])
    inside = Window.partitionBy("_s", "epoch", "slice").orderBy("place", "_id", "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_at", (F.col("epoch") - 1) * F.col("_all") + F.col("_sum") + F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    whole = F.col("epoch") * F.col("_all") <= F.col("quota") + SUB_TOKEN                # all of the epoch fits
    if budget is None:
        whole = whole | (F.col("epoch") == 1)
    d = d.filter(whole | (F.col("_at") < F.col("quota") - SUB_TOKEN) | (F.col("_tokens") == 0))
    block = F.when(F.col("w") > 0, F.floor(F.col("_at") / (F.col("w") * block_tokens))).otherwise(0).cast("long")
    return d.select("_row.*", F.struct("epoch", block.alias("block"), "place", F.col("w").alias("weight"), F.col("_tokens").alias("tokens")).alias(free("_mix", docs.columns)))
