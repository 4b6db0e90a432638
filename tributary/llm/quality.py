"""Quality rules: hashed n-gram log-likelihood ratio, DataFrame functions only.

Unigrams and bigrams of words hash into ``buckets`` counters.  One multinomial
is estimated from trusted documents (label quality 1), one from all documents of
the corpus.  The trusted one starts from ``prior`` grams dealt as the corpus is,
so few labels give ratios near zero, not a poor model.  A document's score is the
mean over its n-grams of ln(p_trusted / p_corpus), so length does not matter.

Trusted documents fall into ``FOLDS`` folds by their id, and every document is
judged by the weights that the folds other than its own give: no document is
judged by its own words.  The threshold is ``least_score``, or three standard
deviations (more when they come from few documents) below the mean of the trusted
documents' own (so held-out) scores if that is lower.  The same document is always judged the same way, nothing is drawn
at random.  A base filter comes first (too few words, or words mostly in repeated
three-word windows).

The corpus counts cover every word of every document, the trusted counts and the
threshold every document of a trusted id.  The weights are ``buckets`` numbers a
fold, whatever the size of the corpus.

Defined results: a null or empty text has no words, fails the base filter and
is not kept; its score is 0.  Null ids and repeated rows are kept, one output
row each; labels without a document, null labels and other values than 1 are
ignored; without any trusted document all weights are 0 and the base filter
alone decides; extra columns are ignored; empty input gives no rows.  Repeated
windows are found by sorting 64-bit hashes that carry the position in their
low bits and comparing the words of neighbours; only a hash collision between
a repeated window and another one of the same text could hide one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
FOLDS = 4
#: Trusted ids of up to so many (8 bytes each) are broadcast; more are joined by a shuffle.
MAX_BROADCAST_IDS = 1_000_000


def words(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D, as an array."""
    return F.array_remove(F.split(text, f"[{SPACES}]+", -1), "")


def bucket(buckets: int, *parts: Column) -> Column:
    return F.pmod(F.hash(*parts), F.lit(buckets))


def with_words(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return named.withColumn("w", words(F.col("text")))


def fold(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), F.col(id_col)), F.lit(FOLDS)).cast("int")


def gram_counts(docs: DataFrame, id_col: str, text: str, buckets: int, *, trusted: str | None = None) -> DataFrame:
    """(b, n): hashed unigrams and bigrams of all texts, with a boolean column
    ``trusted`` also ``n0``, ``n1``, ... of its rows of each fold.  Each word comes
    with the next one, and counts are summed per task before the shuffle of at
    most ``buckets`` rows a task."""
    own = [F.when(F.col(f"_row.{trusted}"), fold("doc_id")).alias("fold")] if trusted else []
    pair = F.explode(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, size(w))").alias("z"))).alias("g")
    grams = with_words(docs, id_col, text).select(*own, pair)
    both = F.array(bucket(buckets, F.col("g.a")), F.when(F.col("g.z").isNotNull(), bucket(buckets, F.col("g.a"), F.col("g.z"))))
    each = [F.count_if(F.col("fold") == k).alias(f"n{k}") for k in range(FOLDS)] if trusted else []
    return grams.select(*(["fold"] if trusted else []), F.explode(both).alias("b")).filter("b is not null").groupBy("b").agg(F.count("*").alias("n"), *each)


def trusted_ids(labels: DataFrame, id_col: str) -> DataFrame:
    """(id): all ids with quality 1, once each."""
    good = labels.filter("quality = 1").select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    return F.broadcast(good) if good.count() <= MAX_BROADCAST_IDS else good


def weights(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", buckets: int = 10_000, prior: float = 30_000.0) -> list[list[float]]:
    """For each fold, ln(p_trusted / p_corpus) of each bucket with the trusted
    documents of the other folds; zeros where they have none."""
    return fold_weights(docs, trusted_ids(labels, id_col), id_col, text, buckets, prior)


def fold_weights(docs: DataFrame, ids: DataFrame, id_col: str, text: str, buckets: int, prior: float) -> list[list[float]]:
    import math

    known = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(ids.withColumn("good", F.lit(True)), "id", "left")
    every, good = [0] * buckets, [[0] * buckets for _ in range(FOLDS)]
    for r in gram_counts(known, "id", "text", buckets, trusted="good").collect():
        every[r["b"]] = r["n"]
        for k in range(FOLDS):
            good[k][r["b"]] = r[f"n{k}"]
    n0 = sum(every) + buckets
    share = [(n + 1.0) / n0 for n in every]
    out = []
    for k in range(FOLDS):
        others = [sum(good[j][b] for j in range(FOLDS) if j != k) for b in range(buckets)]
        n1 = sum(others) + prior
        out.append([math.log((others[b] + prior * share[b]) / n1 / share[b]) for b in range(buckets)] if any(others) else [0.0] * buckets)
    return out


def repeated_words() -> Column:
    """Starts of the three-word windows of ``w`` found twice or more, from
    ``s``: the sorted window hashes with their position in the low bits."""
    same = "s[k] >> bits = s[{0}] >> bits and w[{1}] = w[{2}] and w[{1} + 1] = w[{2} + 1] and w[{1} + 2] = w[{2} + 2]"
    at, before, after = "int(x & mask)", "int(s[k - 1] & mask)", "int(s[k + 1] & mask)"
    twice = f"filter(s, (x, k) -> (k > 0 and {same.format('k - 1', at, before)}) or (k + 1 < size(s) and {same.format('k + 1', at, after)}))"
    return F.expr(f"sort_array(transform({twice}, x -> int(x & mask)))")


def measured(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``_row``, ``doc_id``, ``w`` and the base measures of every row."""
    d = with_words(docs, id_col, text).withColumn("n", F.size("w"))
    d = d.withColumn("bits", F.expr("int(ceil(log2(n + 1)))")).withColumn("mask", F.expr("shiftleft(1L, bits) - 1"))
    d = d.withColumn("v", F.expr("zip_with(zip_with(w, slice(w, 2, n), (a, z) -> xxhash64(a, z)), slice(w, 3, n), (a, z) -> xxhash64(a, z))"))
    d = d.withColumn("v", F.expr("if(n >= 3, slice(v, 1, n - 2), cast(array() as array<bigint>))"))
    placed = "sort_array(transform(v, (x, i) -> shiftleft(shiftright(x, bits), bits) | bigint(i)))"
    d = d.withColumn("s", F.expr(f"if(size(array_distinct(v)) < size(v), {placed}, cast(array() as array<bigint>))"))    # else no window occurs twice
    d = d.withColumn("starts", repeated_words())
    covered = "aggregate(zip_with(starts, slice(starts, 2, size(starts)), (a, z) -> least(3, coalesce(z - a, 3))), 0L, (t, x) -> t + x)"
    d = d.withColumn("lines", F.expr("filter(split(text, '\\n', -1), l -> l rlike '[^ \\t\\u000b\\f\\r]')"))
    return d.select(
        "_row", "doc_id", "w", F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", f"[{SYMBOLS}]", -1)) - 1).cast("long").alias("n_symbols"),
        F.expr("bigint(size(lines) - size(array_distinct(lines)))").alias("n_dup_lines"),
        F.expr(f"if(size(starts) = 0, 0L, {covered})").alias("n_repeat_words"))


def scored(docs: DataFrame, tables: list[list[float]], id_col: str, text: str, buckets: int) -> DataFrame:
    """Every row (``_row``) with its measures, base_failed and score."""
    rows = measured(docs, id_col, text)
    one = F.transform("w", lambda a: bucket(buckets, a))
    two = F.zip_with(F.expr("slice(w, 1, greatest(size(w) - 1, 0))"), F.expr("slice(w, 2, size(w))"), lambda a, z: bucket(buckets, a, z))
    # a subquery gives the weights: written into the plan, they would stand in the text that Spark keeps
    # of every plan.  A row reads those of its own fold
    table = docs.sparkSession.createDataFrame([(tables,)], "t array<array<double>>")
    rows = rows.withColumn("own", F.get(table.scalar(), fold("doc_id")))
    total = F.aggregate(F.concat(one, two), F.lit(0.0), lambda s, b: s + F.get("own", b))
    rows = rows.withColumn("score", F.when(F.col("n_words") > 0, total / (2 * F.col("n_words") - 1)).otherwise(0.0)).drop("w", "own")
    # no filter moves below a row number that is used: without it Catalyst pushes a caller's filter
    # below the projections and computes the measures again in every condition
    rows = rows.withColumn("_nth", F.monotonically_increasing_id()).filter("_nth >= 0").drop("_nth")
    return rows.withColumn("base_failed", reduce(Column.__or__, [F.col("n_words") < MIN_WORDS, 100 * F.col("n_repeat_words") > 50 * F.col("n_words")]))


def judged(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", buckets: int = 10_000,
           least_score: float = -0.07, prior: float = 30_000.0) -> DataFrame:
    """Every row (``_row``) with its measures, base_failed, score and kept."""
    ids = trusted_ids(labels, id_col)
    tables = fold_weights(docs, ids, id_col, text, buckets, prior)
    good = scored(docs.join(ids, docs[id_col] == ids["id"], "left_semi"), tables, id_col, text, buckets).filter("not base_failed")
    n, mean, spread = good.agg(F.count("score"), F.avg("score"), F.stddev_samp("score")).first()
    least = least_score if n < 2 else min(least_score, mean - 3 * (1 + 5 / n) * spread)
    return scored(docs, tables, id_col, text, buckets).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept and score."""
    return judged(docs, labels, **options).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rejected documents."""
    return judged(docs, labels, **options).filter("kept").select("_row.*")
