"""Near-duplicate groups by DartMinHash signatures and banded joining.

Each five-word shingle of a text owns a strip of the weight x rank plane, as
wide as its weight.  Hashed darts land on the strips as a unit-rate Poisson
process that depends on the shingle alone; every dart also carries a hashed
coordinate.  A signature keeps the earliest dart of each coordinate, so two
texts agree in a coordinate with probability equal to their (weighted) Jaccard
similarity.  Only darts below rank ``k (ln k + 2) / weight`` are thrown, which
fills the ``k`` coordinates in about ``shingles + k ln k`` darts; a text with
an empty coordinate is thrown again to twice that rank.

Bands of ``rows`` coordinates name buckets.  In each bucket every member is
linked to two centres (smallest and largest node).  The pairs that a bound on
their similarity does not rule out (``likely``: sizes and 512 bits a text) are
verified on the whole texts, and verified links are closed into components.  A bucket is open
while its other members are of several components.  Members of open buckets
meet again in narrower buckets (two bands together) around fresh centres, for
up to ``rounds`` draws of O(m) pairs for m members: this joins large groups
cheaply, and no result rests on it.  What is still open then is settled exactly
by ``rare_pairs``: every pair of different components that can reach the
threshold is verified.  Exact copies are one node from the start.

Defined results: a null text is a class of its own row; texts without a word
(and all other equal texts) are one class by equality; a text of 1 to 4 words
has one shingle of all its words; repeated rows and null ids are kept, one
output row per input row; extra columns are ignored; empty input gives no rows.

A node is the 64-bit hash of a text.  Two of n different texts share one with
probability n * n / 2**65, 2e-2 for a billion texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import cut, drop, free
from tributary.llm.text import Words, column, doc_blocks, mix, shingles

U = np.uint64
#: Node lists of up to so many (8 bytes each) are broadcast to pick their texts; longer ones are joined by a shuffle.
MAX_BROADCAST_NODES = 1_000_000
EMPTY = U(0xFFFFFFFFFFFFFFFF)
#: Slots that count shingles for the order of the prefix filter.
SLOTS = 1 << 20
#: 64-bit words of the parity bits of a text.
PARITY = 8


def throw(x: np.ndarray, doc: np.ndarray, reach: np.ndarray, k: int, out: np.ndarray) -> None:
    """Throw the darts of strips ``x`` up to rank ``reach[doc]`` and keep the
    earliest of each coordinate in ``out[doc, k]`` (rank bits, then dart hash)."""
    flat, at, wave = out.reshape(-1), np.zeros(len(x)), 0
    while len(x):
        wave += 1
        s = mix(x + U((wave * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        at = at - np.log(((s >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        on = at < reach[doc]
        if not on.all():
            x, doc, at, s = x[on], doc[on], at[on], s[on]
        s = mix(s)
        dart = (at.astype(np.float32).view(np.uint32).astype(np.uint64) << U(32)) | (s >> U(32))
        np.minimum.at(flat, doc * k + (s & U(0xFFFFFFFF)).astype(np.int64) % k, dart)


def signatures(x: np.ndarray, doc: np.ndarray, n: int, k: int, weight: np.ndarray | None = None) -> np.ndarray:
    """``n`` signatures of ``k`` darts.  ``weight``: whole-number weights of the
    elements; by default each counts once however often it occurs."""
    if weight is not None:                       # a strip per unit of weight
        unit = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
        x, doc = mix(np.repeat(x, weight) + unit.astype(np.uint64) * U(0xD1342543DE82EF95)), np.repeat(doc, weight)
    out = np.full((n, k), EMPTY, np.uint64)
    reach = k * (np.log(k) + 2) / np.maximum(np.bincount(doc, minlength=n), 1)
    todo = np.bincount(doc, minlength=n) > 0
    while todo.any():
        on = todo[doc]
        throw(x[on], doc[on], reach, k, out)
        todo &= (out == EMPTY).any(axis=1)
        reach = np.where(todo, 2 * reach, reach)
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates."""
    n, k = sig.shape
    part = sig[:, :k // rows * rows].reshape(n, k // rows, rows)
    key = np.arange(k // rows, dtype=np.uint64)[None, :] * U(0x9E3779B97F4A7C15)
    for r in range(rows):
        key = mix(key + part[:, :, r])
    return key.view(np.int64)


def parities(x: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different elements of each of ``n`` sets, and ``64 * PARITY``
    bits: whether an odd number of them fall on the bit."""
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    x, doc = x[new], doc[new]
    bits = np.zeros((n, PARITY), np.uint64)
    np.bitwise_xor.at(bits.reshape(-1), doc * PARITY + ((x >> U(6)) % U(PARITY)).astype(np.int64), U(1) << (x & U(63)))
    return np.bincount(doc, minlength=n), bits


def with_bands(docs: DataFrame, text: str, *, k: int, rows: int, words: int) -> DataFrame:
    """``node`` (hash of the text), ``bands``, ``size`` (different shingles) and
    ``parity`` bits of every row whose text has a word."""
    def lists(a: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.reshape(-1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words()
        for batch in batches:
            buf, offs = column(batch, text)
            node = batch.column(1)
            for i, j in doc_blocks(offs):
                o = offs[i:j + 1]
                x, doc = shingles(*[(v[0], v[3]) for v in [split.split(buf, o)]][0], words)
                sig = signatures(x, doc, j - i, k)
                size, bits = parities(x, doc, j - i)
                has = np.flatnonzero(size > 0)
                yield pa.RecordBatch.from_arrays([
                    node.slice(i, j - i).take(pa.array(has)), lists(band_keys(sig[has], rows)),
                    pa.array(size[has].astype(np.int32)), lists(bits[has].view(np.int64)),
                ], ["node", "bands", "size", "parity"])

    return docs.filter(F.col(text).isNotNull()).select(text, F.xxhash64(text).alias("node")).mapInArrow(run, "node bigint, bands array<bigint>, size int, parity array<bigint>")


def likely(pairs: DataFrame, sig: DataFrame, *, threshold: float) -> DataFrame:
    """The pairs (a, b) that can have at least that Jaccard similarity, by size
    and parity bits.  Two sets of sizes n and m that reach it differ in at most
    ``(1 - t) / (1 + t) * (n + m)`` elements, and a bit differs only if an odd
    number of those fall on it: no such pair is ever ruled out."""
    bits = sig.select("node", "size", "parity")
    for side in ("a", "b"):
        pairs = pairs.join(bits.toDF(side, f"size_{side}", f"parity_{side}"), side)
    apart = sum((F.bit_count(F.get("parity_a", F.lit(i)).bitwiseXOR(F.get("parity_b", F.lit(i)))) for i in range(PARITY)), F.lit(0))
    near = F.least("size_a", "size_b") >= threshold * F.greatest("size_a", "size_b") - 1e-6
    return pairs.filter(near & (apart <= (1 - threshold) / (1 + threshold) * (F.col("size_a") + F.col("size_b")) + 1e-6)).select("a", "b")


def verify(pairs: DataFrame, texts: DataFrame, *, threshold: float, words: int) -> DataFrame:
    """The pairs (a, b) whose whole texts have at least that Jaccard similarity
    of word shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = Words(), {}

        def of(node: int, buf: np.ndarray, offs: np.ndarray, i: int) -> np.ndarray:
            if node not in known:
                if len(known) >= 64:
                    known.clear()
                v = split.split(buf, offs[i:i + 2])
                known[node] = np.unique(shingles(v[0], v[3], words)[0])
            return known[node]

        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ta, tb = column(batch, "text_a"), column(batch, "text_b")
            good = np.zeros(len(a), bool)
            for i in range(len(a)):
                x, y = of(int(a[i]), *ta, i), of(int(b[i]), *tb, i)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = both >= threshold * (len(x) + len(y) - both) - 1e-9
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def rare_pairs(apart: DataFrame, texts: DataFrame, *, threshold: float, words: int) -> DataFrame:
    """Pairs (a, b) of ``apart`` (node, comp) of different components, among
    them all of at least that Jaccard similarity.

    Prefix filter: with the shingles of every text in one order, rare ones first,
    two sets of sizes n and m that share at least ``o = t / (1 + t) * (n + m)``
    have a common shingle among the first ``n - o + 1`` and ``m - o + 1``.  A set
    stands once under each shingle of its longest prefix (for its smallest
    partner, of ``t n`` shingles); size and place in both prefixes are tested
    where two sets meet.  The order is by counts in ``SLOTS`` hashed slots, then
    by hash: shared slots cost pairs, never results."""
    share = threshold / (1 + threshold)
    rows = texts.join(apart, "node").dropDuplicates(["node"]).select("text", "node", "comp")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Words(), np.zeros(SLOTS, np.int64)
        for batch in batches:
            buf, offs = column(batch, "text")
            for i, j in doc_blocks(offs):
                v = split.split(buf, offs[i:j + 1])
                seen += np.bincount((shingles(v[0], v[3], words)[0] % U(SLOTS)).astype(np.int64), minlength=SLOTS)
        slot = np.flatnonzero(seen)
        for i in range(0, len(slot), 10_000):
            part = slot[i:i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], ["slot", "n"])

    rows = cut(rows)
    often = np.zeros(SLOTS, np.int64)
    for r in rows.mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_batches():
        often[r.column(0).to_numpy()] = r.column(1).to_numpy()

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words()
        for batch in batches:
            buf, offs = column(batch, "text")
            node, comp = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for d in range(batch.num_rows):
                v = split.split(buf, offs[d:d + 2])
                x = np.unique(shingles(v[0], v[3], words)[0])
                n = len(x)
                least = max(1, int(np.ceil(threshold * n - 1e-6)))
                x = x[np.lexsort((x, often[(x % U(SLOTS)).astype(np.int64)]))][:n - int(np.ceil(share * (n + least) - 1e-6)) + 1]
                k = len(x)
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(np.full(k, node[d])), pa.array(np.full(k, comp[d])), pa.array(np.full(k, n, np.int32)), pa.array(np.arange(k, dtype=np.int32))], ["key", "node", "comp", "n", "at"])

    spots = cut(rows.mapInArrow(prefixes, "key bigint, node bigint, comp bigint, n int, at int"))
    mixed = spots.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("key")
    spots = spots.join(mixed, "key", "left_semi")
    need = F.ceil(share * (F.col("l.n") + F.col("r.n")) - 1e-6)
    meet = (F.col("l.key") == F.col("r.key")) & (F.col("l.node") < F.col("r.node")) & (F.col("l.comp") != F.col("r.comp"))
    near = F.least("l.n", "r.n") >= threshold * F.greatest("l.n", "r.n") - 1e-6
    fits = near & (F.col("l.n") - F.col("l.at") >= need) & (F.col("r.n") - F.col("r.at") >= need)
    return spots.alias("l").join(spots.alias("r"), meet & fits).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the edges (a, b); comp is the smallest
    node of its connected component.  Alternates large-star and small-star
    steps, each a minimum per node (pre-aggregated) and a join, until every edge
    goes from a node with no other edge down to its centre."""
    def rows(*pairs: tuple[str, str], names: tuple[str, str] = ("u", "v")) -> Column:
        return F.inline(F.array(*[F.struct(F.col(x).alias(names[0]), F.col(y).alias(names[1])) for x, y in pairs]))

    def step(e: DataFrame, larger: bool) -> DataFrame:
        both = e.select(rows(("u", "v"), ("v", "u"))) if larger else e
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(low, "u")
        if larger:
            out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = moved.select(rows(("v", "m"), ("u", "m")))
        return out.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def settled(e: DataFrame) -> bool:
        ends = e.withColumns({"one": F.lit(1), "none": F.lit(0)}).select(rows(("u", "one"), ("v", "none"), names=("node", "down")))
        per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.min("down").alias("least"))
        return per.filter("down > 1 or (down = 1 and least = 0)").count() == 0

    e = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not settled(e):
        before, e = e, cut(step(step(e, True), False))
        drop(before)
    return e.select(rows(("u", "v"), ("v", "v"), names=("node", "comp"))).distinct()


def groups(docs: DataFrame, text: str = "text", *, threshold: float = 0.8, k: int = 128, rows: int = 4, words: int = 5, rounds: int = 3) -> DataFrame:
    """(node, comp) of the different texts that have a near duplicate.

    With k = 128 and bands of 4, a pair of similarity 0.8 meets in a bucket
    with probability 1 - (1 - 0.8**4)**32 = 1 - 5e-8."""
    sig = cut(with_bands(docs, text, k=k, rows=rows, words=words).dropDuplicates(["node"]))
    bands = sig.select("node", F.explode("bands").alias("band"))
    ends = bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low != high")
    shared = cut(bands.join(ends, "band"))
    texts = docs.filter(F.col(text).isNotNull()).select(F.xxhash64(text).alias("node"), F.col(text).alias("text"))

    def check(pairs: DataFrame) -> DataFrame:
        pairs = cut(likely(pairs, sig, threshold=threshold))
        n = pairs.count()
        need = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if 2 * n <= MAX_BROADCAST_NODES or need.count() <= MAX_BROADCAST_NODES:
            need = F.broadcast(need)
        return cut(verify(pairs, texts.join(need, "node", "left_semi").dropDuplicates(["node"]), threshold=threshold, words=words))

    def ordered(a: Column, b: Column) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    centre = F.explode(F.array("low", "high"))
    tried = cut(shared.select("node", centre.alias("c")).filter("node != c").select(*ordered(F.col("node"), F.col("c"))).distinct())
    links = check(tried)
    comps = cut(components(links))

    def joined(more: DataFrame) -> DataFrame:
        """The components with more links; those so far stand for the links that made them."""
        return cut(components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more)))

    def still_apart() -> DataFrame:
        """(node, comp) of the members of open buckets that were not their centres.
        All pairs with a centre are tried, so the others must be of one component."""
        named = shared.filter("node != low and node != high").join(comps, "node", "left").select("band", "node", F.coalesce("comp", "node").alias("comp"))
        split = named.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("band")
        return cut(named.join(split, "band", "left_semi").select("node", "comp").distinct())

    apart = still_apart()
    for turn in range(1, rounds + 1):
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n"))
        named = apart.join(degree, "node", "left").select("node", "comp", F.coalesce("n", F.lit(0)).alias("n"))
        # narrower buckets, of a band and another one: their members are closer to each other
        keys = F.transform(F.sequence(F.lit(0), F.size("bands") - 1), lambda i: F.xxhash64(F.get("bands", i), F.get("bands", F.pmod(i + turn, F.size("bands"))), i))
        members = cut(named.join(sig, "node").select("node", "comp", "n", F.explode(keys).alias("band")))
        # one centre with the most links so far (an original among its copies), one at random
        order = [F.xxhash64("node", F.lit(turn)).alias("o"), F.col("node").alias("c"), F.col("comp").alias("cc")]
        fresh = members.groupBy("band").agg(F.max(F.struct("n", *order)).alias("p"), F.max(F.struct(F.lit(0).cast("bigint").alias("n"), *order)).alias("q"))
        pairs = members.join(fresh, "band").select("node", "comp", F.explode(F.array("p", "q")).alias("m")).filter("comp != m.cc")
        pairs = cut(pairs.select(*ordered(F.col("node"), F.col("m.c"))).distinct().join(tried, ["a", "b"], "left_anti"))
        drop(members)
        if pairs.isEmpty():
            break
        more = check(pairs)
        tried = tried.union(pairs)
        if more.isEmpty():
            break
        links = links.union(more)
        comps = joined(more)
        apart = still_apart()
    if apart.isEmpty():
        return comps
    pairs = cut(rare_pairs(apart, texts, threshold=threshold, words=words).join(tried, ["a", "b"], "left_anti"))
    more = check(pairs)
    return comps if more.isEmpty() else joined(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: its id, ``class_id`` (smallest id of the
    class), ``class_rows`` and ``class_texts`` (rows and different texts in it)
    and ``node``.  A null text is a class of its own, named by its own id."""
    comps = groups(docs, text, **options)
    named = docs.select(F.col(id_col).alias("doc_id"), F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("node"))
    named = named.join(comps, "node", "left").select("doc_id", "node", F.coalesce("comp", "node").alias("class"))
    per = named.filter("class is not null").groupBy("class", "node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    per = per.groupBy("class").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_rows"), F.count("*").alias("class_texts"))
    return named.join(per, "class", "left").select(
        "doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_rows", F.lit(1)).alias("class_rows"), F.coalesce("class_texts", F.lit(1)).alias("class_texts"), "node")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id (null
    ids last), of equal rows any.  Rows with a null text all stay."""
    comps = groups(docs, text, **options)
    own = free("_key", docs.columns)
    key = F.xxhash64(id_col, text).alias("_key")                       # one row of equal rows is as good as another
    named = docs.filter(F.col(text).isNotNull()).select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_node"), key)
    named = named.join(comps.withColumnRenamed("node", "_node"), "_node", "left").select(F.coalesce("comp", "_node").alias("_class"), "_id", "_node", "_key")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_node"), F.col("_key")))
    stay = named.groupBy("_class").agg(first.alias("s")).select(F.col("s._key").alias(own))
    # join and removal of equal rows share one partitioning: the texts move once
    kept = docs.filter(F.col(text).isNotNull()).withColumn(own, key).join(stay, own, "left_semi").dropDuplicates([own]).drop(own)
    return kept.select(*docs.columns).unionByName(docs.filter(F.col(text).isNull()))
