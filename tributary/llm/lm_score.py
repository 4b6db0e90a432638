"""Context-tree weighting over bytes, and a unigram base score.

Texts are bytes with ``A-Z`` in lower case, then one end symbol 0xFF (no UTF-8
text holds that byte); before a text stand 0xFF bytes.  A byte is eight binary
decisions.  Each decision has a context tree over the preceding bytes, of
depths 0 to ``depth``; a node keeps the Krichevsky-Trofimov estimate of its
zeros and ones, and context-tree weighting mixes the estimates of all depths
with the weights that the training texts give them.  The trained tree is
frozen; the score of a text is the sum of log10 probabilities of its bytes.

How it runs: one scan counts words and byte (depth + 1)-grams, pre-aggregated
per task, then summed by key.  Grams are dealt out by their two nearest context
bytes, so that each task weights whole subtrees; the depths 0 and 1 (at most
65,280 nodes) come from one aggregation and go back to the tasks.  That gives
one log probability per gram that occurs in the corpus.  A second scan looks up
the frequent words and grams in two tables of at most ``max_words`` and
``max_grams`` entries, the proven bound of what is broadcast; all other words
and grams are joined by key, so every token and byte counts at every size.

Defined results: a null text counts as empty (one end token, one end symbol);
a null id hashes as the empty text, so it is held out; repeated rows count and
are scored each; extra columns are ignored; with no training text N = V = 0 and
every node predicts 1/2; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.store import cut
from tributary.llm.text import Words, column, doc_blocks, lower_table, mix

U = np.uint64
#: Key of the end token among words.
END = 1
WORD, GRAM = 0, 1


def held_out(id_col: str, mod: int = 10, part: int = 0) -> Column:
    """crc32 of the id as text, mod ``mod``, is ``part``; a null id is ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod == part


def gram_keys(buf: np.ndarray, offs: np.ndarray, depth: int, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Key (context bytes, oldest first, then the byte) and text number of each
    byte and end symbol of the texts."""
    n = len(offs) - 1
    size = np.diff(offs)
    doc = np.repeat(np.arange(n), size)
    x = np.full(int(size.sum()) + (n + 1) * depth, 255, np.uint8)
    x[np.arange(len(doc)) + (doc + 1) * depth] = low.take(buf[offs[0]:offs[-1]])
    m = len(x) - depth
    key = np.zeros(m, np.uint64)
    for j in range(depth + 1):
        key <<= U(8)
        key |= x[j:j + m]
    # position i of key is byte i + depth of x: the texts and, after each, its end symbol
    at = np.concatenate([np.arange(len(doc)) + doc * depth, np.cumsum(size) + np.arange(n) * depth])
    return key[at], np.concatenate([doc, np.arange(n)])


class Tally:
    """Counts by key, merged when many blocks have piled up."""

    def __init__(self, limit: int = 1 << 20) -> None:
        self.parts, self.held, self.limit = [], 0, limit

    def add(self, key: np.ndarray, *n: np.ndarray) -> None:
        self.parts.append((key, *n))
        self.held += len(key)
        if self.held > self.limit:
            self.merge()

    def merge(self) -> None:
        key = np.concatenate([p[0] for p in self.parts])
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        sums = [np.add.reduceat(np.concatenate([p[k] for p in self.parts])[order], first) if len(first) else np.empty(0, np.int64) for k in range(1, len(self.parts[0]))]
        self.parts, self.held = [(key[first], *sums)], len(first)

    def rows(self, kind: int) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
            key, train, every = self.parts[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(train), pa.array(every)], ["kind", "key", "train", "n"])
            self.parts, self.held = [], 0


def counts(docs: DataFrame, depth: int) -> DataFrame:
    """(kind, key, train, n): words of the training texts, grams of all texts
    with their count in the training texts.  ``docs`` has held_out and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, low, words, grams = Words(), lower_table(), Tally(), Tally()
        for batch in batches:
            buf, offs = column(batch, "text")
            train = ~np.asarray(batch.column(batch.schema.get_field_index("held_out")).to_numpy(zero_copy_only=False), bool)
            for i, j in doc_blocks(offs):
                o = offs[i:j + 1]
                on = train[i:j]
                h, _, _, doc = split.split(buf, o)
                u, n = np.unique(np.concatenate([h[on[doc]], np.full(int(on.sum()), END, np.uint64)]), return_counts=True)
                words.add(u, n, n)
                key, doc = gram_keys(buf, o, depth, low)
                key = np.sort((key << U(1)) | on[doc])           # the lowest bit says: training
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
                n = np.diff(np.r_[first, len(key)])
                u = key[first]
                grams.add(u >> U(1), n * (u & U(1)).astype(np.int64), n)
                if words.held > words.limit:
                    yield from words.rows(WORD)
                if grams.held > grams.limit:
                    yield from grams.rows(GRAM)
        yield from words.rows(WORD)
        yield from grams.rows(GRAM)

    part = docs.select("held_out", "text").mapInArrow(run, "kind int, key bigint, train bigint, n bigint")
    return part.groupBy("kind", "key").agg(F.sum("train").alias("train"), F.sum("n").alias("n"))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0, by Stirling's series at x + 8."""
    z = x + 8.0
    out = (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5)
    rise = np.ones_like(z)
    for i in range(8):
        rise *= x + i
    return out - np.log(rise)


def kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln probability of a zeros and b ones under the KT estimator."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


def grouped(key: np.ndarray, *values: np.ndarray) -> tuple:
    """Sorted distinct keys, the place of each key among them, and sums."""
    u, at = np.unique(key, return_inverse=True)
    return u, at, *(np.bincount(at, v, len(u)).astype(float) for v in values)


def subtree(key: np.ndarray, n: np.ndarray, depth: int) -> tuple:
    """Nodes of depths 2 to ``depth`` under the contexts of these grams.

    A node key is its context bytes, nearest first, then its bits so far with a
    leading 1.  Returns the place of each (gram, bit) among the deepest nodes,
    the bits, and per depth (key, zeros, ones, ln Pw, share of its own KT
    estimate, place of each node's parent one depth up)."""
    path = np.zeros(len(key), np.uint64)
    for j in range(1, depth + 1):
        path = (path << U(8)) | ((key >> U(8 * j)) & U(255))
    byte = (key & U(255)).astype(np.int64)
    bits = np.stack([(byte >> (7 - j)) & 1 for j in range(8)], axis=1)
    soft = np.stack([(1 << j) | (byte >> (8 - j)) for j in range(8)], axis=1).astype(np.uint64)
    node = ((path[:, None] << U(8)) | soft).reshape(-1)
    many = np.repeat(n, 8).astype(float)
    one = bits.reshape(-1)
    u, at, a, b = grouped(node, many * (1 - one), many * one)
    pw = kt(a, b)
    levels = [[u, a, b, pw, np.ones(len(u)), None]]
    for _ in range(depth - 2):
        last = levels[-1]
        u, up, a, b, below = grouped(((last[0] >> U(16)) << U(8)) | (last[0] & U(255)), last[1], last[2], last[3])
        last[5] = up
        own = kt(a, b)
        levels.append([u, a, b, np.logaddexp(own, below) - np.log(2), 1 / (1 + np.exp(np.clip(below - own, -700, 700))), None])
    return at.reshape(-1, 8), bits, levels


def gathered(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and training counts of a whole partition of grams."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    key = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    return key.view(np.uint64), np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)


def gram_model(grams: DataFrame, depth: int) -> DataFrame:
    """(key, value): log10 probability of the last byte after the others, for
    every gram (key, train)."""
    n = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = grams.select("key", "train").repartition(n, F.shiftrightunsigned("key", 8).bitwiseAND(0xFFFF))

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, train = gathered(batches)
        if len(key):
            u, a, b, pw = subtree(key, train, depth)[2][-1][:4]
            one, _, a, b, pw = grouped(((u >> U(16)) << U(8)) | (u & U(255)), a, b, pw)
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(a), pa.array(b), pa.array(pw)], ["node", "a", "b", "below"])

    top = dealt.mapInArrow(up, "node bigint, a double, b double, below double").groupBy("node").agg(F.sum("a"), F.sum("b"), F.sum("below")).orderBy("node").collect()
    near, a, b, below = (np.array([r[k] for r in top], float) for k in range(4))      # at most 256 * 255 nodes
    near = near.astype(np.uint64)
    own = kt(a, b)
    share1 = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
    _, up0, a0, b0, below0 = grouped(near & U(255), a, b, np.logaddexp(own, below) - np.log(2))
    share0 = 1 / (1 + np.exp(np.clip(below0 - kt(a0, b0), -700, 700)))
    guess = (share0 * (b0 + 0.5) / (a0 + b0 + 1))[up0] + (1 - share0)[up0] * share1 * (b + 0.5) / (a + b + 1)
    rest = (1 - share0)[up0] * (1 - share1)
    shared = grams.sparkSession.sparkContext.broadcast((near, guess, rest))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, train = gathered(batches)
        if not len(key):
            return
        near, guess, rest = shared.value
        at, bits, levels = subtree(key, train, depth)
        u = levels[-1][0]
        place = np.searchsorted(near, ((u >> U(16)) << U(8)) | (u & U(255)))
        g, r = guess[place], rest[place]
        for k in range(len(levels) - 1, -1, -1):
            _, a, b, _, share, up = levels[k]
            if k < len(levels) - 1:
                g, r = g[up], r[up]
            g, r = g + r * share * (b + 0.5) / (a + b + 1), r * (1 - share)
        p = g[at]
        value = np.log10(np.where(bits == 1, p, 1 - p)).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(value)], ["key", "value"])

    return dealt.mapInArrow(down, "key bigint, value double")


class Table:
    """Open-addressed table of distinct keys, for many lookups in numpy."""

    @staticmethod
    def build(key: np.ndarray, value: np.ndarray) -> dict:
        size = 1 << max(4, int(2 * len(key)).bit_length())
        keys, values, used = np.zeros(size, np.uint64), np.zeros(size), np.zeros(size, bool)
        slot, todo = (mix(key) & U(size - 1)).astype(np.int64), np.arange(len(key))
        while len(todo):
            free = todo[~used[slot[todo]]]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            keys[slot[put]], values[slot[put]], used[slot[put]] = key[put], value[put], True
            done = np.zeros(len(key), bool)
            done[put] = True
            todo = todo[~done[todo]]
            slot[todo] = (slot[todo] + 1) & (size - 1)
        return {"keys": keys, "values": values, "used": used}

    def __init__(self, state: dict) -> None:
        self.keys, self.values, self.used = state["keys"], state["values"], state["used"]

    def find(self, key: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        size = len(self.keys)
        slot = (mix(key) & U(size - 1)).astype(np.int64)
        out = np.where((self.keys.take(slot) == key) & self.used.take(slot), slot, -1)
        todo = np.flatnonzero((out < 0) & self.used.take(slot))
        slot, key = slot[todo], key[todo]
        while len(todo):
            slot = (slot + 1) & (size - 1)
            hit, more = self.keys[slot] == key, self.used[slot]
            out[todo[hit & more]] = slot[hit & more]
            more &= ~hit
            todo, slot, key = todo[more], slot[more], key[more]
        return out


def frequent(rows: DataFrame, count: str, limit: int) -> DataFrame:
    """The rows whose count reaches the least power of two that at most
    ``limit`` rows reach."""
    level = F.floor(F.log2(F.greatest(F.col(count), F.lit(1)))).cast("int")
    many = dict(map(tuple, rows.groupBy(level.alias("level")).count().collect()))
    total, least = 0, 64
    for k in sorted(many, reverse=True):
        total += many[k]
        if total > limit:
            break
        least = k
    return rows.filter(level >= least)


def score(docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, depth: int = 5, max_words: int = 1 << 20, max_grams: int = 1 << 21) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score, n_bytes and bits_per_byte (code length)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    seen = cut(counts(rows, depth))
    n, v = seen.filter(F.col("kind") == WORD).agg(F.coalesce(F.sum("train"), F.lit(0)), F.count("*")).first()
    words = seen.filter(F.col("kind") == WORD).select("key", F.log10(F.col("train") + 0.1).alias("value"), "n")
    grams = seen.filter(F.col("kind") == GRAM)
    model = cut(gram_model(grams, depth)).join(grams.select("key", "n"), "key")
    tables = []
    for table, limit in ((words, max_words), (model, max_grams)):
        top = frequent(table, "n", limit).select("key", "value").toArrow()
        tables.append(Table.build(top.column("key").to_numpy().view(np.uint64), top.column("value").to_numpy()))
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, low, (word, gram) = Words(), lower_table(), [Table(t) for t in shared.value]

        def per_doc(table: Table, key: np.ndarray, doc: np.ndarray, m: int) -> tuple:
            slot = table.find(key)
            hit = slot >= 0
            miss = np.flatnonzero(~hit)
            miss = miss[np.argsort(doc[miss], kind="stable")]
            offs = np.r_[0, np.cumsum(np.bincount(doc[miss], minlength=m))].astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(offs), pa.array(key[miss].view(np.int64)))
            return np.bincount(doc[hit], table.values.take(slot[hit]), m).astype(float), np.bincount(doc[hit], minlength=m), rest

        for batch in batches:
            buf, offs = column(batch, "text")
            for i, j in doc_blocks(offs, 1 << 20):
                o, m = offs[i:j + 1], j - i
                h, _, _, doc = split.split(buf, o)
                h, doc = np.concatenate([h, np.full(m, END, np.uint64)]), np.concatenate([doc, np.arange(m)])
                base, known, rare_words = per_doc(word, h, doc, m)
                tokens = np.bincount(doc, minlength=m)
                total, _, rare_grams = per_doc(gram, *gram_keys(buf, o, depth, low), m)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, m), batch.column(1).slice(i, m), pa.array(tokens), pa.array(known), pa.array(base), pa.array(total), pa.array(np.diff(o) + 1), rare_words, rare_grams],
                                                 ["doc_id", "held_out", "n_tokens", "known", "base", "total", "n_symbols", "rare_words", "rare_grams"])

    kind = docs.schema[id_col].dataType.simpleString()
    first = cut(rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens bigint, known bigint, base double, total double, n_symbols bigint, rare_words array<bigint>, rare_grams array<bigint>"))
    shared.unpersist()
    first = first.withColumn("row", F.monotonically_increasing_id())         # fixed: the frame is read from the checkpoint
    rare = first.select("row", F.explode("rare_words").alias("key")).join(words, "key", "left").groupBy("row").agg(F.count("value").alias("more_known"), F.sum(F.coalesce("value", F.log10(F.lit(0.1)))).alias("more_base"))
    rare_g = first.select("row", F.explode("rare_grams").alias("key")).join(model, "key").groupBy("row").agg(F.sum("value").alias("more_total"))
    out = first.drop("rare_words", "rare_grams").join(rare, "row", "left").join(rare_g, "row", "left")
    per_token = float(np.log10(n + 0.1 * (v + 1)))
    total = F.col("total") + F.coalesce("more_total", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * per_token).alias("base_score"), total.alias("score"),
                      (F.col("n_symbols") - 1).alias("n_bytes"), (-total * float(np.log2(10)) / F.col("n_symbols")).alias("bits_per_byte"))
