"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Every three-word gram of the test items is counted over all documents (one
scan, counts pre-aggregated per task).  An item's seeds are its rarer half:
grams whose document count is at most the median over the item, ties included,
so an item copied into any number of documents keeps its seeds.  A second scan
joins document grams to the seeds; each (document, item, diagonal bin) that
shares a seed is aligned over whole words: match 2, other word -1, gap -1.  The
score is the best local alignment divided by that of the whole item, so 1 is a
whole copy and an edited or paraphrased copy loses 3/2 or so of its edits.

A bin covers every alignment that starts within one item length, with a margin
of a quarter item on both sides; nothing else of a text is cut.  The test items
are handled in blocks of bounded bytes, each against all documents.

Defined results: a null or empty document matches nothing; an item of fewer
than ``words`` words (null, empty) has no grams and matches nothing; equal items
each match; repeated rows each give their rows; extra columns are ignored
(``matches``) or kept (``drop_contaminated``); empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.text import Words, column, doc_blocks, shingles

#: Bytes of test items handled at once; their grams are held by every task.
BLOCK_BYTES = 16 << 20


def grams(h: np.ndarray, doc: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and first word of every ``words``-gram."""
    m = len(h) - words + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:m] == doc[words - 1:])
    return shingles(h, doc, words)[0][:len(at)], doc[at], at


def align(item: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Best Smith-Waterman score of each row pair of word hashes."""
    n, w = window.shape
    step = np.arange(w, dtype=np.int32)
    last, best = np.zeros((n, w + 1), np.int32), np.zeros(n, np.int32)
    for i in range(item.shape[1]):
        here = last[:, :-1] + np.where(window == item[:, i:i + 1], np.int32(2), np.int32(-1))
        np.maximum(here, last[:, 1:] - 1, out=here)
        np.maximum(here, 0, out=here)
        here = np.maximum.accumulate(here + step, axis=1) - step     # gaps along the window
        last = np.concatenate([np.zeros((n, 1), np.int32), here], axis=1)
        np.maximum(best, here.max(axis=1), out=best)
    return best


class Items:
    """The test items of one block: word hashes, grams and seeds (numpy, so
    that a task gets them in one broadcast)."""

    def __init__(self, ids: list, texts: list[str], words: int) -> None:
        self.ids, self.words = ids, words
        buf, offs = column(pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["t"]), "t")
        self.h, _, _, doc = Words().split(buf, offs)
        self.size = np.bincount(doc, minlength=len(ids))
        self.first = np.cumsum(self.size) - self.size
        self.gram, self.item, at = grams(self.h, doc, words)
        self.place = at - self.first[self.item]
        self.known = np.unique(self.gram)
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    @classmethod
    def held(cls, state: dict) -> Items:
        """The block whose ``vars`` were broadcast (plain arrays)."""
        own = object.__new__(cls)
        own.__dict__.update(state)
        return own

    def seed(self, count: dict[int, int]) -> None:
        """Keep each item's rarer half of grams, sorted by hash."""
        n = np.array([count.get(int(g), 0) for g in self.known.view(np.int64)], np.int64)
        n = n[np.searchsorted(self.known, self.gram)] if len(self.known) else np.empty(0, np.int64)
        order = np.lexsort((n, self.item))
        size = np.bincount(self.item, minlength=len(self.ids))
        first = np.cumsum(size) - size
        middle = np.zeros(len(self.ids), np.int64)
        has = size > 0
        middle[has] = n[order][first[has] + (size[has] - 1) // 2]
        keep = np.flatnonzero(n <= middle[self.item])
        keep = keep[np.argsort(self.gram[keep], kind="stable")]
        self.gram, self.item, self.place = self.gram[keep], self.item[keep], self.place[keep]
        self.known = np.unique(self.gram)
        self.maybe[:] = False
        self.maybe[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, g: np.ndarray) -> np.ndarray:
        """Positions in ``g`` of known grams."""
        if not len(self.known):
            return np.empty(0, np.int64)
        at = np.flatnonzero(self.maybe.take((g & np.uint64((1 << 22) - 1)).astype(np.int64)))
        k = np.minimum(np.searchsorted(self.known, g[at]), len(self.known) - 1)
        return at[self.known[k] == g[at]]

    def scores(self, h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, item number and best score of every pair that shares a seed."""
        g, d, at = grams(h, doc, self.words)
        on = self.hits(g)
        lo, hi = np.searchsorted(self.gram, g[on], side="left"), np.searchsorted(self.gram, g[on], side="right")
        many = hi - lo
        seed = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        d, at, item = np.repeat(d[on], many), np.repeat(at[on], many), self.item[seed]
        bins = np.floor_divide(at - self.place[seed], self.size[item])       # in words of this block
        key = np.unique(np.stack([d, item, bins], axis=1), axis=0) if len(d) else np.empty((0, 3), np.int64)
        d, item, bins = key[:, 0], key[:, 1], key[:, 2]
        best = np.zeros(len(d))
        width = -(-self.size // 16) * 16
        padded = np.concatenate([h, np.zeros(1, np.uint64)])
        for w in np.unique(width[item]) if len(d) else ():
            sel = np.flatnonzero(width[item] == w)
            for part in np.array_split(sel, -(-len(sel) * w // 20_000)):
                size = self.size[item[part]][:, None]
                row = np.arange(w)[None, :]
                own = np.where(row < size, self.h[np.minimum(self.first[item[part]][:, None] + row, len(self.h) - 1)], np.uint64(1))
                margin = -(-size // 4)
                col = bins[part][:, None] * size - margin + np.arange(2 * w + w // 2 + 4)[None, :]
                inside = (col >= 0) & (col < len(h)) & (col < bins[part][:, None] * size + 2 * size + margin)
                inside[inside] = doc[col[inside]] == np.broadcast_to(d[part][:, None], col.shape)[inside]
                best[part] = align(own, padded[np.where(inside, col, len(h))]) / (2 * size[:, 0])
        if len(d):
            order = np.lexsort((-best, item, d))
            top = order[np.r_[True, (np.diff(d[order]) != 0) | (np.diff(item[order]) != 0)]]
            d, item, best = d[top], item[top], best[top]
        return d, item, best


def blocks(docs: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, text: str, words: int) -> Iterator[Items]:
    """Test items by blocks, with their seeds."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for b in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).orderBy("item", "text").collect()
        block = Items([r[0] for r in rows], [r[1] for r in rows], words)
        shared = docs.sparkSession.sparkContext.broadcast(vars(block))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            split, own = Words(), Items.held(shared.value)
            for batch in batches:
                buf, offs = column(batch, text)
                for i, j in doc_blocks(offs):
                    h, _, _, doc = split.split(buf, offs[i:j + 1])
                    g, d, _ = grams(h, doc, own.words)
                    on = own.hits(g)
                    pair = np.unique(np.stack([g[on], d[on].astype(np.uint64)], axis=1), axis=0)
                    gram, n = np.unique(pair[:, 0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["gram", "n"])

        seen = docs.select(text).mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n")).collect()
        shared.unpersist()
        block.seed(dict(map(tuple, seen)))           # at most the block's own grams
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id",
            item_text: str = "text", words: int = 3, threshold: float = 0.5) -> DataFrame:
    """(doc_id, item_id, score) of every document and test item whose alignment
    scores at least ``threshold``."""
    item_type = benchmark.schema[item_col].dataType
    out = None
    for block in blocks(docs, benchmark, item_col, item_text, text, words):
        shared = docs.sparkSession.sparkContext.broadcast(vars(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            split, own = Words(), Items.held(shared.value)
            for batch in batches:
                buf, offs = column(batch, "text")
                for i, j in doc_blocks(offs):
                    h, _, _, doc = split.split(buf, offs[i:j + 1])
                    d, item, score = own.scores(h, doc)
                    good = score >= threshold
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d[good] + i)), pa.array(item[good].astype(np.int32)), pa.array(score[good])], ["doc_id", "k", "score"])

        found = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, k int, score double")
        names = docs.sparkSession.createDataFrame(list(enumerate(block.ids)), f"k int, item_id {item_type.simpleString()}")
        found = found.join(names, "k").select("doc_id", "item_id", "score")
        out = found if out is None else out.union(found)
    if out is None:
        out = docs.limit(0).select(F.col(id_col).alias("doc_id")).crossJoin(benchmark.limit(0).select(F.col(item_col).alias("item_id"))).withColumn("score", F.lit(0.0))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_col: str = "item_id",
                      item_text: str = "text", words: int = 3, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that hold a copy of a test item; all
    columns stay as they are."""
    for block in blocks(docs, benchmark, item_col, item_text, text, words):
        shared = docs.sparkSession.sparkContext.broadcast(vars(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            split, own = Words(), Items.held(shared.value)
            for batch in batches:
                buf, offs = column(batch, text)
                clean = np.ones(batch.num_rows, bool)
                for i, j in doc_blocks(offs):
                    h, _, _, doc = split.split(buf, offs[i:j + 1])
                    d, _, score = own.scores(h, doc)
                    clean[d[score >= threshold] + i] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
