import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tributary.llm import lm_score as lm


def low(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def out_of(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def log_kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Brute:
    """Context-tree weighting by the book, node by node."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, Counter()
        for t in texts:
            for ctx, byte in self.steps(t):
                for j in range(8):
                    for d in range(depth + 1):
                        self.n[ctx[:d], (byte >> (8 - j)) | (1 << j), (byte >> (7 - j)) & 1] += 1
        self.memo = {}
        self.below = {}
        for ctx, soft, _ in self.n:
            if ctx:
                self.below.setdefault((ctx[:-1], soft), set()).add(ctx)

    def steps(self, text):
        x = [255] * self.depth + list(low(text)) + [255]
        for i in range(self.depth, len(x)):
            yield tuple(x[i - 1 - d] for d in range(self.depth)), x[i]

    def pw(self, ctx, soft):
        if (ctx, soft) not in self.memo:
            own = log_kt(self.n[ctx, soft, 0], self.n[ctx, soft, 1])
            if len(ctx) < self.depth:
                rest = sum(self.pw(c, soft) for c in self.below.get((ctx, soft), ()))
                own = np.logaddexp(own, rest) - math.log(2)
            self.memo[ctx, soft] = own
        return self.memo[ctx, soft]

    def guess(self, ctx, soft, d=0):
        a, b = self.n[ctx[:d], soft, 0], self.n[ctx[:d], soft, 1]
        kt = (b + .5) / (a + b + 1)
        if d == self.depth:
            return kt
        share = math.exp(log_kt(a, b) - math.log(2) - self.pw(ctx[:d], soft))
        return share * kt + (1 - share) * self.guess(ctx, soft, d + 1)

    def score(self, text):
        total = 0.0
        for ctx, byte in self.steps(text):
            for j in range(8):
                p = self.guess(ctx, (byte >> (8 - j)) | (1 << j))
                total += math.log10(p if (byte >> (7 - j)) & 1 else 1 - p)
        return total


def brute(rows, depth):
    train = [t for i, t in rows if not out_of(i)]
    model = Brute(train, depth)
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", low(t)), None]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in w)
        out.append((i, out_of(i), len(w), sum(c[x] > 0 for x in w), n, base, model.score(t)))
    return sorted(out, key=str)


ROWS = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The Cat sat", "", None, "été à Paris", "xyz", "the dog sat on the log", "a b c", "the the the", "mat", "cat\nsat\ton", "zzz qqq"])] + [(20, "the cat"), (None, "hello there"), (7, "a b c")]


@pytest.mark.parametrize("depth", [2, 3])
@pytest.mark.parametrize("bound", [1 << 20, 8])
def test_scores_equal_the_tree_node_by_node(spark, depth, bound):
    """Also with tables so small that most words and grams are joined."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm.score(df, depth=depth, max_words=bound, max_grams=bound).collect()), key=str)
    want = brute(ROWS, depth)
    assert [g[:5] for g in sorted(got, key=lambda r: (str(r[0]), r[2]))] == [w[:5] for w in sorted(want, key=lambda r: (str(r[0]), r[2]))]
    for g, w in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(want, key=lambda r: (str(r[0]), r[2]))):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_next_byte_probabilities_sum_to_one():
    model = Brute([t for _, t in ROWS], 2)
    total = sum(10 ** sum(math.log10(p if (b >> (7 - j)) & 1 else 1 - p) for j in range(8) for p in [model.guess((116, 32), (b >> (8 - j)) | (1 << j))]) for b in range(256))
    assert total == pytest.approx(1)


def test_held_out_code_length_beats_the_unigram_score(spark):
    out = lm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").toPandas()
    assert out.score.sum() > out.base_score.sum() and 1.5 < out.bits_per_byte.median() < 2.6


def test_table_finds_exactly_its_keys():
    rng = np.random.default_rng(0)
    key = np.unique(np.r_[rng.integers(0, 1 << 63, 5000, dtype=np.uint64), np.uint64(0)])
    t = lm.Table(lm.Table.build(key, np.arange(len(key), dtype=float)))
    slot = t.find(key)
    assert (slot >= 0).all() and (t.values[slot] == np.arange(len(key))).all()
    other = np.setdiff1d(rng.integers(0, 1 << 63, 5000, dtype=np.uint64), key)
    assert (t.find(other) < 0).all()
    assert (lm.Table(lm.Table.build(key[:0], np.empty(0))).find(key) < 0).all()


def test_odd_and_empty_tables(odd_docs, empty_docs):
    got = lm.score(odd_docs, depth=3).collect()
    assert len(got) == odd_docs.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id == 1} == {1} and lm.score(empty_docs, depth=3).count() == 0
