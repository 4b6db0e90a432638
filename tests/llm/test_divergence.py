import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tributary.llm import divergence as dv


def brute(rows, min_docs=10, top=10):
    """(lang, source, text) rows by Python integers."""
    docs = [(a or "", b or "", ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in docs}:
        df, by, total = Counter(), defaultdict(Counter), Counter()
        for a, b, words in docs:
            if a == lang:
                df.update(set(words))
                by[b].update(words)
                total.update(words)
        kept = [t for t, n in df.items() if n >= min_docs]

        def p(counts, kept=kept):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept}

        share, q = {s: p(c) for s, c in by.items()}, p(total)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in by:
            pairs = sorted((-sum(f(share[s][t], share[o][t]) for t in kept), o.encode()) for o in by if o != s)
            terms = sorted((-f(share[s][t], q[t]), t.encode()) for t in kept if by[s][t] and share[s][t] > q[t])[:top]
            for part, items in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, k.decode(), -v, r + 1) for r, (v, k) in enumerate(items)]
    return sorted(out)


def got(docs, **options):
    return sorted(tuple(r) for r in dv.audit(docs, **options).collect())


def rows_of(seed, n_sources, n_docs, n_terms):
    rnd = random.Random(seed)
    vocab = [f"{rnd.choice(['é', 'X', 'z'])}{''.join(rnd.choice('abcdefgh') for _ in range(5))}" for _ in range(n_terms)]
    rows = []
    for _ in range(n_docs):
        s = 0 if rnd.random() < 0.35 else rnd.randrange(n_sources)           # a hot source
        lo = s * 13 % n_terms
        rows.append((rnd.choice(["en", "en", "de"]), f"s{s}", " ".join(vocab[(lo + int(rnd.expovariate(0.05))) % n_terms] for _ in range(rnd.randint(0, 40)))))
    return rows


@pytest.mark.parametrize("side,n_sources", [(256, 6), (16, 40), (8, 9)])
def test_equals_brute_force_over_several_blocks(spark, monkeypatch, side, n_sources):
    """Small tiles: several blocks of rows, many strips, tiles without counts."""
    monkeypatch.setattr(dv, "SIDE", side)
    monkeypatch.setattr(dv, "LEAF", 4)
    monkeypatch.setattr(dv, "HELD", 50)
    monkeypatch.setattr(dv, "PIECE", 16)
    rows = rows_of(side, n_sources, 500, 150)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    assert got(docs, min_docs=3) == brute(rows, min_docs=3)


def test_equals_the_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got(docs) == sorted(con.sql(dv.audit_sql()).fetchall())


def test_descent_prices_zero_quadrants(monkeypatch):
    """The descent equals a comparison of every cell, and leaves out empty parts."""
    rnd = np.random.default_rng(4)
    for _ in range(20):
        x0, y0 = rnd.integers(1, 50, dv.SIDE), rnd.integers(1, 50, dv.SIDE)
        x, y = np.repeat(x0[:, None], dv.SIDE, 1), np.repeat(y0[:, None], dv.SIDE, 1)
        for m in (x, y):
            at = rnd.integers(0, dv.SIDE, (2, rnd.integers(0, 40)))
            m[at[0], at[1] // 3] = rnd.integers(100, 10**9, at.shape[1])
        width = int(rnd.integers(1, dv.SIDE + 1))
        plain = np.stack([((x[i] - y) ** 2 // (x[i] + y))[:, :width].sum(axis=1) for i in range(dv.SIDE)])
        assert np.array_equal(dv.compare(x, y, x0, y0, width, False), plain)


def test_odd_and_empty_tables(spark, odd_docs, empty_docs):
    plain = odd_docs.select("lang", "source", "text")
    assert got(odd_docs, min_docs=3) == brute([tuple(r) for r in plain.collect()], min_docs=3)
    assert got(odd_docs) == brute([tuple(r) for r in plain.collect()])       # no kept term at all
    assert got(empty_docs) == []


def test_counts_beyond_a_long_are_exact(spark):
    n = 10**17
    p = spark.range(1).select(dv.share(dv.F.lit(n), dv.F.lit(3 * n), dv.F.lit(7))).first()[0]
    assert p == 1 + 10**9 * (n + 2) // (3 * n + 14)
