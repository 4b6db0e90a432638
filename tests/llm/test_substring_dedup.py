import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import substring_dedup as sd


def brute(rows, n=20):
    """(id, text) rows, ids unique: what every document keeps."""
    seen, out = set(), Counter()
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - n + 1):
            key = tuple(words[p:p + n])
            if key in seen:
                gone[p:p + n] = [True] * n
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[(i, len(words), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def got(docs, n=20):
    return Counter(tuple(r) for r in sd.digests(docs, n=n).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def corpus(seed, n_docs, n):
    """Texts of few words, with passages that stand in many of them, twice in
    one, overlapping and at either end."""
    rnd = random.Random(seed)
    shared = [[rnd.choice("abcdefgh") for _ in range(rnd.randint(n - 1, 3 * n))] for _ in range(4)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rnd.randint(0, 6)):
            words += rnd.choice(shared)[rnd.randint(0, 2):] if rnd.random() < 0.6 else [rnd.choice("abcdefgh") + rnd.choice("xyz") for _ in range(rnd.randint(0, 2 * n))]
        rows.append((i * 7 % n_docs, rnd.choice([" ", "\n", " \t "]).join(words)))
    return rows


@pytest.mark.parametrize("n", [1, 2, 5, 20, 33])
def test_equals_brute_force_with_small_sketch_and_flushes(spark, monkeypatch, n):
    monkeypatch.setattr(sd, "FLUSH", 300)
    monkeypatch.setattr(sd, "MAX_SLOTS", 2 * sd.CHUNK)
    rows = corpus(n, 150, n)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(docs, n) == brute(rows, n)


def test_full_sketch_loses_nothing(spark, monkeypatch):
    """All counters reach two: every window is grouped exactly."""
    monkeypatch.setattr(sd, "sketch", lambda rows, text, n, size: np.full(size // 8, 255, np.uint8))
    rows = corpus(5, 80, 20)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_sketch_never_undercounts(spark):
    rows = corpus(9, 60, 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    size, split = 2 * sd.CHUNK, sd.exact_words()
    bits = np.unpackbits(sd.sketch(docs, "text", 20, size))
    count = Counter()
    for _, text in rows:
        buf = np.frombuffer(text.encode(), np.uint8)
        a, b, _, _ = sd.windows(split, buf, np.array([0, len(buf)]), 20)
        count.update(zip(a.tolist(), b.tolist(), strict=True))
    often = [k for k, v in count.items() if v > 1]
    assert often
    for a, b in often:
        x, y = np.array([a], np.uint64), np.array([b], np.uint64)
        assert all(bits[sd.slots(x, y, row, size)[0]] for row in range(sd.DEPTH))


def test_whole_table_equals_the_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    assert got(docs) == Counter(con.sql(sd.digests_sql()).fetchall())


def test_hot_passage_is_one_row_a_task(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.lit(f" {passage} "), F.col("id").cast("string")).alias("text")).repartition(8)
    out = sd.digests(docs)
    assert out.filter("n_removed = 60").count() == 3999 and out.filter("doc_id = 0 and n_removed = 0").count() == 1


def test_odd_and_empty_tables(odd_docs, empty_docs):
    out = {}
    for r in sd.remove_repeats(odd_docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert set(out) == {None, 1, 2, 3, 4, 5, 6, 7, 8} and len(out[5]) == 2
    assert [r["__kept"].n_removed for r in out[5]] == [0, 0]            # a repeated row is one document
    assert out[6][0]["__kept"].n_removed == 80 and out[6][0]["__kept"].text == "" and out[6][0].text == out[5][0].text
    assert out[8][0]["__kept"].text == "end" and out[1][0]["__kept"].n_words == 0 and out[2][0]["__kept"].text == ""
    assert {r["__kept"].n_removed for r in out[None]} == {0, 80}        # rows without an id come last
    assert out[3][0]["__kept"].n_words == 60_000 and out[7][0].node == "clash"
    assert sd.remove_repeats(odd_docs).columns == [*odd_docs.columns, "__kept"]
    assert sd.digests(empty_docs).collect() == []


def test_pack_round_trip():
    rnd = np.random.default_rng(1)
    for size in (0, 1, 5, 4000, sd.CHUNK):
        at = np.sort(rnd.choice(sd.CHUNK, size, replace=False))
        assert np.array_equal(sd.unpack(sd.pack(at)), at)
