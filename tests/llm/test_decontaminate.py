import random

import numpy as np

from tributary.llm import decontaminate as dc


def brute_align(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_equals_the_textbook_matrix():
    rng = np.random.default_rng(2)
    a, b = rng.integers(1, 5, (200, 12)), rng.integers(1, 5, (200, 30))
    got = dc.align(a.astype(np.uint64), b.astype(np.uint64))
    assert got.tolist() == [brute_align(list(x), list(y)) for x, y in zip(a, b)]


def corpus(rnd):
    vocab = [f"t{i}" for i in range(800)]
    items = [(k, [rnd.choice(vocab) for _ in range(rnd.randrange(15, 60))]) for k in range(12)]
    docs, planted = [], set()
    for d in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 400))]
        if d % 3 == 0:
            k, item = items[rnd.randrange(len(items))]
            copy = list(item)
            for _ in range(rnd.randrange(0, 1 + len(copy) // 8)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            if d % 2:
                copy.insert(len(copy) // 2, "inserted")
            at = rnd.randrange(len(w))
            w[at:at] = copy
            planted.add((d, k))
        docs.append((d, " ".join(w)))
    return docs, [(k, " ".join(w).upper() if k == 3 else " ".join(w)) for k, w in items], planted


def test_scores_equal_whole_text_alignment(spark):
    docs, items, planted = corpus(random.Random(4))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in dc.matches(d, b).collect()}
    want = {}
    for i, t in docs:
        for k, u in items:
            w = u.lower().split()
            s = brute_align(w, t.lower().split()) / (2 * len(w))
            if s >= 0.5:
                want[i, k] = s
    assert got == want and planted <= set(got)
    clean = {r.doc_id for r in dc.drop_contaminated(d, b).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _ in want}


def test_item_copied_into_every_document_is_still_found(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"a{i} b c {item} d e{i}") for i in range(200)], "doc_id long, text string")
    assert dc.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).count() == 200


def test_blocks_of_items_do_not_change_the_result(spark, monkeypatch):
    docs, items, _ = corpus(random.Random(6))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.matches(d, b).collect()))
    monkeypatch.setattr(dc, "BLOCK_BYTES", 700)
    assert sorted(map(tuple, dc.matches(d, b).collect())) == whole


def test_odd_and_empty_tables(spark, odd_docs, empty_docs):
    text = next(r.text for r in odd_docs.collect() if r.doc_id == 5)
    items = spark.createDataFrame([(1, " ".join(text.split()[10:50]), "x"), (1, " ".join(text.split()[10:50]), "x"), (2, "two words", "x"), (3, None, "x"), (None, "", None)], "item_id long, text string, gram string")
    got = sorted(((r.doc_id, r.item_id, r.score) for r in dc.matches(odd_docs, items).collect()), key=str)
    hit = [5, 5, 6, 8, None]
    assert got == sorted([(i, 1, 1.0) for i in hit for _ in range(2)], key=str)            # an item given twice matches twice
    left = dc.drop_contaminated(odd_docs, items)
    assert left.columns == odd_docs.columns and sorted((r.doc_id for r in left.collect()), key=str) == sorted([None, 1, 2, 3, 4, 7], key=str)
    assert dc.matches(empty_docs, items).count() == 0 and dc.matches(odd_docs, items.limit(0)).count() == 0
    assert dc.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()
