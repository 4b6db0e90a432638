import random

import numpy as np

from tributary.llm import toxicity as tx

DATA = "/root/testdata/sf0.1"


def test_folding():
    fold = tx.Fold()
    assert "1D10T".translate(fold) == "idiot" and "іdіоt".translate(fold) == "idiot" and "ＩＤＩＯＴ".translate(fold) == "idiot"
    assert "i​d́iot".translate(fold) == "idiot" and "réeux".translate(fold) == "réeux" and "a.b!".translate(fold) == "a b "


def brute(text, lex):
    """Weight per thousand words, by looking at every position."""
    plain = f" {(text or '').translate(tx.Fold())} "
    covered = set()
    for p in lex.exceptions:
        at = plain.find(f" {p} ")
        while at >= 0:
            covered |= set(range(at, at + len(p) + 1))
            at = plain.find(f" {p} ", at + 1)
    total = n = 0
    for i in range(1, len(plain)):
        if plain[i - 1] == " " and (i - 1) not in covered:
            w = [v for e, v in lex.weights.items() if plain.startswith(e, i)]
            total, n = total + max(w, default=0), n + bool(w)
    return 1000 * total / max(1, len(plain.split())), n


def test_matching_equals_brute_force():
    rnd = random.Random(2)
    lex = tx.Lexicon({"idio": 2.0, "idiot": 5.0, "tras": 3.0, "scum": 1.5}, tx.EXCEPTIONS)
    run = lex.matcher()
    vocab = ["idiot", "1d10t!", "idiom", "trash", "can", "bin", "pond", "scum", "scumm", "the", "Тrash", "x"]
    for _ in range(300):
        t = " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(0, 30)))
        x, n, _ = run(t)
        assert (round(x, 9), n) == (round(brute(t, lex)[0], 9), brute(t, lex)[1])


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    m = tx.score(docs, tx.learn(docs, labels)).filter("held_out").join(labels, "doc_id").filter("quality = 1").toPandas()
    hit = ((m.predicted == 1) & (m.toxic == 1)).sum()
    assert hit / (m.toxic == 1).sum() > 0.95 and hit / (m.predicted == 1).sum() > 0.85
    order = np.argsort(m.score.to_numpy(), kind="stable")
    rank = np.empty(len(m))
    rank[order] = np.arange(1, len(m) + 1)
    pos = (m.toxic == 1).to_numpy()
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.95


def test_obfuscated_words_score_like_plain_ones():
    lex = tx.Lexicon({"moro": 4.0}, (), 1.0, -3.0)
    run = lex.matcher()
    assert run("you m0r0n there")[0] == run("you moron there")[0] == run("you МОRОN there")[0] > 0


def test_short_and_long_words_count_whole(spark):
    docs = spark.createDataFrame([(i, f"common text {'zog verylongwordindeedq' if i % 2 else 'zogs verylongwordindeed'} here {i}") for i in range(400)], "doc_id long, text string")
    lex = tx.learn(docs, docs.selectExpr("doc_id", "int(doc_id % 2) as toxic"))
    assert set(lex.weights) == {"zog ", "verylongwordindeedq "}
    run = lex.matcher()
    assert run("a zog")[1] == run("z0g!")[1] == run("verylongwordindeedq")[1] == 1 and run("zogs")[1] == run("verylongwordindeed")[1] == 0


def test_labels_held_out_are_never_read(spark):
    docs = spark.createDataFrame([(i, f"common text {'grimble' if i % 2 else 'fine'} here {i}") for i in range(400)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) as toxic", "1 as quality")
    wrong = labels.withColumn("toxic", (1 - labels.toxic)).join(docs.filter(tx.held_out("doc_id")).select("doc_id"), "doc_id", "left_semi")
    half = labels.join(docs.filter(~tx.held_out("doc_id")).select("doc_id"), "doc_id", "left_semi")
    a, b = tx.learn(docs, labels), tx.learn(docs, half.unionByName(wrong))
    assert a.weights == b.weights and (a.slope, a.offset) == (b.slope, b.offset) and "grim" in a.weights


def test_odd_and_empty_tables(spark, odd_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0), (5, 1, 0), (None, 1, 1), (3, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        lex = tx.learn(odd_docs, lab)
        got = tx.score(odd_docs, lex).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
        assert tx.score(empty_docs, lex).count() == 0
    assert tx.learn(empty_docs, labels).weights == {}
