"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Folding: compatibility forms and case go, look-alike letters of other scripts
and digit or sign substitutions become Latin letters, zero-width characters and
lone combining marks vanish, accented letters stay (they tell words apart), all
else is a space.  A lexicon entry is
a whole word of any length, or a start of four to eight letters; its weight is the smoothed
log odds of texts that hold it, toxic against other, in the labelled rows.  An
occurrence inside an exception phrase does not count.  The sum of weights over
the words of a text, per thousand words, goes through a logistic curve fitted on
the same labelled rows: length-normalised, so a long text needs more.

The labelled sample is bounded (``max_toxic`` and ``max_other`` rows, by hash
of the id), and so is the lexicon, whose entries occur in at least four toxic
rows of it; scoring covers every whole text.

Defined results: null and empty texts (and texts without a letter) score as
zero weight; null ids hash as ''; repeated rows are scored each; labels of
unknown documents and null labels are ignored; a label row that occurs twice
counts once; without both classes in the sample every score is the share of
toxic rows (0 without rows); extra columns are ignored; empty input, no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that look like Latin ones, and signs used for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Innocent phrases around words that serve as insults.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "trash collection", "clown fish", "class clown", "circus clown", "scum line", "pond scum", "sore loser", "idiot proof", "pathetic fallacy")
SHORTEST, LONGEST = 4, 8


class Fold(dict):
    """Table for ``str.translate``, filled in as characters turn up."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        out = ""
        for x in unicodedata.normalize("NFKC", c).lower():
            x = LOOK_ALIKES.get(x, SUBSTITUTES.get(x, x))
            if x.isalpha():
                out += x
            elif not unicodedata.combining(x) and unicodedata.category(x) != "Cf":
                out += " "
        self[code] = out
        return out


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def entries(word: str) -> list[str]:
    """The word itself, closed by a blank, and its starts."""
    return [word + " ", *(word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1))]


class Lexicon:
    """Weighted word starts, exception phrases, and the logistic curve."""

    def __init__(self, weights: dict[str, float], exceptions: tuple, slope: float = 0.0, offset: float = 0.0) -> None:
        self.weights, self.exceptions, self.slope, self.offset = weights, exceptions, slope, offset

    def matcher(self):
        """A function from a text to (weight per thousand words, matches, words)."""
        import ahocorasick

        fold, auto = Fold(), ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            auto.add_word(" " + entry, (len(entry), weight))
        for phrase in self.exceptions:
            auto.add_word(f" {phrase} ", (len(phrase) + 1, 0.0))
        if len(auto):
            auto.make_automaton()

        def run(text: str) -> tuple[float, int, int]:
            plain = f" {text.translate(fold)} "
            words = max(1, len(plain.split()))
            if not len(auto):
                return 0.0, 0, words
            found, innocent = {}, []
            for end, (size, weight) in auto.iter(plain):
                if weight:
                    at = end - size + 1
                    found[at] = max(found.get(at, 0.0), weight)        # the word's best entry
                else:
                    innocent.append((end - size, end))
            if innocent:
                found = {at: w for at, w in found.items() if not any(a <= at < b for a, b in innocent)}
            return 1000 * sum(found.values()) / words, len(found), words

        return run

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * np.log1p(x), -700, 700)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small ridge."""
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.0, 1e-9, 1 - 1e-9))
        return 0.0, float(np.log(share / (1 - share)))
    a, t = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ t, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * t)
        t = t + step
        if np.abs(step).max() < 1e-9:
            break
    return float(t[0]), float(t[1])


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text: str, max_toxic: int, max_other: int) -> DataFrame:
    """(text, toxic) of at most that many labelled documents, none held out."""
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("id is not null and toxic in (0, 1)")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).filter(~held_out("id"))
    many = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / float(1 << 20)
    share = F.when(F.col("toxic") == 1, 0.9 * max_toxic / max(1, many.get(1, 0))).otherwise(0.9 * max_other / max(1, many.get(0, 0)))
    few = known.filter(part < share)                    # about nine tenths of the bound at most
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(few), "id").select("text", "toxic").dropDuplicates(["text"])


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", max_toxic: int = 6_000, max_other: int = 14_000,
          least_share: float = 0.005, least_weight: float = 3.0) -> Lexicon:
    """Lexicon and curve from labelled rows that are not held out."""
    from tributary.llm.store import cut

    sample = cut(labelled(docs, labels, id_col, text, max_toxic, max_other))
    size = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, toxic, other = Fold(), Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (toxic if y else other).update({s for w in set((t or "").translate(fold).split()) for s in entries(w)})
        keys = list(toxic.keys() | other.keys())
        for i in range(0, len(keys), 100_000):
            k = keys[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array([toxic[x] for x in k], pa.int64()), pa.array([other[x] for x in k], pa.int64())], ["entry", "t", "o"])

    found = sample.mapInArrow(count, "entry string, t bigint, o bigint").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))
    weight = F.log((F.col("t") + 0.5) / (n1 + 1.0)) - F.log((F.col("o") + 0.5) / (n0 + 1.0))
    found = found.select("entry", "t", weight.alias("w")).filter((F.col("t") >= max(4, least_share * n1)) & (F.col("w") >= least_weight))
    weights: dict[str, float] = {}
    for entry, _, w in sorted(found.collect(), key=lambda r: (len(r[0]), r[0])):
        if not any(weights.get(entry[:k], -1.0) >= w - 0.7 for k in range(SHORTEST, min(LONGEST + 1, len(entry)))):
            weights[entry] = float(w)                  # a longer start must say more than a shorter one
    lexicon = Lexicon(weights, EXCEPTIONS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = lexicon.matcher()
        for batch in batches:
            x = [run(t or "")[0] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], ["x", "y"])

    rows = sample.mapInArrow(measure, "x double, y int").collect()
    lexicon.slope, lexicon.offset = logistic(np.log1p(np.array([r[0] for r in rows], float)), np.array([r[1] for r in rows], float))
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, *, id_col: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, n_matches, n_words and the
    weight per thousand words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = lexicon.matcher()
        for batch in batches:
            rows = [match(t or "") for t in batch.column(2).to_pylist()]
            x = np.array([r[0] for r in rows], float)
            p = lexicon.probability(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array(x)],
                                             ["doc_id", "held_out", "score", "predicted", "n_matches", "n_words", "weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_matches bigint, n_words bigint, weight double")
