"""Audit of how far the sources of a language differ, over a quadtree.

The matrix of a language has a row for each source and a column for each kept
term (one in at least ``min_docs`` documents of the language); a cell counts
the term in the source.  Shares are smoothed and exact: ``p = 1 + floor(10^9 *
(count + 2) / (N + 2 V))`` with ``N`` the row's sum and ``V`` the number of
columns.  Two rows differ in a column by ``floor((p - q)^2 / (p + q))``.

Columns are numbered by falling frequency, so that the empty parts of the
matrix lie together.  It is cut into tiles of ``SIDE`` columns times two blocks
of ``SIDE`` rows.  In each tile both blocks become quadtrees that halve rows and
columns down to ``LEAF``; a descent over pairs of row ranges stops where both
have an all-zero quadrant, which costs its number of columns times the price of
two zero cells, and leaves that hold a count are compared cell by cell.  Tiles
without any count are never made: their columns get the same price in the sum.
A task holds one tile, ``2 * SIDE^2`` cells at most, and one table of
``SIDE^2`` sums; it sends a row for each pair of sources, not for each tile.

Defined results: a null text, language or source counts as ''; a source whose
texts hold no kept term is a row of zeros; a language without kept terms has
pairs of value 0 and no terms; rows are documents, repeated ones too; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import cut
from tributary.llm.text import column

#: Rows and columns of a tile's blocks, and of the leaves compared cell by cell.
SIDE, LEAF = 256, 8
#: Different terms that a task counts before it sends them on, and bytes of text at a time.
HELD, PIECE = 200_000, 1 << 20
#: Columns of like frequency are dealt to so many parts, to be numbered apart.
PARTS = 64


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, by task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
        term = re.compile(rb"[a-z\x80-\xff]+")               # of lower-cased bytes: all of UTF-8 beyond ASCII is 80-FF
        gap = re.compile(rb"[^A-Za-z\x80-\xff]")
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in held.items():
                terms = list(n)
                for lo in range(0, len(terms), 20_000):
                    part = terms[lo:lo + 20_000]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([n[t] for t in part], pa.int64()), pa.array([d[t] for t in part], pa.int64())], ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            buf, offs = column(batch, "text")
            raw = memoryview(buf)
            for k, (lang, source) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                lo, end, own = int(offs[k]), int(offs[k + 1]), set()
                while lo < end:
                    hi = min(end, lo + PIECE)
                    while hi < end and not gap.match(raw[hi:hi + 1]):      # not inside a term
                        hi += 1
                    words = term.findall(bytes(raw[lo:hi]).translate(lower))
                    n.update(words)
                    own.update(words)
                    lo = hi
                d.update(own)
                if k % 64 == 63 and sum(len(x) for x, _ in held.values()) > HELD:
                    yield from flush()
            if sum(len(x) for x, _ in held.values()) > HELD:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(n: Column | str, total: Column | str, width: Column | str) -> Column:
    """``1 + floor(10^9 * (n + 2) / (total + 2 * width))``, in decimals."""
    whole = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(18,0)")
    return F.call_function("div", (whole(n) + F.lit(2)).cast("decimal(19,0)") * F.lit(1_000_000_000).cast("decimal(10,0)"), (whole(total) + whole(width) * F.lit(2)).cast("decimal(20,0)")) + F.lit(1)


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def quadtree(full: np.ndarray) -> list[np.ndarray]:
    """Which quadrants hold a count: one of the whole first, leaves last."""
    n = SIDE // LEAF
    levels = [full.reshape(n, LEAF, n, LEAF).any(axis=(1, 3))]
    while n > 1:
        n //= 2
        levels.append(levels[-1].reshape(n, 2, n, 2).any(axis=(1, 3)))
    return levels[::-1]


def compare(x: np.ndarray, y: np.ndarray, x0: np.ndarray, y0: np.ndarray, width: int, twice: bool) -> np.ndarray:
    """Sum over the first ``width`` columns for every row of ``x`` and of ``y``;
    ``x0``, ``y0``: the share of a zero cell in each row.  ``twice``: both are
    one block, of which each pair of row ranges is walked once."""
    def between(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    tree_x, tree_y = quadtree(x != x0[:, None]), quadtree(y != y0[:, None])
    out, empty = np.zeros((SIDE, SIDE), np.int64), np.zeros((SIDE, SIDE), np.int64)
    i = j = c = np.zeros(1, np.int64)
    for level, (has_x, has_y) in enumerate(zip(tree_x, tree_y, strict=True)):
        side = SIDE >> level
        some = has_x[i, c] | has_y[j, c]
        zero = np.zeros((1 << level, 1 << level), np.int64)
        np.add.at(zero, (i[~some], j[~some]), np.clip(width - c[~some] * side, 0, side))
        empty += zero.repeat(side, axis=0).repeat(side, axis=1)
        i, j, c = i[some], j[some], c[some]
        if side > LEAF:
            i, j, c = (np.repeat(2 * v, 8) + np.tile(step, len(v)) for v, step in ((i, [0, 0, 0, 0, 1, 1, 1, 1]), (j, [0, 0, 1, 1, 0, 0, 1, 1]), (c, [0, 1] * 4)))
            if twice:
                up = i <= j
                i, j, c = i[up], j[up], c[up]
    n = SIDE // LEAF
    bx, by = x.reshape(n, LEAF, n, LEAF), y.reshape(n, LEAF, n, LEAF)
    leaf = out.reshape(n, LEAF, n, LEAF)
    for lo in range(0, len(i), 2048):
        a, b, k = i[lo:lo + 2048], j[lo:lo + 2048], c[lo:lo + 2048]
        f = between(bx[a, :, k][:, :, None, :], by[b, :, k][:, None, :, :])
        f *= (k[:, None] * LEAF + np.arange(LEAF) < width)[:, None, None, :]
        np.add.at(leaf, (a, slice(None), b), f.sum(axis=3))
    return out + empty * between(x0[:, None], y0[None, :])


def tile_sums(tiles: DataFrame, schema: str) -> DataFrame:
    """From (lang, strip, rx, ry, row, col, p, width), sorted by block pair and
    strip, with ``col`` -1 for a row's zero share: (lang, a, b, value, columns),
    one row a task and pair of matrix rows ``a < b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, strip, held = None, None, []
        total, columns, rows = np.zeros((SIDE, SIDE), np.int64), 0, (set(), set())

        def tile() -> None:
            nonlocal total, columns
            row, col, p, width = (np.concatenate(v) for v in zip(*held, strict=True))
            held.clear()
            _, rx, ry = pair
            blocks = []
            for r in (rx, ry):
                own = row // SIDE == r
                zero = own & (col < 0)
                base = np.ones(SIDE, np.int64)
                base[row[zero] % SIDE] = p[zero]
                block = np.repeat(base[:, None], SIDE, axis=1)
                block[row[own & (col >= 0)] % SIDE, col[own & (col >= 0)] % SIDE] = p[own & (col >= 0)]
                blocks.append((block, base, row[zero]))
            total += compare(blocks[0][0], blocks[1][0], blocks[0][1], blocks[1][1], int(width[0]), rx == ry)
            columns += int(width[0])
            rows[0].update(blocks[0][2].tolist())
            rows[1].update(blocks[1][2].tolist())

        def sums() -> Iterator[pa.RecordBatch]:
            nonlocal total, columns
            lang, rx, ry = pair
            a, b = np.array(sorted(rows[0]), np.int64), np.array(sorted(rows[1]), np.int64)
            a, b = np.repeat(a, len(b)), np.tile(b, len(a))
            up = a < b
            a, b = a[up], b[up]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(total[a % SIDE, b % SIDE]), pa.array(np.full(len(a), columns))], ["lang", "a", "b", "value", "columns"])
            total, columns = np.zeros((SIDE, SIDE), np.int64), 0
            rows[0].clear(), rows[1].clear()

        for batch in batches:
            lang, rx, ry, at = batch.column(0).to_pylist(), *(batch.column(k).to_numpy() for k in (1, 2, 3))
            values = [batch.column(k).to_numpy() for k in (4, 5, 6, 7)]
            new = np.r_[True, (rx[1:] != rx[:-1]) | (ry[1:] != ry[:-1]) | (at[1:] != at[:-1]) | np.array([u != v for u, v in zip(lang[1:], lang, strict=False)], bool)]
            cuts = np.r_[np.flatnonzero(new), len(lang)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                p, s = (lang[lo], int(rx[lo]), int(ry[lo])), int(at[lo])
                if (p, s) != (pair, strip):
                    if held:
                        tile()
                    if p != pair and pair is not None:
                        yield from sums()
                    pair, strip = p, s
                held.append(tuple(v[lo:hi] for v in values))
        if held:
            tile()
        if pair is not None:
            yield from sums()

    return tiles.mapInArrow(run, schema)


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", *, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank).  Part ``pair``: every other
    source of the language, by falling difference.  Part ``term``: the ``top``
    terms that the source uses more than its language does."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = term_counts(texts).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    per_term = Window.partitionBy("lang", "term")
    cells = counts.select("*", F.sum("docs").over(per_term).alias("all_docs"), F.sum("n").over(per_term).alias("all_n")).filter(F.col("all_docs") >= min_docs)
    cells = cells.select("lang", "source", "term", "n", "all_n")
    # columns by falling frequency: classes of like frequency in parts, numbered in each
    part = (F.lit(63) - F.floor(F.log2("all_n"))).cast("int") * PARTS + F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")
    cells = cut(cells.withColumn("part", part).withColumn("nth", F.dense_rank().over(Window.partitionBy("lang", "part").orderBy("term"))))
    parts = cells.groupBy("lang", "part").agg(F.max("nth").alias("size"))             # 64 * PARTS rows a language at most
    before = F.sum("size").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("lang", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("size").over(Window.partitionBy("lang")).alias("v"))
    langs = parts.groupBy("lang").agg(F.max("v").alias("v")).join(cells.groupBy("lang").agg(F.sum("n").alias("lang_n")), "lang")
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("sum_n"))
    sources = texts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    sources = sources.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("sum_n", "v", "lang_n")])
    sources = cut(sources.select("*", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint").alias("row"),
                                 F.count("*").over(Window.partitionBy("lang")).alias("rows"),
                                 F.when(F.col("v") > 0, share(F.lit(0), "sum_n", "v")).alias("p0")))

    placed = cells.join(parts, ["lang", "part"]).join(sources.drop("v"), ["lang", "source"]).select(
        "lang", "source", "term", "row", "rows", (F.col("before") + F.col("nth") - 1).alias("col"), share("n", "sum_n", "v").alias("p"), share("all_n", "lang_n", "v").alias("q"), "v")
    value = apart(F.col("p"), F.col("q"))
    first = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = placed.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)

    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rows") - 1) / SIDE).cast("bigint"))
    own = F.floor(F.col("row") / SIDE).cast("bigint")
    inside = placed.select("lang", "row", "col", "p", F.floor(F.col("col") / SIDE).cast("bigint").alias("strip"), "v", own.alias("own"), F.explode(blocks).alias("other"))
    strip_width = F.least(F.lit(SIDE).cast("bigint"), F.col("v") - F.col("strip") * SIDE)
    inside = inside.select("lang", F.least("own", "other").alias("rx"), F.greatest("own", "other").alias("ry"), "strip", "row", "col", "p", strip_width.alias("width"))
    made = inside.select("lang", "rx", "ry", "strip", "width").distinct()
    marks = made.join(sources.select("lang", "row", "p0", own.alias("own")), "lang").filter("own = rx or own = ry")
    marks = marks.select("lang", "rx", "ry", "strip", "row", F.lit(-1).cast("bigint").alias("col"), F.col("p0").alias("p"), "width")
    tiles = inside.unionByName(marks).repartition("lang", "rx", "ry", "strip").sortWithinPartitions("lang", "rx", "ry", "strip")
    summed = tile_sums(tiles, "lang string, a bigint, b bigint, value bigint, columns bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns"))

    x, y = (sources.select("lang", *[F.col(c).alias(f"{c}_{k}") for c in ("source", "row", "p0")], *(["v"] if k == "x" else [])) for k in "xy")
    both = x.join(y, "lang").filter("row_x != row_y").withColumns({"a": F.least("row_x", "row_y"), "b": F.greatest("row_x", "row_y")}).join(summed, ["lang", "a", "b"], "left")
    unseen = (F.col("v") - F.coalesce("columns", F.lit(0))) * apart(F.col("p0_x"), F.col("p0_y"))
    pairs = both.select("lang", F.col("source_x").alias("source"), F.lit("pair").alias("part"), F.col("source_y").alias("item"),
                        F.when(F.col("v") > 0, F.coalesce("value", F.lit(0)) + unseen).otherwise(F.lit(0)).cast("bigint").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(first))
    return pairs.unionByName(terms)


def audit_sql(min_docs: int = 10, top: int = 10) -> str:
    """The same rows in DuckDB, with every cell of the matrix made."""
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
tokens AS (SELECT doc, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS all_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= {min_docs}),
cells AS (SELECT lang, source, term, count(*) AS n FROM tokens GROUP BY ALL),
grps AS (SELECT DISTINCT lang, source FROM docs),
widths AS (SELECT lang, count(*) AS v, sum(all_n) AS all_total FROM kept GROUP BY lang),
matrix AS (
  SELECT g.lang, g.source, k.term, k.all_n, coalesce(c.n, 0) AS n
  FROM grps g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT m.*, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY m.lang, m.source) + 2 * v) AS p,
         1 + 1000000000::HUGEINT * (all_n + 2) // (all_total + 2 * v) AS q
  FROM matrix m JOIN widths w ON w.lang = m.lang),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
scored AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM grps x JOIN grps y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pairs p ON p.lang = x.lang AND p.source = x.source AND p.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM scored)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}"""
