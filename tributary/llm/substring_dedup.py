"""Removal of repeated passages, behind a count-min prefilter.

A window is ``n`` consecutive words (maximal runs without space and
``\\x09-\\x0D``, compared as they are) of one text.  Every word covered by a
window whose word sequence also starts earlier goes; windows are judged on the
input.  Earlier: in a document with a smaller id, or further left in the same.

Pass 1: every task sketches the windows of its partition, ``DEPTH`` rows of
counters that stop at two; the sketches are merged slot by slot.  A merged
counter is never below the number of windows in it, so a window whose smallest
counter is one occurs once.  Pass 2: only windows estimated repeated go on.
Each task settles repeats among its own windows and sends one occurrence of
each window, the earliest, to be grouped; so a passage that stands in a third of
all documents is sent once a task.  A window is known by its seed, the smallest
hash of ``SEED`` words inside it, and a 64-bit hash of its own.  Windows in a row
mostly share the seed; they travel as one row and meet their equals under it.
Starts that are not the first go back to their documents.

The sketch has four counters a window, up to ``MAX_SLOTS``; what is broadcast
is one bit a counter, 64 MiB at most.  Beyond 1.3e8 windows more and more
unrepeated windows pass the prefilter: the grouping gets more rows and the
result stays the same.

Defined results: a null or blank text has no words; repeated rows (same id and
text) are one document and get the same result; rows that share an id but not
the text, and rows without an id (after all others), are ordered by a hash of
the text; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.store import free
from tributary.llm.text import Words, column, doc_blocks, mix

U = np.uint64
#: Counters of the whole sketch at most, rows of it, and counters in a chunk.
MAX_SLOTS, DEPTH, CHUNK = 1 << 29, 2, 1 << 16
#: Windows that a task holds at a time, and words of a window's seed.
FLUSH, SEED = 1 << 21, 8


def exact_words() -> Words:
    """Words by their bytes, without folding of case."""
    split = Words()
    split.value = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
    return split


def window_hash(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive word hashes, by doubling."""
    out, done, block, size = None, 0, h, 1
    while n:
        if n & 1:                                            # append a block of ``size`` words to what is done
            if out is None:
                out = block
            else:
                m = len(block) - done
                out = out[:max(0, m)] * U(pow(base, size, 1 << 64)) + block[done:]
            done += size
        n >>= 1
        if n:
            block = block[:max(0, len(block) - size)] * U(pow(base, size, 1 << 64)) + block[size:]
            size *= 2
    return mix(out)


def seeds(h: np.ndarray, n: int) -> np.ndarray:
    """The smallest hash of ``SEED`` words (or of all) inside every window."""
    size = min(n, SEED)
    low, span, want = window_hash(h, size, 0x165667B19E3779F9), 1, n - size + 1
    while span < want:
        more = min(span, want - span)
        low = np.minimum(low[:len(low) - more], low[more:])
        span += more
    return low


def windows(split: Words, buf: np.ndarray, offs: np.ndarray, n: int, *, seeded: bool = False) -> tuple[np.ndarray, ...]:
    """Both hashes, text number and first word of every window, in order, and
    the seed where asked for."""
    h, _, _, doc = split.split(buf, offs)
    m = len(h) - n + 1
    if m <= 0:
        return (np.empty(0, U), np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U))[:4 + seeded]
    full = np.flatnonzero(doc[:m] == doc[n - 1:])
    first = np.searchsorted(doc, np.arange(len(offs) - 1))
    out = (window_hash(h, n, 0x9E3779B97F4A7C15)[full], window_hash(h, n, 0xC2B2AE3D27D4EB4F)[full], doc[full], full - first[doc[full]])
    return (*out, seeds(h, n)[full]) if seeded else out


def steps(x: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Where, along ``x``, one of the columns differs from the row before."""
    new = np.zeros(len(x), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[x][1:] != c[x][:-1]
    return new


def slots(a: np.ndarray, b: np.ndarray, row: int, size: int) -> np.ndarray:
    """The counter of each window in a row of the sketch."""
    width = size // DEPTH
    return ((a if row == 0 else b) & U(width - 1)).astype(np.int32) + np.int32(row * width)


def pack(places: np.ndarray) -> bytes:
    """Increasing places as steps of a byte; 255 means 255 further and no place."""
    q, r = np.divmod(np.diff(places, prepend=-1), 255)
    out = np.full(int(q.sum()) + len(q), 255, np.uint8)
    out[np.cumsum(q + 1) - 1] = r
    return out.tobytes()


def unpack(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255] - 1


def sketch(docs: DataFrame, text: str, n: int, size: int) -> np.ndarray:
    """One bit a counter, set where it reached two (``size / 8`` bytes)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, total = exact_words(), [], 0

        def partial() -> Iterator[pa.RecordBatch]:
            places, often = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            chunk = places // CHUNK
            cuts = np.r_[0, np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(places)]
            rows = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                at, twice = places[lo:hi] - chunk[lo] * CHUNK, often[lo:hi] > 1
                rows.append((int(chunk[lo]), pack(at[~twice]), pack(at[twice])))
            for lo in range(0, len(rows), 1024):
                k, once, more = zip(*rows[lo:lo + 1024], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())], ["chunk", "once", "more"])

        for batch in batches:
            buf, offs = column(batch, text)
            for i, j in doc_blocks(offs):
                a, b, _, _ = windows(split, buf, offs[i:j + 1], n)
                held.extend(slots(a, b, row, size) for row in range(DEPTH))
                total += len(a)
                if total >= FLUSH:
                    yield from partial()
                    total = 0
        if total:
            yield from partial()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, more = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(more).tobytes()], pa.binary())], ["chunk", "bits"])

        for batch in batches:
            for k, o, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != now:
                    if now is not None:
                        yield done()
                    now, once, more = k, np.zeros(CHUNK, bool), np.zeros(CHUNK, bool)
                o, m = unpack(o), unpack(m)
                more[m] = True
                more[o[once[o]]] = True
                once[o], once[m] = True, True
        if now is not None:
            yield done()

    parts = docs.select(text).mapInArrow(count, "chunk int, once binary, more binary")
    merged = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, "chunk int, bits binary")
    bits = np.zeros(size // 8, np.uint8)
    for batch in merged.toArrow().to_batches():               # size / 8 bytes at most
        for k, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bits[k * CHUNK // 8:(k + 1) * CHUNK // 8] = np.frombuffer(data, np.uint8)
    return bits


def sketch_size(docs: DataFrame, text: str) -> int:
    """Four counters for every six bytes of text, rounded up to a power of two."""
    n_bytes = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(MAX_SLOTS, max(DEPTH * CHUNK, 1 << max(0, int(n_bytes) * 4 // 6 - 1).bit_length()))


def repeated_starts(docs: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """``id``, ``key`` (hash of the text) and ``starts``: the first words of the
    windows that occur earlier, of every document that has one."""
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("key"))
    size = sketch_size(rows, "text")
    bits = rows.sparkSession.sparkContext.broadcast(sketch(rows, "text", n, size))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows estimated repeated: the earliest of each here (runs of one
        seed as hashes from ``start`` on), and for each document the starts that
        an earlier one here rules out (``settled``)."""
        split, seen, names = exact_words(), bits.value, ["seed", "start", "id", "key", "hashes", "settled"]
        held: list[tuple[np.ndarray, ...]] = []
        total = 0

        def settle() -> Iterator[pa.RecordBatch]:
            a, b, start, none, ident, key, seed = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(a, kind="stable")
            same = a[order][1:] == a[order][:-1]
            among = order[np.r_[False, same] | np.r_[same, False]]
            x = among[np.lexsort((start[among], key[among], ident[among], none[among], b[among], a[among]))]
            new = steps(x, a, b)
            head = x[np.flatnonzero(new)[np.cumsum(new) - 1]]
            own = np.ones(len(x), bool)                      # rows equal in every respect hold one window
            for c in (start, key, ident, none):
                own &= c[x] == c[head]
            late = np.zeros(len(a), bool)
            late[x] = ~own
            x = np.flatnonzero(~late)
            run = steps(x, seed, ident, none, key) | np.r_[np.ones(min(1, len(x)), bool), start[x][1:] != start[x][:-1] + 1]
            at = np.r_[np.flatnonzero(run), len(x)]
            for lo in range(0, len(at) - 1, 1 << 15):
                cuts = at[lo:lo + (1 << 15) + 1]
                d, hashes = x[cuts[:-1]], a[x[cuts[0]:cuts[-1]]].view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(seed[d].view(np.int64)), pa.array(start[d].astype(np.int32)), pa.array(ident[d], mask=none[d]), pa.array(key[d]),
                    pa.ListArray.from_arrays(pa.array((cuts - cuts[0]).astype(np.int32)), pa.array(hashes)), pa.nulls(len(d), pa.list_(pa.int32()))], names)
            x = np.flatnonzero(late)
            x = x[np.lexsort((start[x], key[x], ident[x], none[x]))]
            x = x[steps(x, start, ident, none, key)]
            at = np.flatnonzero(steps(x, ident, none, key))
            d, lists = x[at], pa.ListArray.from_arrays(pa.array(np.r_[at, len(x)].astype(np.int32)), pa.array(start[x].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(d), pa.int64()), pa.nulls(len(d), pa.int32()), pa.array(ident[d], mask=none[d]), pa.array(key[d]), pa.nulls(len(d), pa.list_(pa.int64())), lists], names)

        for batch in batches:
            buf, offs = column(batch, "text")
            ids = batch.column(1)
            none, ident = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            key = batch.column(2).to_numpy()
            for i, j in doc_blocks(offs):
                a, b, doc, start, seed = windows(split, buf, offs[i:j + 1], n, seeded=True)
                often = np.ones(len(a), bool)
                for row in range(DEPTH):
                    at = slots(a, b, row, size)
                    often &= (seen[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                if often.any():
                    a, b, doc, start, seed = a[often], b[often], doc[often] + i, start[often], seed[often]
                    held.append((a, b, start, none[doc], ident[doc], key[doc], seed))
                    total += len(a)
                if total >= FLUSH:
                    yield from settle()
                    total = 0
        if total:
            yield from settle()

    found = rows.mapInArrow(candidates, "seed bigint, start int, id bigint, key bigint, hashes array<bigint>, settled array<int>")
    # runs travel whole; rows that are settled have no seed
    found = found.withColumn("seed", F.coalesce("seed", F.xxhash64("id", "key"))).repartition("seed")
    found = found.select("seed", "id", "key", "settled", "start", F.posexplode_outer("hashes").alias("nth", "hash")).withColumn("start", F.col("start") + F.col("nth"))
    order = Window.partitionBy("seed", "hash").orderBy(F.col("id").asc_nulls_last(), "key", "start")
    found = found.withColumn("place", F.rank().over(order)).filter("place > 1 or hash is null")
    return found.groupBy("id", "key").agg(F.concat(F.collect_set("start"), F.flatten(F.collect_list("settled"))).alias("starts"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, n: int = 20) -> DataFrame:
    """``docs`` with the struct ``_kept`` added (``__kept`` and so on where the
    input has such a column): ``n_words``, ``n_removed`` and ``text`` (the words
    that stay, joined by one space)."""
    import pyspark.sql.types as T

    starts = repeated_starts(docs, id_col, text, n)
    name = free("_kept", docs.columns)
    # the text crosses the shuffle once, inside its row
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("bigint").alias("own"), F.when(F.col(text).isNotNull(), F.xxhash64(text)).alias("own_key"))
    joined = whole.join(starts, whole.own.eqNullSafe(starts.id) & (whole.own_key == starts.key), "left").select("row", "starts")
    place = docs.columns.index(text)

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(0).flatten()[place], batch.column(1)
            for lo in range(0, batch.num_rows, 64):
                out = []
                for t, s in zip(texts.slice(lo, 64), lists.slice(lo, 64), strict=True):
                    words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                    keep = words
                    if s.is_valid:
                        edge = np.zeros(len(words) + 1, np.int64)
                        at = s.values.to_numpy()
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + n, -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        keep = [w for w, ok in zip(words, stay.tolist(), strict=True) if ok]
                    out.append((len(words), len(words) - len(keep), b" ".join(keep)))
                words, gone, kept = zip(*out, strict=True)
                made = pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "text"])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 64), made], ["row", name])

    kind = T.StructType([T.StructField("row", joined.schema["row"].dataType),
                         T.StructField(name, T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())]))])
    # the columns by place: their names may clash
    out = joined.mapInArrow(mend, kind)
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], name)


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", *, n: int = 20) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of every row."""
    rows = remove_repeats(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text", n=n)
    return rows.select("doc_id", "_kept.n_words", "_kept.n_removed", F.sha2(F.col("_kept.text").cast("binary"), 256).alias("kept_sha256"))


def digests_sql(n: int = 20) -> str:
    """The same rows in DuckDB, with every window's words as its key."""
    return f"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, 1 + len(w))) AS pos
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)),
framed AS (
  SELECT *, string_agg(word, ' ') OVER f AS seq, count(*) OVER f AS size FROM words
  WINDOW f AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)),
judged AS (
  SELECT doc_id, word, pos, size = {n} AND row_number() OVER (PARTITION BY seq, size ORDER BY doc_id, pos) > 1 AS late FROM framed),
marked AS (
  SELECT *, bool_or(late) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS gone FROM judged),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id"""
