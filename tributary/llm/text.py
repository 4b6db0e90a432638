"""Vectorised word hashing over Arrow string columns, for use inside tasks.

A word is a run of bytes other than space and ``\\x09-\\x0D``.  ``A-Z`` count
as lower case.  Word hashes are 64 bit; a text of any length is processed in
blocks of about ``BLOCK`` bytes cut at white space, so the working memory is a
fixed multiple of the block plus 24 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every output bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as the empty text."""
    a = batch.column(batch.schema.get_field_index(name))
    if a.null_count:
        a = a.fill_null("")
    if pa.types.is_string(a.type):
        a = a.cast(pa.large_string())
    raw, data = a.buffers()[1], a.buffers()[2]
    offs = np.frombuffer(raw, dtype=np.int64)[a.offset:a.offset + len(a) + 1] if raw is not None and len(a) else np.zeros(len(a) + 1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offs


def doc_blocks(offs: np.ndarray, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs ``(i, j)`` of texts that hold at most ``limit`` bytes together, or
    one longer text alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Word boundaries and hashes; one instance per task."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20240229)          # any fixed seed: only equality of hashes matters
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
        self.value = self.value[lower_table()]
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.base, self.inverse = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, 2 * BLOCK)
            for name, r in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, r, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def piece(self, buf: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end of every word of ``buf``; no word spans a break."""
        n = len(buf)
        self.powers(n)
        word = ~self.space.take(buf)
        edge = np.empty(n + 1, bool)
        edge[0], edge[n] = True, True
        edge[1:n] = word[1:] != word[:-1]
        edge[breaks] = True
        at = np.flatnonzero(edge)
        keep = word[at[:-1]]
        s, e = at[:-1][keep], at[1:][keep]
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.multiply(self.value.take(buf), self.up[:n], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        return mix((total[e] - total[s]) * self.down[s] + (e - s).astype(np.uint64)), s, e

    def split(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start and end in ``buf`` and text number of every word of the
        texts ``buf[offs[i]:offs[i + 1]]``, in order."""
        hs, ss, es = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        lo, end = int(offs[0]), int(offs[-1])
        while lo < end:
            hi = min(end, lo + BLOCK)
            if hi < end:                                  # cut at a text's end or at white space
                k = int(np.searchsorted(offs, hi, side="right")) - 1
                if offs[k] > lo:
                    hi = int(offs[k])
                else:
                    stop = int(offs[k + 1])
                    cut = np.flatnonzero(self.space[buf[lo:hi]])
                    while not len(cut) and hi < stop:
                        more = min(stop, hi + BLOCK)
                        cut = np.flatnonzero(self.space[buf[hi:more]]) + (hi - lo)
                        hi = more
                    hi = lo + int(cut[-1]) + 1 if len(cut) else hi
            inside = offs[np.searchsorted(offs, lo):np.searchsorted(offs, hi, side="right")]
            h, s, e = self.piece(buf[lo:hi], inside - lo)
            hs.append(h), ss.append(s + lo), es.append(e + lo)
            lo = hi
        h, s, e = map(np.concatenate, (hs, ss, es))
        return h, s, e, np.searchsorted(offs, s, side="right") - 1


def shingles(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``n``-word shingles and the text number of each.  A text
    of fewer words has one shingle of all its words."""
    odd = [U(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
    m = len(h) - n + 1
    if m > 0:
        full = np.flatnonzero(doc[:m] == doc[n - 1:])
        x = h[full] * odd[0]
        for k in range(1, n):
            x = x + h[full + k] * odd[k]
        x, d = mix(x), doc[full]
    else:
        x, d = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        size = np.diff(np.r_[first, len(doc)])
        short = size < n
        if short.any():
            f, sz = first[short], size[short]
            y = sz.astype(np.uint64)
            for k in range(n - 1):
                has = sz > k
                y[has] += h[f[has] + k] * odd[k]
            x, d = np.concatenate([x, mix(y)]), np.concatenate([d, doc[f]])
    return x, d
