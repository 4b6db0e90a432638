"""Stable hashing for identifiers and experiment buckets.

md5 is stable across processes and engines, unlike Python's salted hash()."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def user_hash(col: Column | str, salt: str | Column | None = None) -> Column:
    """First 32 bits of md5(text) as a non-negative long."""
    c = F.col(col) if isinstance(col, str) else col
    txt = c.cast("string")
    if salt is not None:
        s = F.lit(salt) if isinstance(salt, str) else salt
        txt = F.concat(s, F.lit(":"), txt)
    return F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("long")


def bucket_of(col: Column | str, salt: str | Column | None = None, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from the stable hash."""
    return F.pmod(user_hash(col, salt), F.lit(buckets))
