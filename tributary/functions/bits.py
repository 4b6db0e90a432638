"""Datelist bit masks (F8).  Bit 31 is the as-of day, bit 0 is 31 days
earlier (X7: the reference's exponent 32 - days overflows BIT(32)).

For histories beyond 32 days, activity bitmaps: one bit a day since an anchor,
built and merged by Spark's bitmap aggregates (fixed size, partial on the map
side, no day list is ever held)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def datelist_mask(dates: Column | str, as_of: Column | str) -> Column:
    """OR of 2^(31 - days_before_as_of) over distinct dates within 0..31 days.

    Pure array arithmetic on the row: no day series, no cross join."""
    arr = F.col(dates) if isinstance(dates, str) else dates
    ref = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    recent = F.filter(
        F.array_distinct(arr),
        lambda d: (F.datediff(ref, d) >= 0) & (F.datediff(ref, d) <= 31),
    )
    return F.aggregate(
        recent, F.lit(0).cast("long"),
        lambda acc, d: acc + F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(31) - F.datediff(ref, d)),
    )


def mask_bits(mask: Column | str) -> Column:
    """The mask rendered as 32 characters of 0/1 (BIT(32) text)."""
    m = F.col(mask) if isinstance(mask, str) else mask
    return F.lpad(F.bin(m), 32, "0")


#: Days that one bitmap holds (Spark's bitmap aggregates have a fixed size).
BITMAP_DAYS = 32_768


def day_number(day: Column | str, anchor: str) -> Column:
    """Days since ``anchor`` (bit 0); days before it are NULL."""
    d = F.col(day) if isinstance(day, str) else day
    n = F.datediff(d, F.to_date(F.lit(anchor)))
    return F.when(n >= 0, n).cast("long")


def activity_bitmaps(df: DataFrame, keys: Sequence[str], day: Column, *, anchor: str, out: str = "bitmap") -> DataFrame:
    """One bitmap per key and span of ``BITMAP_DAYS`` days (``span``, 0 first):
    the days on which the key occurs.  Repeated days count once."""
    n = day_number(day, anchor)
    rows = df.select(*keys, F.floor(n / BITMAP_DAYS).alias("span"), (n % BITMAP_DAYS).alias("_bit")).filter("_bit is not null")
    return rows.groupBy(*keys, "span").agg(F.bitmap_construct_agg("_bit").alias(out))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str], *, col: str = "bitmap") -> DataFrame:
    """Bitmaps of several periods or sources in one per key and span (OR)."""
    return bitmaps.groupBy(*keys, "span").agg(F.bitmap_or_agg(col).alias(col))


def days_active(bitmap: Column | str) -> Column:
    """Number of days set."""
    return F.bitmap_count(bitmap)


def bitmap_days_hex(bitmap: Column | str, days: int) -> Column:
    """The first ``days`` bits as hexadecimal bytes, lowest bit of a byte first
    day (a NULL-free rendering for reports and tests)."""
    b = F.col(bitmap) if isinstance(bitmap, str) else bitmap
    return F.hex(F.substring(b, 1, -(-days // 8)))
