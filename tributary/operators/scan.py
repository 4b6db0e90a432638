"""Ordered segments: the first phase of a two-phase scan over a key's rows.

Operators that walk a key's rows in order (sessions, stretches, streaks,
histories) cannot hold the key in one window partition: a hot key may own a
third of the table.  Here the rows are range-partitioned by (keys, order), so
every partition holds about the same number of rows, wherever a key or a moment
is crowded.  The partition number becomes the *segment*: within a key segments
are consecutive in order, so windows per (segment, key) do the local work, and a
key has at most as many segments as there are partitions.  The second phase
combines one small summary per (key, segment) and carries it across.

The order needs no ties for an even split; ``monotonically_increasing_id`` is
added where the caller's order may repeat.  Range bounds are sampled per
execution, so a frame with segments must be used in one branch of a plan only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, segment: str = "_seg",
                     unique: bool = False) -> DataFrame:
    """``df`` with its segment number.  ``unique``: the order has no ties within
    a key; otherwise rows that are equal in it are split too."""
    cols = [*keys, *order]
    if unique:
        return df.repartitionByRange(*cols).withColumn(segment, F.spark_partition_id())
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    return tied.repartitionByRange(*cols, "_tie").drop("_tie").withColumn(segment, F.spark_partition_id())
