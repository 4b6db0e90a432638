"""Event deduplication on a stream (M7): state per event id is kept only
while the watermark allows a duplicate to arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedup_stream(stream: DataFrame, keys: Sequence[str], *, ts: str, delay: str = "1 hour") -> DataFrame:
    """First arrival of each key wins; duplicates arriving within ``delay``
    of event time are dropped, and state older than the watermark is evicted."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
