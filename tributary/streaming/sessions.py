"""Session-window aggregation on a stream.

``session_window`` keeps open sessions in the state store until the
watermark passes their end; results are emitted in append mode (update mode
is refused for session windows).  The batch twin is
:func:`tributary.operators.sessions.sessionize`, and tests check both give
the same sessions.

Late data: Spark moves the watermark between micro-batches.  A row behind
the watermark is dropped once its session has been emitted; a late row that
arrives in the same micro-batch that closes its session still joins it
(Flink checks lateness per event).  Like the reference, there is no side
output for dropped rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessionize_stream(stream: DataFrame, ts: str = "window_timestamp", keys: Sequence[str] = ("host", "ip"),
                      gap: str = "5 minutes", *, start: str = "event_window_timestamp",
                      count: str = "num_hits") -> DataFrame:
    """Hits per session per key with an inactivity ``gap``; window start as
    the session timestamp (the reference's sink row)."""
    g = stream.groupBy(F.session_window(F.col(ts), gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias(count))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias(start), *keys,
                    F.col("w.end").cast("timestamp_ntz").alias("session_end"), count)
