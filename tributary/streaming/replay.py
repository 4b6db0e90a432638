"""Bounded replay of a table through a stream.

A stream cannot be collected, so its result is checked by replaying a table: the
rows are delivered in slices of event time into a folder in the shared storage;
each delivery starts the stream from its checkpoint with ``availableNow``, lets
it run dry and ends it.  Every slice after the first is thus a restart in the
middle, with the open state (sessions, seen ids) read from the checkpoint.
Output goes through the idempotent batch writer and is read back as a table.

With ``redeliver`` every delivery repeats the one before (at-least-once
sources).  With ``close`` a last row far behind all others moves the watermark
past every open window, so that what the stream held back is written; its own
window starts after the last event and is left out of the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.sessions import from_micros, to_micros
from tributary.session import shared_path
from tributary.streaming.sinks import parquet_batch_writer, start_query


def replay(rows: DataFrame, ts: str, pipeline: Callable[[DataFrame], DataFrame], *, name: str, slices: int = 2,
           redeliver: bool = False, close: str | None = None) -> DataFrame:
    """Rows that ``pipeline`` (a stream of ``rows`` in, a stream out) writes for
    the whole table.

    ``ts`` is the event time, ``timestamp_ntz`` or ``timestamp``; the stream sees
    it as ``timestamp`` (V8).  ``close`` names the output's window start, and asks
    for the closing row.  ``files_per_batch`` bounds the files of a micro-batch.
    Slices follow the event time, so no first delivery is late."""
    spark = rows.sparkSession
    folder = shared_path(spark, "replay", f"{name}-{uuid.uuid4().hex}")
    inbox, outbox = f"{folder}/in", f"{folder}/out"
    us = to_micros(ts)
    cuts = [k / slices for k in range(1, slices)]
    stats = rows.agg(F.max(us).alias("last"), *([F.percentile_approx(us, cuts).alias("cuts")] if cuts else [])).first()
    edges = [None, *((stats["cuts"] or []) if cuts else []), None]
    typed = rows.withColumn(ts, F.col(ts).cast("timestamp"))

    def part(k: int) -> DataFrame:
        lo, hi = edges[k], edges[k + 1]
        cond = F.lit(True) if lo is None else us >= lo
        if hi is not None:
            cond = cond & (us < hi)
        return typed.filter(F.coalesce(cond, F.lit(lo is None)))       # no time: with the first

    reader = spark.readStream.schema(typed.schema)

    def deliver(batch: DataFrame):
        batch.write.mode("append").parquet(inbox)
        sink = pipeline(reader.parquet(inbox))
        query = start_query(sink, parquet_batch_writer(outbox), name=f"{name}-{uuid.uuid4().hex}", checkpoint=f"{folder}/checkpoint", trigger={"availableNow": True})
        query.awaitTermination()
        return sink.schema

    schema = None
    for k in range(len(edges) - 1):
        schema = deliver(part(k).unionByName(part(k - 1)) if redeliver and k else part(k))
    if close is not None:
        end = F.lit((stats["last"] or 0) + 30 * 86_400_000_000)
        schema = deliver(spark.range(1).select(*[(from_micros(end).cast("timestamp") if f.name == ts else F.lit(None).cast(f.dataType)).alias(f.name) for f in typed.schema]))
    out = spark.read.schema(schema).parquet(f"{outbox}/batch_id=*")
    return out if close is None else out.filter(to_micros(close) <= F.lit(stats["last"] or 0))
