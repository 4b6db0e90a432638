"""Structured Streaming: sources, session-window aggregation, deduplication
and idempotent sinks (SURVEY §2.4 T1-T6, §2.7 M7)."""

from tributary.streaming.sources import read_events_stream, parse_web_events, WEB_EVENT_SCHEMA  # noqa: F401
from tributary.streaming.sessions import sessionize_stream  # noqa: F401
from tributary.streaming.sinks import (  # noqa: F401
    jdbc_batch_writer, parquet_batch_writer, start_query, stream_state_conf,
)
from tributary.streaming.dedup import dedup_stream  # noqa: F401
from tributary.streaming.replay import replay  # noqa: F401
