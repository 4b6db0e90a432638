"""Stream sources.

The reference reads JSON web-traffic messages from Kafka over SASL_SSL,
starting at the latest offset.  The same parsing runs on a file source in
tests (this environment has no Kafka connector jar)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tributary.functions.text import parse_event_time

# Fixed value: the message schema of the web-traffic topic.
WEB_EVENT_SCHEMA = StructType([StructField(c, StringType(), True)
                               for c in ("ip", "event_time", "referrer", "host", "url", "geodata")])


def kafka_options(bootstrap: str, topic: str, *, group: str | None = None, user: str | None = None,
                  password: str | None = None, starting: str = "latest") -> dict[str, str]:
    """Kafka source options: SASL_SSL / PLAIN when credentials are given."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if group:
        opts["kafka.group.id"] = group
    if user is not None:
        opts.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": ("org.apache.kafka.common.security.plain.PlainLoginModule required "
                                       f'username="{user}" password="{password}";'),
        })
    return opts


def parse_web_events(raw: DataFrame, *, value_col: str | None = "value", watermark: str | None = "15 seconds",
                     ts_out: str = "window_timestamp") -> DataFrame:
    """JSON text -> typed columns, event time from text (malformed -> NULL),
    and the watermark on it (T2, T3).  With ``value_col=None`` the input
    already has the six string columns (file sources)."""
    if value_col is not None:
        raw = raw.select(F.from_json(F.col(value_col).cast("string"), WEB_EVENT_SCHEMA).alias("m")).select("m.*")
    df = raw.withColumn(ts_out, parse_event_time("event_time"))
    if watermark:
        df = df.withWatermark(ts_out, watermark)
    return df


def read_events_stream(spark: SparkSession, source: str = "kafka", *, options: Mapping[str, str] | None = None,
                       path: str | None = None, watermark: str | None = "15 seconds",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Web-traffic stream with event time and watermark.

    ``source="kafka"`` uses ``options`` (see :func:`kafka_options`);
    ``source="json"`` reads JSON lines from ``path`` with the fixed schema."""
    if source == "kafka":
        raw = spark.readStream.format("kafka").options(**dict(options or {})).load()
        return parse_web_events(raw, value_col="value", watermark=watermark)
    r = spark.readStream.schema(WEB_EVENT_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.format(source).load(path)
    return parse_web_events(raw, value_col=None, watermark=watermark)
