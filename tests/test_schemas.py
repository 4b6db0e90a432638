"""Table definitions and checks (D14, F14, T9), day series (F9), source options."""

import datetime as dt

import pytest

from tributary import schemas
from tributary.operators.facts import day_series
from tributary.streaming.sources import kafka_options


def test_validate_reports_missing_and_type_drift(spark):
    df = spark.createDataFrame([("a", 1)], "actorid string, current_year long")
    problems = schemas.validate(df, schemas.ACTORS_HISTORY_SCD, strict_types=True)
    assert "missing column is_active" in problems
    assert any(p.startswith("current_year: bigint != int") for p in problems)
    assert schemas.validate(df.selectExpr("*", "true AS is_active", "'x' AS quality_class",
                                          "1 AS start_date", "1 AS end_date"),
                            schemas.ACTORS_HISTORY_SCD) == []


def test_primary_key_and_enum_checks(spark):
    df = spark.createDataFrame([("a", 2020, "star"), ("a", 2021, "meh"), ("a", 2021, "bad")],
                               "actorid string, current_year int, quality_class string")
    with pytest.raises(ValueError, match="duplicate key"):
        schemas.assert_unique(df, schemas.ACTORS_KEY)
    schemas.assert_unique(df.dropDuplicates(schemas.ACTORS_KEY), schemas.ACTORS_KEY)
    assert schemas.count_not_allowed(df, "quality_class", schemas.QUALITY_CLASS) == 1


def test_day_series_is_inclusive(spark):
    days = [r.series_date for r in day_series(spark, "2023-01-02", "2023-01-31").collect()]
    assert days[0] == dt.date(2023, 1, 2) and days[-1] == dt.date(2023, 1, 31) and len(days) == 30


def test_kafka_options_sasl():
    o = kafka_options("broker:9092", "web", group="g", user="u", password="p")
    assert o["subscribe"] == "web" and o["startingOffsets"] == "latest"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="u"' in o["kafka.sasl.jaas.config"]
    assert "kafka.security.protocol" not in kafka_options("b:1", "t")


def test_scale_conf_sizes_partitions():
    from tributary.session import scale_conf
    big = scale_conf(100 << 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * (1 << 40) // (256 << 20))           # 256 MiB each; AQE coalesces
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = scale_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"              # at least 2 per core


def test_kafka_source_needs_the_connector(spark):
    """No Kafka jar in this environment: the source fails at definition
    time with Spark's deployment hint (the file source is used in tests)."""
    from pyspark.errors import AnalysisException

    from tributary.streaming.sources import read_events_stream
    with pytest.raises(AnalysisException, match="kafka"):
        read_events_stream(spark, "kafka", options=kafka_options("broker:9092", "web"))
