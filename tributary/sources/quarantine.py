"""Text sources with malformed rows.

Rows that do not fit the declared schema must neither fail the job nor vanish:
they are read permissively, told apart from good rows in the same pass, and kept
as they came in a side output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tributary.functions.text import parse_event_time

#: The raw text of a row that does not fit, and what is wrong with a row.
RAW, FAULT = "_raw", "_fault"


def read_checked_csv(spark: SparkSession, path: str, schema: StructType, *, time_col: str | None = None, time_out: str = "event_time",
                     header: bool = True) -> DataFrame:
    """CSV under a declared schema (no inference pass): the
    schema's columns, the raw text of rows that do not fit it (wrong number of
    fields, wrong type) in ``_raw``, and ``_fault``: ``malformed``, ``bad_time``
    (the text in ``time_col`` is no event time) or NULL.  With ``time_col`` its
    parsed value stands in ``time_out``."""
    wide = StructType([*schema.fields, StructField(RAW, StringType())])
    rows = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).schema(wide).csv(path)
    malformed = F.when(F.col(RAW).isNotNull(), "malformed")
    if time_col is None:
        return rows.withColumn(FAULT, malformed)
    rows = rows.withColumn(time_out, parse_event_time(time_col))
    return rows.withColumn(FAULT, F.coalesce(malformed, F.when(F.col(time_out).isNull(), "bad_time")))


def split_faults(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantine as two parts of one table at ``path``: a single
    pass over the source, each side read back without the other."""
    side = F.when(F.col(FAULT).isNull(), "good").otherwise("quarantine").alias("_side")
    checked.select("*", side).write.mode("overwrite").partitionBy("_side").parquet(path)
    read = lambda name: checked.sparkSession.read.schema(checked.select("*", side).schema).parquet(path).filter(F.col("_side") == name)
    return read("good").drop("_side", RAW, FAULT), read("quarantine").drop("_side")
