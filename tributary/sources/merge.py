"""Incremental merges that write only what a new period touches.

Parquet has no row-level MERGE, and writing the whole target anew costs its
whole size for every day.  Here targets are partitioned tables, and a step
replaces the partitions it touches (dynamic partition overwrite: Spark stages
the new files and swaps the partitions at commit, after the old ones were read).

* :func:`merge_partitions` upserts into the partitions that the source names.
* :func:`scd2_step` keeps a history in one partition per step: what was open
  then and what that step closed.  Earlier partitions never change, so a step
  reads one partition, writes one, and can be run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.facts import upsert
from tributary.operators.scd import scd2_merge


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Write ``df`` below ``path``; only the partitions it holds are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def merge_partitions(path: str, source: DataFrame, keys: Sequence[str], partition: str, *,
                     set_cols: Sequence[str] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` into the partitioned table at
    ``path`` (F13): reads and writes only the partitions of the source's values
    of ``partition`` (one of the keys; those of one new period, so a short
    list).  Returns the table.  A rerun with the same source changes nothing."""
    if partition not in keys:
        raise ValueError(f"{partition} must be one of the keys: a row must not change its partition")
    touched = [r[0] for r in source.select(partition).distinct().collect()]
    table = source.sparkSession.read.schema(source.schema).parquet(path).select(source.columns)
    if not touched:
        return table
    here = F.col(partition).isin([v for v in touched if v is not None])
    old = table.filter(here | F.col(partition).isNull() if None in touched else here)
    replace_partitions(upsert(old, source, keys, set_cols), path, partition)
    return source.sparkSession.read.schema(source.schema).parquet(path).select(source.columns)


def scd2_step(path: str, current: DataFrame, key: str | Sequence[str], attrs: Sequence[str], *, period: int,
              start_col: str = "start_date", end_col: str = "end_date", stamp_col: str = "current_year") -> None:
    """One period of an SCD2 history kept by step (D8): joins the rows that were
    open after ``period - 1`` with ``current`` and writes the partition
    ``period``: rows open now, and rows that this step closed.  A first step
    (no partition before) opens every key."""
    keys = [key] if isinstance(key, str) else list(key)
    spark = current.sparkSession
    columns = [*keys, *attrs, start_col, end_col, stamp_col]
    kinds = {f.name: f.dataType.simpleString() for f in current.schema}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in (*keys, *attrs)], *[f"`{c}` int" for c in (start_col, end_col, stamp_col)]])
    before = spark.read.schema(schema).parquet(path).filter((F.col(stamp_col) == period - 1) & (F.col(end_col) == period - 1))
    step = scd2_merge(before, current, keys, attrs, prev_as_of=period - 1, new_period=period, start_col=start_col, end_col=end_col, stamp_col=stamp_col)
    replace_partitions(step.select(columns), path, stamp_col)


def scd2_as_of(spark: SparkSession, path: str, period: int, *, end_col: str = "end_date", stamp_col: str = "current_year") -> DataFrame:
    """The history after ``period``: what each step up to it closed, and what is
    open in its own partition.  ``current_year`` is ``period`` throughout."""
    rows = spark.read.parquet(path).filter(F.col(stamp_col) <= period)
    rows = rows.filter((F.col(stamp_col) == period) | (F.col(end_col) < F.col(stamp_col)))
    return rows.withColumn(stamp_col, F.lit(period).cast("int"))
