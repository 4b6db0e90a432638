"""Files and physical layout.

Bucketed tables are written once and joined many times without a shuffle;
snapshots are written to new paths so a job never overwrites what it reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.session import shared_path


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header (S1).  A declared schema avoids the inference pass
    over the whole input; inference is the fallback."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def disable_auto_broadcast(spark: SparkSession) -> None:
    """Automatic broadcast off (S4); explicit ``broadcast()`` hints still
    apply."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def bucket_count(frames: Sequence[DataFrame], *, bucket_bytes: int = 256 << 20, least: int | None = None) -> int:
    """Buckets for tables that are to be joined without a shuffle: enough that
    the largest has about ``bucket_bytes`` a bucket by the planner's size
    estimate (no job runs), and at least one per core of the session."""
    sizes = [int(str(f._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for f in frames]
    return max(least or frames[0].sparkSession.sparkContext.defaultParallelism, -(-max(sizes) // bucket_bytes))


def write_bucketed(df: DataFrame, table: str, key: str | Sequence[str], buckets: int | None = None,
                   sort_cols: Sequence[str] | None = None, sort_by: bool = True, path: str | None = None) -> DataFrame:
    """Bucketed Parquet table (S5, S11): shuffle once by the bucket key into
    ``buckets`` partitions so each bucket is one file, sort inside partitions
    (``sort_cols`` picks the run-length-friendly layout), overwrite the table.

    ``buckets`` defaults to :func:`bucket_count`.  ``path`` makes the table
    external (e.g. in the shared folder); else it lies in the warehouse.
    ``sort_by`` also records the sort in the catalog so sort-merge joins on
    the key can skip their sort."""
    keys = [key] if isinstance(key, str) else list(key)
    sort_cols = list(sort_cols or keys)
    buckets = buckets or bucket_count([df])
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    w = (df.repartition(buckets, *keys).sortWithinPartitions(*sort_cols)
         .write.format("parquet").mode("overwrite").bucketBy(buckets, *keys))
    if sort_by:
        w = w.sortBy(*sort_cols)
    if path is not None:
        w = w.option("path", path)
    w.saveAsTable(table)
    return spark.table(table)


def bucketed_together(frames: Mapping[str, DataFrame], key: str | Sequence[str], *, buckets: int | None = None) -> dict[str, DataFrame]:
    """Write the frames as external tables in the shared folder, all bucketed
    and sorted by ``key`` into one number of buckets (from the largest), and read
    them back by name: joins on the key need no exchange (S5, S6)."""
    spark = next(iter(frames.values())).sparkSession
    buckets = buckets or bucket_count(list(frames.values()))
    run = uuid.uuid4().hex
    return {name: write_bucketed(df, f"bucketed_{run}_{name}", key, buckets, path=shared_path(spark, "bucketed", run, name))
            for name, df in frames.items()}


def table_bytes(df: DataFrame) -> DataFrame:
    """File count and total bytes behind a file-based DataFrame (S12), from
    the hidden ``_metadata`` column: computed by executors, no driver-side
    directory listing."""
    files = df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size")).distinct()
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write one period's snapshot to its own path and read it back: the
    written table cuts lineage for the next period and survives executor
    loss (F13, D2 folds)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_snapshot_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str],
                            buckets: int) -> DataFrame:
    """Write one period's snapshot as an external table bucketed by the
    entity ``keys`` at its own ``path`` and read it back.

    The next period's merge (``cumulate``, ``scd2_merge``,
    ``datelist_cumulate``, ``upsert``) joins this snapshot on the same keys:
    Spark reuses the bucketing, so only the new period's (small) rows are
    shuffled, never the snapshot, whose size grows with history."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table))
    return spark.table(table)


def layout_sizes(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """File count and bytes of several tables side by side (S12: the same
    data under different sort layouts).  One small row per table."""
    out = None
    for t in tables:
        r = table_bytes(spark.table(t)).select(F.lit(t).alias("table_name"), "files", "bytes")
        out = r if out is None else out.unionByName(r)
    return out


def sort_layouts(df: DataFrame, key: str, layouts: Mapping[str, Sequence[str]], *, buckets: int) -> DataFrame:
    """Write ``df`` bucketed by ``key`` under each sort layout into the shared
    folder (S11) and measure what lies there (S12): layout, ``n_rows``,
    ``n_files``, ``n_bytes``, from file metadata read by executors."""
    spark, run, out = df.sparkSession, uuid.uuid4().hex, None
    for name, cols in layouts.items():
        t = write_bucketed(df, f"layout_{run}_{name}", key, buckets, cols, sort_by=False, path=shared_path(spark, "layouts", run, name))
        files = t.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
        r = files.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"))
        r = r.select(F.lit(name).alias("layout"), "n_rows", "n_files", "n_bytes")
        out = r if out is None else out.unionByName(r)
    return out
