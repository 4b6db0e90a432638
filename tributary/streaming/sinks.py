"""Stream sinks and query start-up.

Each micro-batch goes through ``foreachBatch``.  The Parquet writer is
idempotent (a replayed batch overwrites its own folder), so restarts from the
checkpoint give exactly-once output.  The JDBC writer appends, as the
reference's sink does; a replayed batch may repeat rows unless the target has
a key."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tributary.session import shared_path


def jdbc_batch_writer(url: str, table: str, properties: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """Append each micro-batch to a JDBC table (PostgreSQL in the reference)."""
    props = dict(properties)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.jdbc(url=url, table=table, mode="append", properties=props)

    return write


def parquet_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to ``path/batch_id=N`` (overwrite: replay-safe)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_query(df: DataFrame, writer: Callable[[DataFrame, int], None], *, name: str,
                checkpoint: str | None = None, trigger: Mapping[str, object] | None = None,
                output_mode: str = "append"):
    """Start a streaming query with a checkpoint under the shared folder of
    ``spark.checkpoint.dir`` unless one is given (T6).  ``trigger`` is e.g.
    ``{"processingTime": "10 seconds"}`` or ``{"availableNow": True}``."""
    spark = df.sparkSession
    ckpt = checkpoint or shared_path(spark, "streams", name)
    w = (df.writeStream.queryName(name).outputMode(output_mode).foreachBatch(writer)
         .option("checkpointLocation", ckpt))
    if trigger:
        w = w.trigger(**dict(trigger))
    return w.start()


def stream_state_conf(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings for large stateful streams (session windows, dedup): RocksDB
    state store (state off the JVM heap, incremental snapshots) with
    changelog checkpointing.  The number of state partitions is fixed by
    ``spark.sql.shuffle.partitions`` when a query first starts, so size it
    before the first run."""
    conf = {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf
