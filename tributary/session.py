"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (oracle parity), AQE for runtime
# re-planning (partition coalescing, skew-join splitting, SMJ->BHJ demotion).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tributary", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the submitter owns the session; the
    operators only read settings from whatever session they are given."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster session must name a folder there that driver and executors share;
    only a local session (tests) gets a scratch folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = fallback or tempfile.mkdtemp(prefix="tributary-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for snapshots written to cut
    lineage, streaming checkpoints, bucketed scratch tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def scale_conf(input_bytes: int, total_cores: int, *, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a job reading ``input_bytes`` on ``total_cores``.

    * scan splits and AQE's advisory shuffle partition size of
      ``partition_bytes`` (default 256 MiB), so a task's input fits in memory
      and spills little;
    * initial shuffle partitions = input / partition size (at least 2 per
      core); AQE coalesces what turns out small
      after filters and partial aggregation;
    * a partition counts as skewed above 2 x that size (and 5 x the median),
      and AQE splits it in sort-merge joins.

    For 100 TB on 1000 executors x 8 cores this gives 256 MiB scan splits
    and some 373,000 initial shuffle partitions, coalesced at run time."""
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }
