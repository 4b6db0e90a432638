"""Cutting lineage through the shared folder that the session names."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Where it is unset, a local
    session (tests) gets a folder of its own; a cluster session must name a
    shared one, so there this raises."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tributary-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that
    later jobs (and a recomputation after an executor is lost) start there."""
    checkpoint_dir(df.sparkSession)
    kept = df.checkpoint(eager=True)
    release(df.sparkSession)
    return kept


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that nothing refers to any
    more.  It does so when the driver's JVM collects its garbage, which a loop of
    many small jobs may not reach before the disks are full."""
    gc.collect()
    spark._jvm.System.gc()


def drop(kept: DataFrame) -> None:
    """Delete the files of a frame made by ``cut`` that no later frame reads."""
    spark = kept.sparkSession
    file = kept._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free(name: str, columns: Sequence[str]) -> str:
    """``name`` with as many leading underscores as keep it (in any case) off
    the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
