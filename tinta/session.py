"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "tinta",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators are written for.

    Arrow batches are bounded by bytes as well as rows, because one row may hold a whole document.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small shuffles stay spread over the cores: what follows them is often costly per row
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_folder() -> tempfile.TemporaryDirectory:
    """Scratch folder of a local run without a setting; it is removed when the process ends."""
    return tempfile.TemporaryDirectory(prefix="tinta-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = _own_folder().name
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and stops the plan from growing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder as compressed columns: for wide rows that are worked out once and read again, such as by a sort, which
    first looks for its cuts."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most_bytes: int = 8 << 20) -> None:
    """Arrow batches of the session hold at most so many bytes from now on: a batch of long texts is copied several times on its way through a worker."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = re.fullmatch(r"(\d+)b?", spark.conf.get(name))
    if held is None or not 0 < int(held[1]) <= most_bytes:
        spark.conf.set(name, str(most_bytes))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a source that arrives in fewer partitions, such as one file with one row group.

    Larger inputs come back as they are: their scan is already parallel and a shuffle would only cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
