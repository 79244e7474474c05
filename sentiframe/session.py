"""SparkSession helpers.

Cluster settings (executor sizes, ``spark.checkpoint.dir``) come from the
session the caller already has.  ``local_session`` is for tests and the
benchmark only: it builds a local session and, where the cluster names no
checkpoint folder, points one at a fresh scratch directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sentiframe") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SENTIFRAME_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    Only in local mode, where driver and executors are one process, a scratch
    folder is created when the session names none; elsewhere that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="sentiframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared checkpoint folder; no two calls share one."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Within, the session has these settings below ``spark.sql`` (``__`` for a dot)."""
    keys = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def unsorted_writes(spark: SparkSession, writers: int = 8):
    """Within, a task keeps up to ``writers`` files open when it writes by
    partition or bucket, in place of sorting its rows by them first."""
    return settings(spark, maxConcurrentOutputFileWriters=str(writers))


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: several branches
    then start from one Parquet table, with column pruning, and a lost
    executor costs no recomputation of what came before."""
    path = shared_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written_by_key(df: DataFrame, tag: str, key: str, n: int | None = None) -> DataFrame:
    """Like ``written``, in ``n`` buckets by ``key`` (as many as shuffle
    partitions by default): readers know the partitioning, so that windows and
    groups by the key need no shuffle.  ``df`` must be dealt by
    ``repartition(n, key)``; a task then writes one bucket, and no row is
    sorted.  The table lies in the shared folder and has a name of its own."""
    spark = df.sparkSession
    path = shared_folder(spark, tag)
    name = os.path.basename(path).replace("-", "_")
    with unsorted_writes(spark):
        df.write.bucketBy(n or partitions(spark), key).option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
