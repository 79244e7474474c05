"""Reusable results: versioned folders with an atomic publication.

A stored result lives in a folder of versions.  A new version is written to a
folder of its own; when it is complete, an empty marker file is created whose
name holds the version's number and folder.  Creating a file is atomic on
every file system, so readers see the old version until the new one is whole,
and a crash in between leaves the old one in place.  The highest number is the
current version.  Two writers that race both publish whole versions.

``fingerprint`` names the state of the input files, so that a result is reused
only for the inputs it was made from.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, unsorted_writes

MARK = "_current"


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _published(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, version folder) of every published version, in order."""
    fs, target = _files(spark, folder)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    marks = [n.split(".", 2) for n in names if n.startswith(MARK + ".")]
    return sorted((int(number), version) for _, number, version in marks)


def current(spark: SparkSession, folder: str) -> str | None:
    """Path of the current version, None if nothing is published."""
    published = _published(spark, folder)
    return os.path.join(folder, published[-1][1]) if published else None


def publish(spark: SparkSession, folder: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new version folder, then make it the current one."""
    version = f"v-{uuid.uuid4().hex}"
    write(os.path.join(folder, version))
    published = _published(spark, folder)
    number = published[-1][0] + 1 if published else 1
    fs, mark = _files(spark, os.path.join(folder, f"{MARK}.{number:08d}.{version}"))
    fs.create(mark, False).close()
    return os.path.join(folder, version)


def reuse_or_write(spark: SparkSession, folder: str, write: Callable[[str], None], force: bool = False) -> str:
    """Path of the current version, which is written first if there is none."""
    return (None if force else current(spark, folder)) or publish(spark, folder, write)


def load_or_build(spark: SparkSession, folder: str, build: Callable[[], DataFrame], required: set[str],
                  force_rebuild: bool = False, partition_by: str | None = None) -> DataFrame:
    """The stored table if it has the required columns, else ``build`` it,
    store it and read it back (S6, S7).

    Only an unpublished table, or one without the columns, leads to a build;
    a failure to read a published one is raised and nothing is replaced."""
    path = None if force_rebuild else current(spark, folder)
    if path is not None:
        stored = spark.read.parquet(path)
        if required <= set(stored.columns):
            return stored

    def write(to: str) -> None:
        writer = build().write.option("compression", "zstd")
        with unsorted_writes(spark):  # whole texts are not sorted by their partition
            (writer.partitionBy(partition_by) if partition_by else writer).parquet(to)

    return spark.read.parquet(publish(spark, folder, write))


def fingerprint(*tables: DataFrame) -> str:
    """A digest of the files behind Parquet tables (path, size, time of change),
    put together by Spark from what the scans know of them: no column is read."""
    parts = []
    for t in tables:
        files = t.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        one = F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(20,0)")
        parts.append(files.agg(F.count(F.lit(1)), F.sum(one), F.sum("file_size")).head())
    return uuid.uuid5(uuid.NAMESPACE_URL, repr([[str(x) for x in p] for p in parts])).hex


def folder(spark: SparkSession, name: str, *tables: DataFrame) -> str:
    """Folder of the stored result ``name`` made from ``tables``, below the
    shared folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "stored", f"{name}-{fingerprint(*tables)}")
