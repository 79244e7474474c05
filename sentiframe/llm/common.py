"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: FIXED VALUES: the six ASCII white-space characters x20 and x09-x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: FIXED VALUES: the pattern of a word, the same in Java and RE2.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared folder the cluster names."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start
    from these files, so a lost executor costs no recomputation of what came
    before, and reads prune columns and rows as for any Parquet table."""
    spark = df.sparkSession
    path = shared_folder(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is.  ``lower`` has a fast way for pure
    ASCII strings; others go through ``translate``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def unit(h: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") * F.lit(2.0 ** -53)


def chunks(texts: list, most_chars: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts of about ``most_chars`` characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= most_chars:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
