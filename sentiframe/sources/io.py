"""Sources and sinks (S1-S5, S8-S11) with explicit schemas; stored results
(S6, S7, S12) are in versions.py.

Readers never infer schemas; writers overwrite whole outputs.  Paths on a
cluster must be shared storage; the only default location this module uses
is the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABELLED_TSV_SCHEMA = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("labels", T.StringType()),
    T.StructField("id", T.StringType()),
])


def scan_parts(spark: SparkSession, paths: str | list[str], schema: T.StructType,
               sep: str = ",", header: bool = True, multi_line: bool = False) -> DataFrame:
    """Scan delimited parts of one layout with an explicit schema.

    ``multi_line`` is for texts with line breaks; without it large files are
    split.  A missing path fails with PATH_NOT_FOUND."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("multiLine", multi_line).option("escape", '"').csv(paths))


def scan_by_name(spark: SparkSession, paths: list[str], schema: T.StructType, sep: str = ",") -> DataFrame:
    """Union headered parts of different layouts by column name.

    Each part's columns are named by its own header, cast to the schema's
    types, and put in its order; a column that a part lacks is null there, and
    so is an empty field, quoted or not.
    Parts are taken in sorted order and a missing one is an error."""
    parts = []
    for path in sorted(paths):
        part = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("escape", '"').csv(path)
        known = [f for f in schema.fields if f.name in part.columns]
        parts.append(part.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in known]))
    return union_parts(parts, schema)


def union_parts(parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Concatenate parts by column name; columns missing in a part are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    have = set(out.columns)
    return out.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_label_list(spark: SparkSession, path: str) -> DataFrame:
    """Line-per-label file -> (idx, label), idx = line position."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.col("value"), "\n")).alias("idx", "label")).where(
        F.col("label") != "")


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """JSON object {group: [members]} -> (group, member) rows."""
    whole = spark.read.text(path, wholetext=True)
    m = F.from_json(F.col("value"), "map<string,array<string>>")
    return (whole.select(F.explode(m).alias("group", "members"))
            .select("group", F.explode("members").alias("member")))


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    """Delimited sink with header (S8) or headerless TSV."""
    (df.write.mode("overwrite").option("header", header).option("sep", sep).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_text(lines: DataFrame, path: str, order_col: str, value_col: str) -> None:
    """Ordered single-column text sink (S10), e.g. a report or a label list:
    sorted by range, so part files in name order hold the lines in order."""
    lines.orderBy(order_col).select(value_col).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON-lines sink (S11), one object per row (e.g. a metrics record)."""
    df.write.mode("overwrite").json(path)
