"""Label taxonomy replacement.

A taxonomy maps new group labels to lists of old labels.  The new label list
is the sorted union of the group names and the old labels no group covers;
a label's id is its position.  Label lists are label-sized: ranking them
globally is bounded by the number of labels, never by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import EKMAN_MAPPING, EMOTIONS
from ..functions.labels import id_list


def new_label_table(spark: SparkSession, old_labels: list[str] = EMOTIONS,
                    mapping: dict[str, list[str]] = EKMAN_MAPPING) -> DataFrame:
    """(idx, label) of the new taxonomy built with DataFrame operations:
    explode the mapping, anti-join the old labels (J5), union, rank (W4)."""
    old = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in old_labels])).alias("label"))
    pairs = [(g, m) for g, ms in mapping.items() for m in ms]
    members = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(g).alias("grp"), F.lit(m).alias("member")) for g, m in pairs])).alias("p")
    ).select("p.*")
    uncovered = old.join(members, old["label"] == members["member"], "left_anti")
    groups = members.select(F.col("grp").alias("label")).distinct()
    labels = groups.unionByName(uncovered).distinct()
    return labels.select((F.row_number().over(Window.orderBy("label")) - 1).alias("idx"), "label")


def old_to_new_ids(old_labels: list[str] = EMOTIONS,
                   mapping: dict[str, list[str]] = EKMAN_MAPPING) -> dict[int, int]:
    """Old id -> new id: the first group containing the old label, else the
    old label itself (uncovered labels keep their own name)."""
    covered = {m for ms in mapping.values() for m in ms}
    new_labels = sorted(set(mapping) | {x for x in old_labels if x not in covered})
    pos = {x: i for i, x in enumerate(new_labels)}
    out = {}
    for i, x in enumerate(old_labels):
        group = next((g for g, ms in mapping.items() if x in ms), x)
        out[i] = pos[group]
    return out


def replace_labels(rows: DataFrame, old_labels: list[str] = EMOTIONS,
                   mapping: dict[str, list[str]] = EKMAN_MAPPING, dedupe: bool = False) -> DataFrame:
    """Rewrite the comma-separated old ids of every row to new ids (L4).

    Order and duplicates are kept by default (two old labels in one group
    give e.g. '0,0'); ``dedupe=True`` drops repeats.  A row whose result is
    empty fails the job, as the reference asserts."""
    lookup = old_to_new_ids(old_labels, mapping)
    m = F.create_map(*[x for k, v in lookup.items() for x in (F.lit(k), F.lit(v))])
    new_ids = F.transform(id_list("labels"), lambda x: m[x])
    if dedupe:
        new_ids = F.array_distinct(new_ids)
    checked = F.when(F.size(new_ids) > 0, new_ids).otherwise(
        F.raise_error(F.lit("label replacement produced an empty label list")))
    return rows.withColumn("new_labels", F.array_join(checked, ","))


def label_usage(rows: DataFrame, spark: SparkSession, old_labels: list[str] = EMOTIONS,
                mapping: dict[str, list[str]] = EKMAN_MAPPING) -> DataFrame:
    """New taxonomy (idx, label) with the number of label occurrences in the
    rows after replacement (0 when unused)."""
    replaced = replace_labels(rows, old_labels, mapping)
    uses = (replaced.select(F.explode(F.split("new_labels", ",")).alias("idx"))
            .groupBy(F.col("idx").cast("int").alias("idx")).agg(F.count(F.lit(1)).alias("n_uses")))
    labels = new_label_table(spark, old_labels, mapping)
    return labels.join(uses, "idx", "left").select("idx", "label",
                                                   F.coalesce("n_uses", F.lit(0)).alias("n_uses"))
