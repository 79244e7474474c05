"""Mood dataset construction: filter, map, clean, resolve duplicates (A1-A3).

Scale notes
-----------
* Ratings are pre-aggregated per example id (one row per id with a count per
  class) before they meet the text table, so a hot example (one id holding a
  large share of all ratings) is collapsed map-side by partial aggregation
  and never reaches a join or group as raw rows.
* Texts are dealt by id before they meet the votes, and cleaned once per
  example after that deal: however few partitions the scan has, and whichever
  side the planner broadcasts, cleaning runs in all shuffle partitions.  The
  winners' texts come from the same exchange, which is read again.
* Duplicate resolution groups by the cleaned text with one conditional count
  per class and ``min_by(id, seq)`` for the first row: fixed-width buffers,
  hash aggregation with map-side combine; no ``collect_list`` of raw rows.
* A table that is to be stored is built from cleaned texts that are written
  once: its groups are by digest, and no text is sorted or shuffled again.
* Filters on derived text columns are applied after aggregation so Catalyst
  does not push copies of the cleaning expression into pre-join filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import EMOTIONS, MOOD_LABELS
from ..functions.labels import single_class
from ..functions.text import clean_text, light_clean_text
from ..session import partitions, written_by_key


def mood_labels(ratings: DataFrame, classes_from: list[str] | None = None) -> DataFrame:
    """Annotation rows after the unclear filter with their single class.

    Rows marked unclear are dropped (a null flag is dropped too) when the flag
    column exists.  Returns (id, seq, mood); mood is null when the row's labels
    do not map to exactly one class (P2 drops those downstream)."""
    r = ratings
    if "example_very_unclear" in r.columns:
        r = r.where(F.col("example_very_unclear") == F.lit(False))
    label_cols = [c for c in (classes_from or EMOTIONS) if c in r.columns]
    return r.select("id", "seq", single_class(label_cols).alias("mood"))


def mood_rows(ratings: DataFrame) -> DataFrame:
    """Rows that map to exactly one class: (id, seq, mood) with mood not null."""
    return mood_labels(ratings).where(F.col("mood").isNotNull())


def class_votes_per_example(labelled: DataFrame, classes: list[str] = MOOD_LABELS) -> DataFrame:
    """One row per id with at least one mapped row: a vote count per class,
    total and first seq.  Null moods do not vote."""
    votes = labelled.groupBy("id").agg(
        *[F.count(F.when(F.col("mood") == c, 1)).alias(f"n_{c}") for c in classes],
        F.count("mood").alias("n_rows"),
        F.min(F.when(F.col("mood").isNotNull(), F.col("seq"))).alias("first_seq"),
    )
    return votes.where(F.col("n_rows") > 0)


def dealt(texts: DataFrame) -> DataFrame:
    """Texts dealt by id; equal calls share one exchange."""
    return texts.repartition(partitions(texts.sparkSession), "id")


def _cleaned(votes: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts with votes, cleaned after the join, when only those with votes are
    left.  Texts that come cleaned are taken as they are."""
    joined = votes.join(dealt(texts), "id")
    return joined if "clean_text" in texts.columns else joined.withColumn("clean_text", clean_text("text"))


def _text_groups(cleaned: DataFrame, classes: list[str], by: str = "clean_text") -> DataFrame:
    """Votes per cleaned text, or per its digest."""
    return cleaned.groupBy(by).agg(
        *[F.sum(f"n_{c}").alias(f"n_{c}") for c in classes],
        F.sum("n_rows").alias("n_rows"),
        F.min("first_seq").alias("first_seq"),
        F.min_by("id", "first_seq").alias("first_id"),
        F.max(F.col("clean_text") != "").alias("_kept"),
    )


def _decide(groups: DataFrame, classes: list[str]) -> DataFrame:
    counts = [F.col(f"n_{c}") for c in classes]
    top = F.greatest(*counts) if len(counts) > 1 else counts[0]
    n_top = sum((c == top).cast("int") for c in counts)
    winner = F.coalesce(*[F.when(F.col(f"n_{c}") == top, F.lit(c)) for c in classes])
    kept = F.col("_kept")
    return groups.select(
        "*", n_top.alias("_n_top"),
        F.when(kept & (n_top == 1), winner).alias("_winner"),
        F.when(kept, F.col("n_rows")).otherwise(F.lit(0)).alias("_kept_rows"),
        F.when(kept & (n_top > 1), F.col("n_rows")).otherwise(F.lit(0)).alias("_tie_rows"))


def _winners(groups: DataFrame, by: str, classes: list[str]) -> DataFrame:
    decided = _decide(groups, classes)
    return decided.where(F.col("_winner").isNotNull()).select(
        F.col("first_id").alias("id"), F.col("first_seq").alias("seq"), by, F.col("_winner").alias("mood"))


def resolve_duplicates(labelled: DataFrame, texts: DataFrame,
                       classes: list[str] = MOOD_LABELS, stored: bool = False) -> DataFrame:
    """Majority vote per cleaned text (A1).

    ``labelled``: (id, seq, mood) annotation rows; ``texts``: (id, text)
    examples, cleaned here unless they carry ``clean_text``.
    A group whose top count is shared by two or more classes is dropped.
    Otherwise the first row (lowest ``seq``) supplies id/text/bert_text and
    the winning class is the mood.  The aggregation buffer holds only
    fixed-width values (hash aggregation); the text of the first row is
    fetched by id afterwards.

    ``stored``: the same rows for a table that is to be stored.  Cleaned texts
    are written once, in buckets by id; groups read only the SHA-256 of each,
    and winners meet the texts where these lie, so that texts are shuffled once
    and never sorted.
    """
    votes = class_votes_per_example(labelled, classes)
    if not stored:
        winners = _winners(_text_groups(_cleaned(votes, texts), classes), "clean_text", classes)
        found = winners.join(dealt(texts).select("id", "text"), "id")
    else:
        cleaned = _cleaned(votes.hint("shuffle_hash"), texts).select(
            "id", "text", "clean_text", F.unhex(F.sha2("clean_text", 256)).alias("_key"),
            *[f"n_{c}" for c in classes], "n_rows", "first_seq")
        cleaned = written_by_key(cleaned, "cleaned", "id")
        winners = _winners(_text_groups(cleaned, classes, "_key"), "_key", classes)
        rows = cleaned.select("id", "text", "clean_text")
        if not cleaned.groupBy("id").count().where(F.col("count") > 1).isEmpty():
            # an id with several texts: each of them goes with the group's cleaned text
            own = cleaned.groupBy("id", "_key").agg(F.min("clean_text").alias("clean_text"))
            winners, rows = winners.join(own, ["id", "_key"]), rows.drop("clean_text")
        found = winners.hint("shuffle_hash").join(rows, "id")
    return found.select("id", "seq", "text", "clean_text", light_clean_text("text").alias("bert_text"), "mood")


def processed_dataset(ratings: DataFrame, examples: DataFrame,
                      classes: list[str] = MOOD_LABELS, stored: bool = False) -> DataFrame:
    """ratings + examples -> (id, seq, text, clean_text, bert_text, mood)."""
    return resolve_duplicates(mood_labels(ratings), examples.select("id", "text"), classes, stored)


def pipeline_stats(ratings: DataFrame, examples: DataFrame,
                   classes: list[str] = MOOD_LABELS) -> DataFrame:
    """One row of row accounting (A2): raw, mapped, before / after dedup,
    rows dropped in tied groups."""
    spark = ratings.sparkSession
    votes = class_votes_per_example(mood_labels(ratings), classes)
    with_text = votes.join(examples.where(F.col("text").isNotNull()).select("id"), "id")
    decided = _decide(_text_groups(_cleaned(votes, examples.select("id", "text")), classes), classes)
    summary = decided.agg(
        F.coalesce(F.sum("_kept_rows"), F.lit(0)).alias("rows_before_dedup"),
        F.count("_winner").alias("rows_after_dedup"),
        F.coalesce(F.sum("_tie_rows"), F.lit(0)).alias("dropped_tie_rows"),
    )
    return spark.range(1).select(
        ratings.select(F.count(F.lit(1))).scalar().alias("raw_rows"),
        with_text.select(F.coalesce(F.sum("n_rows"), F.lit(0))).scalar().alias("mapped_rows"),
        summary.select("rows_before_dedup").scalar().alias("rows_before_dedup"),
        summary.select("rows_after_dedup").scalar().alias("rows_after_dedup"),
        summary.select("dropped_tie_rows").scalar().alias("dropped_tie_rows"),
    )


def class_counts(processed: DataFrame, class_col: str = "mood") -> DataFrame:
    """Rows per class (A3)."""
    return processed.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"))


def label_ids(processed: DataFrame, labels: list[str] = MOOD_LABELS,
              class_col: str = "mood") -> DataFrame:
    """Attach the position id of each row's class (L2)."""
    from ..functions.labels import label_position
    return processed.select("id", class_col, label_position(class_col, labels).alias("label"))
