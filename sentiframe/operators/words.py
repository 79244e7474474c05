"""Characteristic words per label: counts, log-odds with prior, top-k
(A17-A19, W3, J6, J7).

Word counts run over annotation rows (an example's words count once per
rater).  Instead of tokenising the text once per annotation row, each
example is tokenised once and its words are weighted by the number of
annotation rows of that example - the same sums, with tokenisation cost
proportional to distinct examples.

All labels are scored in one pass: group + rest = all, so with T the total
count of a word and N the total of all words, the other group's count is
T - c1 and its total N - n1; the prior is T (total N).  One
``groupBy(label, word)`` plus label-sized totals replace a scan per label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import AGREEMENT_MIN, EMOTIONS, LOG_ODDS_MIN_Z
from ..functions.text import analysis_tokens
from ..session import partitions, written
from .agreement import agreed


def example_word_counts(examples: DataFrame) -> DataFrame:
    """(id, word, n): analysis-token counts per example (A17 per example).
    Texts are dealt by id before their words are exploded, so neither the
    counts nor a later join by id shuffles words."""
    toks = examples.select("id", "text").repartition("id").select("id", F.explode(analysis_tokens("text")).alias("word"))
    return toks.groupBy("id", "word").agg(F.count(F.lit(1)).alias("n"))


def rows_per_example(ratings: DataFrame, labels: list[str] = EMOTIONS,
                     min_agreement: int = AGREEMENT_MIN) -> DataFrame:
    """(id, n_rows, agreement string) over all annotation rows."""
    sums = ratings.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"),
                                     *[F.sum(e).alias(e) for e in labels])
    return sums.select("id", "n_rows", agreed(labels, min_agreement).alias("agreement"))


def word_rows(examples: DataFrame, per_ex: DataFrame) -> DataFrame:
    """Every occurrence of a word with its example's row of ``per_ex`` (one row
    per id).  Texts are dealt by id before they are tokenised, however few tasks
    the scan has; sums by word are added up map-side, without a table of
    (example, word), so a task's memory follows its distinct words."""
    texts = examples.select("id", "text").repartition(partitions(examples.sparkSession), "id")
    columns = [c for c in per_ex.columns if c != "id"]
    return texts.join(per_ex, "id").select(*columns, F.explode(analysis_tokens("text")).alias("word"))


def word_counts(ratings: DataFrame, examples: DataFrame) -> DataFrame:
    """Total count per word over all annotation rows."""
    per_ex = rows_per_example(ratings).select("id", "n_rows")
    return word_rows(examples, per_ex).groupBy("word").agg(F.sum("n_rows").alias("n"))


def agreed_members(labels: list[str] = EMOTIONS, match: str = "exact") -> Column:
    """The labels an example belongs to, as an array, off its ``agreement``.

    ``exact``: the label is in the agreed set.  ``contains``: the label occurs
    as a substring of the comma-joined agreed set (parity mode: 'approval'
    then also matches 'disapproval').  The label list is a literal array, so
    membership is a per-row higher-order function, not a join."""
    names = F.array(*[F.lit(e) for e in labels])
    if match == "exact":
        return F.filter(F.split(F.col("agreement"), ","), lambda x: x != "")
    if match == "contains":
        return F.filter(names, lambda x: F.instr(F.col("agreement"), x) > 0)
    raise ValueError(f"match must be 'exact' or 'contains', not {match!r}")


def label_membership(ratings: DataFrame, labels: list[str] = EMOTIONS, match: str = "exact",
                     min_agreement: int = AGREEMENT_MIN) -> DataFrame:
    """(id, label) for every label an example belongs to (``agreed_members``)."""
    per_ex = rows_per_example(ratings, labels, min_agreement)
    return per_ex.select("id", F.explode(agreed_members(labels, match)).alias("label"))


def log_odds(ratings: DataFrame, examples: DataFrame, labels: list[str] = EMOTIONS,
             match: str = "exact", zscore: bool = True,
             min_z: float | None = LOG_ODDS_MIN_Z) -> DataFrame:
    """Log-odds ratio with informative prior per (label, word).

    Returns (emotion, word, z, freq) with ``z >= min_z`` (3 by default).  Texts
    are tokenised once: an occurrence counts for every label of its example and
    for all words together, and these counts, at most one row per label and
    distinct word, are written.  Words a label never uses always score <= 0, so
    the thresholded output needs only the (label, word) pairs that occur.
    ``min_z=None`` keeps every occurring pair.
    """
    groups = F.concat(F.array(F.lit(-1)), F.transform(agreed_members(labels, match), lambda x: F.array_position(
        F.array(*[F.lit(e) for e in labels]), x).cast("int") - 1))  # -1: all words
    per_ex = rows_per_example(ratings, labels).select("id", "n_rows", groups.alias("groups"))
    rows = word_rows(examples, per_ex).select("n_rows", "word", F.explode("groups").alias("group"))
    counts = written(rows.groupBy("group", "word").agg(F.sum("n_rows").alias("n")), "word-counts")
    totals = counts.where(F.col("group") < 0).select("word", F.col("n").alias("t"))
    n_all = totals.select(F.sum("t")).scalar()
    names = F.array(*[F.lit(e) for e in labels])
    c1 = counts.where(F.col("group") >= 0).select(F.get(names, F.col("group")).alias("label"), "word", F.col("n").alias("c1"))
    # label-sized: at most len(labels) rows
    n1 = c1.groupBy("label").agg(F.sum("c1").alias("n1"))
    j = c1.join(totals, "word").join(F.broadcast(n1), "label")
    c1c, t, n1c = F.col("c1").cast("double"), F.col("t").cast("double"), F.col("n1").cast("double")
    big_n = n_all.cast("double")
    c2, n2 = t - c1c, big_n - n1c
    l1 = (c1c + t) / ((n1c + big_n) - (c1c + t))
    l2 = (c2 + t) / ((n2 + big_n) - (c2 + t))
    sigma = F.sqrt(F.lit(1.0) / (c1c + t) + F.lit(1.0) / (c2 + t))
    delta = F.log(l1) - F.log(l2)
    z = delta / sigma if zscore else delta
    out = j.select(F.col("label").alias("emotion"), "word",
                   F.when(t == 0, F.lit(0.0)).otherwise(z).alias("z"),
                   (c1c / n1c).alias("freq"))
    return out if min_z is None else out.where(F.col("z") >= min_z)


def rounded(scored: DataFrame) -> DataFrame:
    """Log-odds rows as they leave a query: 6 decimals."""
    return scored.select(*[c for c in scored.columns if c not in ("z", "freq")],
                         F.round("z", 6).alias("odds"), F.round("freq", 6).alias("freq"))


def top_k_per_group(df: DataFrame, group: str, order: list, k: int,
                    tiebreak: str) -> DataFrame:
    """Top-k rows per group in two phases so no task sorts a whole group.

    Phase 1 keeps the top k inside (group, hash bucket of the tiebreak
    column), as many buckets as shuffle partitions; phase 2 ranks the
    <= k * buckets survivors per group."""
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    b = F.pmod(F.xxhash64(F.col(tiebreak)), F.lit(buckets))
    w1 = Window.partitionBy(group, "_bucket").orderBy(*order)
    stage1 = (df.withColumn("_bucket", b).withColumn("_r", F.row_number().over(w1))
              .where(F.col("_r") <= k).drop("_r", "_bucket"))
    w2 = Window.partitionBy(group).orderBy(*order)
    return stage1.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def top_words(ratings: DataFrame, examples: DataFrame, k: int = 10,
              match: str = "exact") -> DataFrame:
    """Top-k characteristic words per label by unrounded z."""
    scored = log_odds(ratings, examples, match=match)
    return rounded(top_k_per_group(scored, "emotion", [F.desc("z"), F.asc("word")], k, "word"))
