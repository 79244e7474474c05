"""Derived inputs over the driver's tables (see FIXTURES.md, part B).

Each function is a pure DataFrame expression over the given parquet tables,
so its size grows with theirs.  The annotation data is kept in normalised
form: ``ratings`` (one row per rater x example, no text) and ``examples``
(one row per example id with its text).  Operators that need text per
annotation row join the two only where needed, after pre-aggregating the
ratings per example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import EMOTIONS, MOOD_LABELS
from ..session import table, written

# FIXED VALUES: prefixes of the rule-text fixture, in order.
RULE_PREFIXES = [
    "plain note. ", "I am NOT so happy. ", "never feeling good ",
    "great day but I feel empty ", "waited an hour then cancelled ",
    "not happy, but crying ",
]


def _moods():
    return F.array(*[F.lit(m) for m in MOOD_LABELS])


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation rows (B1) without text.

    ``id`` is the example (document) an event rates; ``seq`` is the explicit
    input order; ``labels`` is a narrow array of label positions, off which
    one 0/1 column per emotion is read, and ``n_labels`` its size.  All of it is a projection of ``events``,
    so each query scans only the columns it needs and its filters reach the
    scan.
    """
    events = table(spark, sf_dir, "events")
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    k = F.get_json_object("props", "$.k").cast("int") % 28
    v = F.floor("value").cast("int") % 28
    unclear = F.col("event_type") == "error"
    # labels = [] if unclear; distinct [k, v] if value > 80; else [k]
    labels = (F.when(unclear, F.array().cast("array<int>"))
              .when(F.col("value") > 80, F.array_distinct(F.array(k, v))).otherwise(F.array(k)))
    # the same number as the array's size, without making the array
    n_labels = F.when(unclear, 0).when((F.col("value") > 80) & ~k.eqNullSafe(v), 2).otherwise(1)
    base = events.select(
        (F.col("event_id") % n_docs).alias("id"), F.col("user_id").alias("rater_id"), F.col("event_id").alias("seq"),
        unclear.alias("example_very_unclear"), labels.alias("labels"), n_labels.alias("n_labels"))
    return base.select("id", "rater_id", "seq", "example_very_unclear", "n_labels", "labels",
                       *[F.array_contains("labels", F.lit(i)).cast("int").alias(e) for i, e in enumerate(EMOTIONS)])


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per example: ``id``, ``text`` (B1 text side)."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def social_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with URL, mention and hashtag (B2), whole page html appended."""
    pages = table(spark, sf_dir, "pages")
    text = F.concat(
        F.lit("I'm at "), F.col("url"), F.lit(" @user"), F.col("page_id").cast("string"),
        F.lit(" #"), F.lower(F.substring(F.md5(F.col("url")), 1, 4)),
        F.lit(" awwwesome so happy today!! "), F.col("html"))
    return pages.select(F.col("page_id").alias("id"), text.alias("text"))


def single_label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y_true, y_pred) single-label evaluation rows."""
    events = table(spark, sf_dir, "events")
    y_true = F.get(_moods(), (F.col("user_id") % 3).cast("int"))
    y_pred = F.when(F.col("event_id") % 10 < 7, y_true).otherwise(
        F.get(_moods(), (F.col("event_id") % 4).cast("int")))
    return events.select(F.col("event_id").alias("id"), y_true.alias("y_true"),
                         y_pred.alias("y_pred"))


def folded(vector: Column, k: int) -> Column:
    """k sums over a whole vector: component i goes into sum i mod k.  Adds in
    double, from the first component to the last."""
    start = F.array_repeat(F.lit(0.0), k)
    indexed = F.transform(vector, lambda x, i: F.struct(x.cast("double").alias("x"), (i % k).alias("at")))
    return F.aggregate(indexed, start, lambda a, c: F.transform(
        a, lambda y, j: F.when(j == c["at"], y + c["x"]).otherwise(y)))


def multilabel_predictions(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """(id, s0 ... s9): a score per label, folded from the whole vector."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", folded(F.col("embedding"), k).alias("s"))
    return emb.select(F.col("vec_id").cast("string").alias("id"), *[F.get("s", F.lit(j)).alias(f"s{j}") for j in range(k)])


def multilabel_truth(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """(text, labels, id) rows with the true label ids as a comma list."""
    second = (F.col("label") + F.col("vec_id") % 3) % k
    ids = F.array_distinct(F.array(F.col("label").cast("int"), second.cast("int")))
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("text"),
        F.array_join(ids.cast("array<string>"), ",").alias("labels"), F.col("vec_id").cast("string").alias("id"))


def labelled_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, labels, id) rows with comma-separated label ids."""
    conv = table(spark, sf_dir, "conversations")
    labels = F.concat_ws(",", (F.col("conv_id") % 28).cast("string"),
                         ((F.col("conv_id") + F.col("turn") * 7) % 28).cast("string"))
    ident = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return conv.select("text", labels.alias("labels"), ident.alias("id"))


def rule_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, raw_mood, text) rows exercising the override rules.

    The whole document text follows the rule prefix."""
    docs = table(spark, sf_dir, "documents")
    prefixes = F.array(*[F.lit(p) for p in RULE_PREFIXES])
    text = F.concat(F.get(prefixes, (F.floor(F.col("doc_id") / 4) % 6).cast("int")), F.col("text"))
    return docs.select(F.col("doc_id").alias("id"),
                       F.get(_moods(), (F.col("doc_id") % 4).cast("int")).alias("raw_mood"),
                       text.alias("text"))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, logits array<double>[4]) model outputs folded from whole vectors."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), folded(F.col("embedding"), 4).alias("logits"))


def text_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, logits) for every document: text i has the outputs of vector
    i mod count(embeddings), the vectors being numbered from 0 in the order of
    their ids, dealt by range."""
    ranged = written(logits(spark, sf_dir).repartitionByRange("id").withColumn("part", F.spark_partition_id()), "logits")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("id", "logits")) - 1
    numbered = ranged.withColumn("inside", inside).join(before, "part").select(
        (F.col("inside") + F.col("before")).alias("id"), "logits")
    n = ranged.select(F.count(F.lit(1))).scalar()
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), F.pmod("doc_id", n).alias("id"))
    return texts.join(numbered, "id").select(F.col("text_id").alias("id"), "logits")
