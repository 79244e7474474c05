"""Corpus pipeline: documents to token ids in five stages.

Each stage works on all that the one before kept; its result is written to the
shared folder as Parquet and read again, so a lost executor costs no more than
the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiframe.llm import bpe, gam, line_runs, mixing, simhash_trie
from sentiframe.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the additive model rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = gam.train(docs, labels, gam.fold("doc_id", 5) != 0)
    return gam.score(docs, model, COLUMNS).where(F.col("_score") >= gam.THRESHOLD).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds; documents stay, if empty."""
    out = line_runs.line_dedup(docs, keep=("lang", "source"))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash_trie.keep_one(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents, up to three times each, to the sources' target weights."""
    return mixing.mix(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of them and of the text that
    they decode to."""
    both = bpe.round_trip(docs, *bpe.public_vocabulary(), keep=("source",))
    return both.select("doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: The first stage's boosted tables are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return docs
