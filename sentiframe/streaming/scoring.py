"""The stateless text operators on a stream.

The reference has no streaming operator; its live path scores one text per
request.  Every text / label / scoring function in this library is a Column
expression without actions, so the same chain runs unchanged on a streaming
DataFrame: a stream of texts is cleaned and joined to a static table of model
outputs (stream-static join) and scored.  No state is kept but the checkpoint
of what was read and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.text import clean_text, light_clean_text
from ..operators.scoring import score_texts

TEXT_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])


def read_text_stream(spark: SparkSession, path: str, schema: T.StructType = TEXT_SCHEMA,
                     max_files_per_trigger: int = 64) -> DataFrame:
    """Parquet files arriving in ``path`` as a stream of (id, text)."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def clean_stream(texts: DataFrame) -> DataFrame:
    """(id, clean_text, bert_text) for each arriving text."""
    return texts.select("id", clean_text("text").alias("clean_text"),
                        light_clean_text("text").alias("bert_text"))


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that a stream has at present to the Parquet table ``path``
    and return.  The checkpoint holds which files were taken in and the sink
    which batches were written, so a run that follows a broken or finished one
    goes on after it and no row is written twice."""
    query = (rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def score_stream(texts: DataFrame, logits: DataFrame) -> DataFrame:
    """Score arriving texts against a static (id, logits) table."""
    return score_texts(texts, logits)
