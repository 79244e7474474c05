"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through ``sources.fixtures`` and runs
over whole tables and whole texts.  Column names equal the oracle SQL's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BASELINE_CONFIG, EKMAN_MAPPING, EMOTIONS, FINAL_CONFIG
from ..functions import text as T
from ..operators import agreement as AG
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import pipeline as P
from ..operators import scoring as SC
from ..operators import taxonomy as TX
from ..operators import split as SP
from ..operators import words as W
from ..session import partitions, shared_folder, table, written, written_by_key
from ..sources import fixtures as FX
from ..sources import io as IO
from ..sources import versions as V
from ..streaming import scoring as ST

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

PAGE_ID_OFFSET = 1_000_000_000


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# --- shared building blocks -------------------------------------------------

def processed(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    return P.processed_dataset(FX.ratings(spark, sf_dir), FX.examples(spark, sf_dir), stored=stored)


def _inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, t) for t in ("documents", "events")]


def stored_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table, built once for the state of the inputs and read
    from then on (S6)."""
    return V.load_or_build(spark, V.folder(spark, "processed", *_inputs(spark, sf_dir)), lambda: processed(spark, sf_dir, stored=True),
                           {"id", "text", "clean_text", "bert_text", "mood"})


def split_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed rows, without their raw texts, with their split, stored by
    split (S7): every query on features or models reads this table, and a
    filter on the split prunes it."""
    return V.load_or_build(spark, V.folder(spark, "split", *_inputs(spark, sf_dir)),
                           lambda: SP.stratified_split(stored_processed(spark, sf_dir).drop("text"), "mood", "clean_text"),
                           {"id", "clean_text", "bert_text", "mood", "split"}, partition_by="split")


def _all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = FX.examples(spark, sf_dir)
    social = FX.social_texts(spark, sf_dir).select(
        (F.col("id") + PAGE_ID_OFFSET).alias("id"), "text")
    # dealt over all tasks before they are cleaned, however few tasks the scans have
    return docs.unionByName(social).repartition(partitions(spark), "id", "text")


# --- text operators ---------------------------------------------------------

@query("clean_text")
def q_clean_text(spark, sf_dir):
    return _all_texts(spark, sf_dir).select("id", T.clean_text("text").alias("clean_text"))


@query("light_clean_text")
def q_light_clean_text(spark, sf_dir):
    return _all_texts(spark, sf_dir).select("id", T.light_clean_text("text").alias("bert_text"))


@query("analysis_tokens")
def q_analysis_tokens(spark, sf_dir):
    toks = _all_texts(spark, sf_dir).select("id", T.analysis_tokens("text").alias("t"))
    return toks.select("id", F.array_join("t", " ").alias("tokens"),
                       F.size("t").cast("long").alias("n_tokens"))


# --- mood pipeline ----------------------------------------------------------

@query("filter_unclear")
def q_filter_unclear(spark, sf_dir):
    r = FX.ratings(spark, sf_dir)
    return r.where(F.col("example_very_unclear") == F.lit(False)).select("id", "rater_id", "seq")


@query("map_single_class")
def q_map_single_class(spark, sf_dir):
    rows = P.mood_rows(FX.ratings(spark, sf_dir))
    has_text = FX.examples(spark, sf_dir).where(F.col("text").isNotNull()).select("id")
    return rows.join(has_text, "id", "left_semi")


@query("processed_dataset")
def q_processed_dataset(spark, sf_dir):
    return processed(spark, sf_dir)


@query("dedup_majority")
def q_dedup_majority(spark, sf_dir):
    return processed(spark, sf_dir)


@query("class_counts")
def q_class_counts(spark, sf_dir):
    return P.class_counts(processed(spark, sf_dir))


@query("label_index")
def q_label_index(spark, sf_dir):
    return P.label_ids(processed(spark, sf_dir))


@query("pipeline_stats")
def q_pipeline_stats(spark, sf_dir):
    return P.pipeline_stats(FX.ratings(spark, sf_dir), FX.examples(spark, sf_dir))


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    return split_table(spark, sf_dir).select("id", "mood", "split")


@query("train_val_test_split")
def q_train_val_test_split(spark, sf_dir):
    rows = stored_processed(spark, sf_dir).select("id", "mood", "clean_text")
    return SP.train_val_test_split(rows, "mood", "clean_text").select("id", "mood", "split")


@query("persisted_split")
def q_persisted_split(spark, sf_dir):
    """The stored split's test part, of which only its own folder is read."""
    return split_table(spark, sf_dir).where(F.col("split") == "test").select("id", "mood", "split")


@query("fixed_sample")
def q_fixed_sample(spark, sf_dir):
    """A quarter as many documents as there are pages (O3)."""
    n = max(1, table(spark, sf_dir, "pages").count() // 4)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("key"), "lang")
    return SP.fixed_sample(docs, "key", n).select("id", "lang")


@query("split_overlap")
def q_split_overlap(spark, sf_dir):
    return SP.split_overlap(split_table(spark, sf_dir))


# --- agreement and corpus statistics -------------------------------------------

def _ratings_query(fn):
    return lambda spark, sf_dir: fn(FX.ratings(spark, sf_dir))


for _name, _fn in {
    "corpus_stats": AG.corpus_stats,
    "label_cardinality": AG.label_cardinality,
    "label_prevalence": AG.label_prevalence,
    "label_correlation": AG.label_correlation,
    "label_distance": AG.label_distance,
    "agreement_labels": AG.agreement_per_row,
    "agreement_coverage": AG.agreement_coverage,
    "label_count_histogram": AG.label_count_histogram,
    "label_agreed_share": AG.label_agreed_share,
    "first_per_key": AG.first_per_key,
    "sentiment_bucket": AG.sentiment_buckets,
}.items():
    QUERIES[_name] = _ratings_query(_fn)


@query("approx_distinct")
def q_approx_distinct(spark, sf_dir):
    """Exact counts beside what merged sketches say of them (A4)."""
    return AG.approximate_distinct(FX.ratings(spark, sf_dir)).drop("n_estimate")


@query("distinct_estimates")
def q_distinct_estimates(spark, sf_dir):
    return AG.approximate_distinct(FX.ratings(spark, sf_dir))


@query("mean_ratings")
def q_mean_ratings(spark, sf_dir):
    means = AG.mean_ratings(FX.ratings(spark, sf_dir))
    return means.select("id", *[F.round(F.col(c), 6).alias(c) for c in means.columns if c != "id"])


# --- word statistics -----------------------------------------------------------

@query("word_counts")
def q_word_counts(spark, sf_dir):
    return W.word_counts(FX.ratings(spark, sf_dir), FX.examples(spark, sf_dir))


@query("log_odds_words")
def q_log_odds_words(spark, sf_dir):
    return W.rounded(W.log_odds(FX.ratings(spark, sf_dir), FX.examples(spark, sf_dir), match="exact"))


@query("log_odds_words_contains")
def q_log_odds_words_contains(spark, sf_dir):
    return W.rounded(W.log_odds(FX.ratings(spark, sf_dir), FX.examples(spark, sf_dir), match="contains"))


@query("top_words")
def q_top_words(spark, sf_dir):
    return W.top_words(FX.ratings(spark, sf_dir), FX.examples(spark, sf_dir), k=10)


# --- evaluation ------------------------------------------------------------------

def _preds(spark, sf_dir):
    return FX.single_label_predictions(spark, sf_dir)


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(_preds(spark, sf_dir))


@query("per_class_metrics")
def q_per_class_metrics(spark, sf_dir):
    return M.per_class_metrics(_preds(spark, sf_dir)).select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("overall_metrics")
def q_overall_metrics(spark, sf_dir):
    return M.overall_metrics(_preds(spark, sf_dir))


@query("classification_report")
def q_classification_report(spark, sf_dir):
    return M.classification_report(_preds(spark, sf_dir))


def _benchmark(spark, sf_dir):
    sp = split_table(spark, sf_dir)
    train, test = sp.where(F.col("split") == "train"), sp.where(F.col("split") == "test")
    return M.experiment_row("Majority_Class_Benchmark", M.majority_predictions(train, test))


@query("majority_benchmark")
def q_majority_benchmark(spark, sf_dir):
    return _benchmark(spark, sf_dir)


@query("experiment_comparison")
def q_experiment_comparison(spark, sf_dir):
    return M.experiment_table(_benchmark(spark, sf_dir),
                              M.experiment_row("Fixture_Predictions", _preds(spark, sf_dir)))


def _tsv(spark, rows, schema, header, multi_line):
    """Rows through a TSV table in the shared folder, as the text formats have it."""
    path = shared_folder(spark, "tsv")
    IO.write_csv(rows, path, sep="\t", header=header)
    return IO.scan_parts(spark, path, schema, sep="\t", header=header, multi_line=multi_line)


def _multilabel(spark, sf_dir):
    """Predictions (headered TSV) paired by id with truth (headerless TSV)."""
    preds = FX.multilabel_predictions(spark, sf_dir)
    preds = _tsv(spark, preds, preds.schema, True, False)
    truth = _tsv(spark, FX.multilabel_truth(spark, sf_dir), IO.LABELLED_TSV_SCHEMA, False, False)
    return M.pair_with_truth(preds, truth, 10)


@query("multilabel_metrics")
def q_multilabel_metrics(spark, sf_dir):
    return M.multilabel_metrics(_multilabel(spark, sf_dir))


@query("multilabel_per_label")
def q_multilabel_per_label(spark, sf_dir):
    return M.multilabel_per_label(_multilabel(spark, sf_dir))


def _labelled(spark, sf_dir):
    """Labelled texts (headerless TSV; texts may hold line breaks)."""
    return _tsv(spark, FX.labelled_tsv(spark, sf_dir), IO.LABELLED_TSV_SCHEMA, False, True)


@query("multi_hot")
def q_multi_hot(spark, sf_dir):
    return M.multi_hot_rows(_labelled(spark, sf_dir), 28)


# --- taxonomy ----------------------------------------------------------------------

def _taxonomy(spark):
    """(old labels, mapping) read from a label list file and a JSON mapping."""
    path = shared_folder(spark, "taxonomy")
    lines = spark.range(1).select(F.lit("\n".join(EMOTIONS)).alias("value"))
    lines.write.text(f"{path}/labels")
    spark.range(1).select(F.to_json(F.create_map(*[x for g, ms in EKMAN_MAPPING.items() for x in (
        F.lit(g), F.array(*[F.lit(m) for m in ms]))])).alias("value")).write.text(f"{path}/mapping")
    labels = [r["label"] for r in IO.read_label_list(spark, f"{path}/labels").orderBy("idx").collect()]
    mapping: dict[str, list[str]] = {}
    for r in IO.read_mapping(spark, f"{path}/mapping").collect():
        mapping.setdefault(r["group"], []).append(r["member"])
    return labels, mapping


@query("taxonomy_replace")
def q_taxonomy_replace(spark, sf_dir):
    return TX.replace_labels(_labelled(spark, sf_dir), *_taxonomy(spark))


@query("taxonomy_labels")
def q_taxonomy_labels(spark, sf_dir):
    return TX.label_usage(_labelled(spark, sf_dir), spark, *_taxonomy(spark))


# --- scoring -----------------------------------------------------------------------

@query("rule_override")
def q_rule_override(spark, sf_dir):
    return SC.rule_overrides(FX.rule_texts(spark, sf_dir))


@query("softmax_scores")
def q_softmax_scores(spark, sf_dir):
    return SC.softmax_scores(FX.logits(spark, sf_dir))


@query("score_texts")
def q_score_texts(spark, sf_dir):
    return SC.score_texts(FX.rule_texts(spark, sf_dir).select("id", "text"), FX.text_logits(spark, sf_dir))


@query("score_stream")
def q_score_stream(spark, sf_dir):
    """``score_texts`` as a stream: files of texts arrive in a folder and are
    scored a few at a time into a table, each exactly once."""
    path = shared_folder(spark, "stream")
    texts = FX.rule_texts(spark, sf_dir).select("id", "text")
    texts.repartition(8).write.parquet(f"{path}/in")
    arriving = ST.read_text_stream(spark, f"{path}/in", texts.schema, max_files_per_trigger=3)
    scored = ST.score_stream(arriving, written(FX.text_logits(spark, sf_dir), "text-logits"))
    ST.write_stream(scored, f"{path}/out", f"{path}/checkpoint")
    return spark.read.schema(scored.schema).parquet(f"{path}/out")


# --- features ----------------------------------------------------------------------


def _block(docs, cfg, terms):
    return FE.tfidf_block(docs.select("id", "split", "clean_text"), terms, cfg["min_df"], cfg["max_df"], cfg["max_features"], cfg["sublinear"])


def _word_block(docs, cfg):
    return _block(docs, cfg, FE.word_terms("clean_text", cfg["ngram"]))


def _word_vocabulary(docs, cfg):
    return FE.vocabulary(docs.select("id", "split", "clean_text"), FE.word_terms("clean_text", cfg["ngram"]),
                         cfg["min_df"], cfg["max_df"], cfg["max_features"])


def _char_block(docs, cfg):
    return _block(docs, cfg, FE.char_terms("clean_text", cfg["ngram"]))


@query("word_ngrams")
def q_word_ngrams(spark, sf_dir):
    c = FE.term_counts(stored_processed(spark, sf_dir).select("id", "clean_text"), FE.word_terms("clean_text", (1, 2)))
    return c.select(F.col("doc").alias("id"), "term", "tf")


@query("char_ngrams")
def q_char_ngrams(spark, sf_dir):
    c = FE.term_counts(stored_processed(spark, sf_dir).select("id", "clean_text"), FE.char_terms("clean_text", (3, 5)))
    return c.select(F.col("doc").alias("id"), "term", "tf")


@query("vocabulary")
def q_vocabulary(spark, sf_dir):
    return _word_vocabulary(split_table(spark, sf_dir), FINAL_CONFIG["word"])


@query("tfidf_word")
def q_tfidf_word(spark, sf_dir):
    _, w = _word_block(split_table(spark, sf_dir), BASELINE_CONFIG["word"])
    return w.select(F.col("doc").alias("id"), "term", F.round("weight", 6).alias("weight"))


@query("tfidf_sublinear")
def q_tfidf_sublinear(spark, sf_dir):
    _, w = _word_block(split_table(spark, sf_dir), FINAL_CONFIG["word"])
    return w.select(F.col("doc").alias("id"), "term", F.round("weight", 6).alias("weight"))


@query("feature_union")
def q_feature_union(spark, sf_dir):
    docs = split_table(spark, sf_dir)
    blocks = [_word_block(docs, FINAL_CONFIG["word"]), _char_block(docs, FINAL_CONFIG["char"])]
    u = FE.feature_union(blocks)
    return u.select(F.col("doc").alias("id"), "feature", F.round("weight", 6).alias("weight"))


@query("encode_sequences")
def q_encode_sequences(spark, sf_dir):
    docs = split_table(spark, sf_dir)
    vocab = _word_vocabulary(docs, BASELINE_CONFIG["word"])
    return FE.encode_sequences(docs, vocab, max_features=BASELINE_CONFIG["word"]["max_features"])


# --- sources -------------------------------------------------------------------------


@query("scan_union")
def q_scan_union(spark, sf_dir):
    """Documents as CSV parts of three layouts - in order, columns shuffled,
    a column missing - scanned and united by name (S1, S8, U1)."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")
    path = shared_folder(spark, "csv-parts")
    layouts = [["id", "text", "lang", "source"], ["source", "text", "id", "lang"], ["text", "id", "lang"]]
    for i, columns in enumerate(layouts):
        IO.write_csv(docs.where(F.pmod(F.coalesce("id", F.lit(0)), F.lit(3)) == i).select(*columns), f"{path}/part{i}")
    return IO.scan_by_name(spark, [f"{path}/part{i}" for i in range(3)], docs.schema)


# --- models --------------------------------------------------------------------------
# metrics and predictions are rows-only: no SQL oracle for an iterative optimiser


def _features(spark, sf_dir, blocks_of, keep_weights=False):
    """(split rows, blocks, weights of each block, assembled features, parts by
    document).  ``keep_weights``: written once, for more readers than the vectors."""
    docs = split_table(spark, sf_dir)
    blocks = blocks_of(docs)
    size = sum(v.select(F.count(F.lit(1))).scalar() for v, _ in blocks)
    parts = FE.parts_by_text(docs.select("id", "split", "clean_text"))
    weights = FE.shifted(blocks)
    if keep_weights:
        weights = [written_by_key(w, "weights", "doc", parts) for w in weights]
    return docs, blocks, weights, MD.assemble(docs, weights, size, parts=parts), parts


def _baseline_blocks(docs):
    return [_word_block(docs, BASELINE_CONFIG["word"])]


def _final_blocks(docs):
    return [_word_block(docs, FINAL_CONFIG["word"]), _char_block(docs, FINAL_CONFIG["char"])]


def _run(spark, sf_dir, cfg, blocks_of):
    feats = _features(spark, sf_dir, blocks_of)[3]
    return M.experiment_row(cfg["experiment"], MD.train_and_predict(feats, cfg["C"], cfg["max_iter"]))


@query("train_baseline")
def q_train_baseline(spark, sf_dir):
    """Unigram TF-IDF (10k) + logistic regression, C = 1: test-set metrics (M1, M3)."""
    return _run(spark, sf_dir, BASELINE_CONFIG, _baseline_blocks)


@query("train_final")
def q_train_final(spark, sf_dir):
    """Word (1,2) + char_wb (3,5) sublinear TF-IDF + logistic regression, C = 1.5 (M2, M3)."""
    return _run(spark, sf_dir, FINAL_CONFIG, _final_blocks)


@query("experiment_comparison_models")
def q_experiment_comparison_models(spark, sf_dir):
    """Benchmark, baseline and final run side by side (M5), all on the stored
    split."""
    return M.experiment_table(_benchmark(spark, sf_dir), q_train_baseline(spark, sf_dir), q_train_final(spark, sf_dir))


@query("model_certificate")
def q_model_certificate(spark, sf_dir):
    """Whether baseline and final fit are at the optimum of their objective,
    by the gradient at the fitted weights (M1, M2)."""
    rows = []
    for cfg, blocks_of in ((BASELINE_CONFIG, _baseline_blocks), (FINAL_CONFIG, _final_blocks)):
        docs, _, weights, feats, parts = _features(spark, sf_dir, blocks_of, keep_weights=True)
        model = MD.fit(feats, cfg["C"], cfg["max_iter"])
        proof = MD.certificate(model, docs.select("id", "mood", "split"), weights, cfg["C"], parts=parts)
        rows.append(proof.select(F.lit(cfg["experiment"]).alias("experiment"), "converged", "n_train", "n_features"))
    return rows[0].unionByName(rows[1])


def _saved_baseline(spark, sf_dir) -> str:
    """Folder of the baseline's model and vocabulary, fitted and stored once
    for the state of the inputs (S12)."""
    def write(path):
        docs, blocks, _, feats, _ = _features(spark, sf_dir, _baseline_blocks)
        n_train = docs.where(F.col("split") == "train").select(F.count(F.lit(1))).scalar()
        MD.save(MD.fit(feats, BASELINE_CONFIG["C"], BASELINE_CONFIG["max_iter"]), blocks[0][0], n_train, path)

    return V.reuse_or_write(spark, V.folder(spark, "baseline", *_inputs(spark, sf_dir)), write)


def classify_saved(spark: SparkSession, path: str, texts: DataFrame) -> DataFrame:
    """(doc, y_pred, logits) of (id, text) rows by the stored baseline (M3)."""
    cfg = BASELINE_CONFIG["word"]
    model, vocabulary, n_docs = MD.load(spark, path)
    cleaned = texts.select("id", T.clean_text("text").alias("clean_text"))
    feats = MD.outside_features(cleaned, vocabulary, n_docs, FE.word_terms("clean_text", cfg["ngram"]), cfg["sublinear"], cfg["max_features"],
                                parts=FE.parts_by_text(texts))  # raw texts are larger than cleaned ones, and need no cleaning
    return MD.classify(model, feats)


@query("predict_saved")
def q_predict_saved(spark, sf_dir):
    """Moods of texts outside the corpus - pages and conversation turns - by
    the stored model."""
    pages = FX.social_texts(spark, sf_dir).select(F.concat(F.lit("page-"), F.col("id").cast("string")).alias("id"), "text")
    turns = FX.labelled_tsv(spark, sf_dir).select(F.concat(F.lit("turn-"), "id").alias("id"), "text")
    rows = classify_saved(spark, _saved_baseline(spark, sf_dir), pages.unionByName(turns))
    return rows.select(F.col("doc").alias("id"), "y_pred")


@query("score_texts_model")
def q_score_texts_model(spark, sf_dir):
    """End-to-end scoring (M4) on the stored model's own margins: TF-IDF,
    model, softmax, override, repair and ranking of every document."""
    texts = FX.rule_texts(spark, sf_dir).select("id", "text")
    logits = classify_saved(spark, _saved_baseline(spark, sf_dir), texts).select(F.col("doc").alias("id"), "logits")
    return SC.score_texts(texts, logits)
