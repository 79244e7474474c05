"""Oracle SQL for every SQL-expressible query key (DuckDB dialect).

Each statement reads the driver's pre-registered views (documents, events,
embeddings, conversations, pages) and recomputes the derived fixtures and
the operator directly, in the simplest row-by-row form.
"""

from __future__ import annotations

from ..constants import EMOTIONS, MOOD_LABELS
from . import sqltext as S

# name -> (dependencies, body)
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(names: list[str], main: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return main
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{main}"


# --- fixtures ---------------------------------------------------------------
cte("ratings_raw", [], f"""
SELECT event_id % (SELECT count(*) FROM documents) AS id, user_id AS rater_id, event_id AS seq,
       event_type = 'error' AS example_very_unclear,
       CASE WHEN event_type = 'error' THEN CAST([] AS INTEGER[])
            WHEN value > 80 THEN list_distinct([CAST(json_extract_string(props, '$.k') AS INTEGER) % 28,
                                               CAST(floor(value) AS INTEGER) % 28])
            ELSE [CAST(json_extract_string(props, '$.k') AS INTEGER) % 28] END AS labels
FROM events""")
cte("ratings", ["ratings_raw"], f"""
SELECT id, rater_id, seq, example_very_unclear, len(labels) AS n_labels, {S.emotion_columns('labels')}
FROM ratings_raw""")
cte("annot", ["ratings"], """
SELECT r.*, d.text FROM ratings r JOIN documents d ON r.id = d.doc_id""")
cte("mood_rows", ["annot"], f"""
SELECT id, seq, text, {S.single_class()} AS mood FROM annot WHERE example_very_unclear = false""")
cte("mapped", ["mood_rows"], "SELECT * FROM mood_rows WHERE mood IS NOT NULL AND text IS NOT NULL")
cte("cleaned_rows", ["mapped"], f"""
SELECT *, {S.clean_text('text')} AS clean_text, {S.light_clean_text('text')} AS bert_text FROM mapped""")
cte("kept", ["cleaned_rows"], "SELECT * FROM cleaned_rows WHERE clean_text <> '' AND bert_text <> ''")
cte("grp_counts", ["kept"], "SELECT clean_text, mood, count(*) AS n FROM kept GROUP BY 1, 2")
cte("grp", ["grp_counts"], "SELECT clean_text, max(n) AS top, sum(n) AS total FROM grp_counts GROUP BY 1")
cte("winners", ["grp", "grp_counts"], """
SELECT g.clean_text, min(c.mood) AS mood, count(*) AS n_top, any_value(g.total) AS total
FROM grp g JOIN grp_counts c ON c.clean_text = g.clean_text AND c.n = g.top GROUP BY 1""")
cte("firsts", ["kept"], """
SELECT clean_text, arg_min(id, seq) AS id, min(seq) AS seq, arg_min(text, seq) AS text,
       arg_min(bert_text, seq) AS bert_text
FROM kept GROUP BY 1""")
cte("processed", ["firsts", "winners"], """
SELECT f.id, f.seq, f.text, f.clean_text, f.bert_text, w.mood
FROM firsts f JOIN winners w USING (clean_text) WHERE w.n_top = 1""")

# stratified split
def _split_ctes(name: str, source: str, share: float, seed: str, first: str, second: str) -> None:
    """``name``: rows of ``source`` with a split column, exact quotas by class."""
    cte(f"{name}_cls", [source], f"SELECT mood, CAST(count(*) AS BIGINT) AS nc FROM {source} GROUP BY 1")
    cte(f"{name}_tot", [f"{name}_cls"], f"""
SELECT CAST(sum(nc) AS BIGINT) AS ntot,
       CAST(sum(nc) - ceil(CAST({share} AS DOUBLE) * sum(nc)) AS BIGINT) AS ntrain FROM {name}_cls""")
    cte(f"{name}_base", [f"{name}_cls", f"{name}_tot"], f"""
SELECT c.mood, c.nc, t.ntrain, (c.nc * t.ntrain) // t.ntot AS base, (c.nc * t.ntrain) % t.ntot AS rem
FROM {name}_cls c CROSS JOIN {name}_tot t""")
    cte(f"{name}_quota", [f"{name}_base"], f"""
SELECT mood, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, mood)
                             <= ntrain - sum(base) OVER () THEN 1 ELSE 0 END AS quota
FROM {name}_base""")
    cte(name, [source, f"{name}_quota"], f"""
SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY p.mood ORDER BY md5('{seed}|' || p.clean_text), p.clean_text)
                      <= q.quota THEN '{first}' ELSE '{second}' END AS split
FROM {source} p JOIN {name}_quota q USING (mood)""")


_split_ctes("split", "processed", 0.2, "42", "train", "test")
cte("train_part", ["split"], "SELECT * EXCLUDE (split) FROM split WHERE split = 'train'")
_split_ctes("val_split", "train_part", 0.1, "42|val", "train", "validation")


def _r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


ORACLE: dict[str, str] = {}

ORACLE["clean_text"] = with_ctes([], f"""
SELECT doc_id AS id, {S.clean_text('text')} AS clean_text FROM documents
UNION ALL
SELECT 1000000000 + page_id AS id,
       {S.clean_text("concat('I''m at ', url, ' @user', page_id, ' #', lower(substr(md5(url), 1, 4)), ' awwwesome so happy today!! ', html)")}
FROM pages""")

ORACLE["light_clean_text"] = with_ctes([], f"""
SELECT doc_id AS id, {S.light_clean_text('text')} AS bert_text FROM documents
UNION ALL
SELECT 1000000000 + page_id AS id,
       {S.light_clean_text("concat('I''m at ', url, ' @user', page_id, ' #', lower(substr(md5(url), 1, 4)), ' awwwesome so happy today!! ', html)")}
FROM pages""")

ORACLE["analysis_tokens"] = with_ctes([], f"""
SELECT id, array_to_string(t, ' ') AS tokens, CAST(len(t) AS BIGINT) AS n_tokens FROM (
  SELECT doc_id AS id, {S.analysis_tokens('text')} AS t FROM documents
  UNION ALL
  SELECT 1000000000 + page_id AS id,
         {S.analysis_tokens("concat('I''m at ', url, ' @user', page_id, ' #', lower(substr(md5(url), 1, 4)), ' awwwesome so happy today!! ', html)")}
  FROM pages)""")

ORACLE["filter_unclear"] = with_ctes(["ratings"], """
SELECT id, rater_id, seq FROM ratings WHERE example_very_unclear = false""")

ORACLE["map_single_class"] = with_ctes(["mapped"], "SELECT id, seq, mood FROM mapped")

ORACLE["processed_dataset"] = with_ctes(["processed"], "SELECT * FROM processed")

ORACLE["dedup_majority"] = ORACLE["processed_dataset"]

ORACLE["class_counts"] = with_ctes(["processed"], """
SELECT mood, count(*) AS n FROM processed GROUP BY 1""")

ORACLE["label_index"] = with_ctes(["processed"], f"""
SELECT id, mood, CAST(list_position({S.str_list(MOOD_LABELS)}, mood) - 1 AS INTEGER) AS label
FROM processed""")

ORACLE["pipeline_stats"] = with_ctes(["ratings", "mapped", "kept", "winners"], """
SELECT (SELECT count(*) FROM ratings) AS raw_rows,
       (SELECT count(*) FROM mapped) AS mapped_rows,
       (SELECT count(*) FROM kept) AS rows_before_dedup,
       (SELECT count(*) FROM winners WHERE n_top = 1) AS rows_after_dedup,
       (SELECT CAST(coalesce(sum(total), 0) AS BIGINT) FROM winners WHERE n_top > 1) AS dropped_tie_rows""")

ORACLE["stratified_split"] = with_ctes(["split"], "SELECT id, mood, split FROM split")

ORACLE["train_val_test_split"] = with_ctes(["split", "val_split"], """
SELECT id, mood, split FROM val_split UNION ALL SELECT id, mood, split FROM split WHERE split = 'test'""")

ORACLE["persisted_split"] = with_ctes(["split"], "SELECT id, mood, split FROM split WHERE split = 'test'")

ORACLE["fixed_sample"] = """
SELECT id, lang FROM (
  SELECT doc_id AS id, lang, row_number() OVER (ORDER BY md5('42|' || doc_id), CAST(doc_id AS VARCHAR)) AS r FROM documents)
WHERE r <= greatest(1, (SELECT count(*) FROM pages) // 4)"""

ORACLE["split_overlap"] = with_ctes(["split"], """
SELECT count(*) AS overlap FROM (
  SELECT DISTINCT clean_text FROM split WHERE split = 'train'
  INTERSECT SELECT clean_text FROM split WHERE split = 'test')""")


# --- agreement and corpus statistics -----------------------------------------
_NL = " + ".join(f'"{e}"' for e in EMOTIONS)
cte("labelled", ["ratings"], f"SELECT * FROM ratings WHERE ({_NL}) <> 0")
cte("ex_sums", ["labelled"], "SELECT id, count(*) AS n_rows, " +
    ", ".join(f'sum("{e}") AS "{e}"' for e in EMOTIONS) + " FROM labelled GROUP BY id")


def _agree_sql(test: str) -> str:
    """Names of the labels whose rater sum passes, e.g. '>= 2'."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN \"{e}\" {test} THEN '{e}' END" for e in EMOTIONS) + ")"


def _n_agree_sql(test: str) -> str:
    return "(" + " + ".join(f'CAST("{e}" {test} AS INTEGER)' for e in EMOTIONS) + ")"


cte("agree_sets", ["ex_sums"], f"""
SELECT id, n_rows, {_agree_sql(">= 1")} AS unique_labels, {_agree_sql(">= 2")} AS agree_2,
       {_agree_sql(">= 3")} AS agree_3, {_agree_sql("= 1")} AS no_agree,
       {_n_agree_sql(">= 1")} AS n_pre, {_n_agree_sql(">= 2")} AS n_post, {_n_agree_sql(">= 3")} AS n_3
FROM ex_sums""")

ORACLE["corpus_stats"] = with_ctes(["ratings"], f"""
SELECT count(DISTINCT id) AS n_examples, count(*) AS n_annotations, count(DISTINCT rater_id) AS n_raters,
       {_r6("count(*) FILTER (WHERE example_very_unclear) / count(*)")} AS unclear_share,
       count(*) FILTER (WHERE ({_NL}) <> 0) AS n_labelled,
       {_r6(f"count(*) FILTER (WHERE ({_NL}) > 3) / count(*) FILTER (WHERE ({_NL}) <> 0)")} AS share_gt3
FROM ratings""")

ORACLE["approx_distinct"] = with_ctes(["ratings"], """
SELECT 'n_examples' AS measure, count(DISTINCT id) AS n_exact, true AS merged_equals_pass, true AS within_error FROM ratings
UNION ALL SELECT 'n_raters', count(DISTINCT rater_id), true, true FROM ratings""")

ORACLE["label_cardinality"] = with_ctes(["labelled"], f"""
SELECT ({_NL}) AS n_labels, count(*) AS n_rows,
       {_r6("count(*) / (SELECT count(*) FROM labelled)")} AS share
FROM labelled GROUP BY 1""")

def _ranked(rows: str, value: str) -> str:
    return f"SELECT *, CAST(row_number() OVER (ORDER BY {value} DESC, label) AS INTEGER) AS rank FROM ({rows})"


ORACLE["label_prevalence"] = with_ctes(["labelled"], _ranked(" UNION ALL ".join(
    f"""SELECT '{e}' AS label, CAST(sum("{e}") AS BIGINT) AS n_positive,
        {_r6(f'sum("{e}") / count(*)')} AS share FROM labelled""" for e in EMOTIONS), "n_positive"))

ORACLE["mean_ratings"] = with_ctes(["labelled"], "SELECT id, " + ", ".join(
    f'{_r6(f"avg(\"{e}\")")} AS "{e}"' for e in EMOTIONS) + " FROM labelled GROUP BY id")

cte("ex_means", ["labelled"], "SELECT id, " + ", ".join(
    f'avg("{e}") AS "{e}"' for e in EMOTIONS) + " FROM labelled GROUP BY id")

_PAIRS = [(EMOTIONS[i], EMOTIONS[j]) for i in range(len(EMOTIONS)) for j in range(i)]
ORACLE["label_correlation"] = with_ctes(["ex_means"], " UNION ALL ".join(
    f"""SELECT '{a}' AS label_a, '{b}' AS label_b, {_r6(f'corr("{a}", "{b}")')} AS corr FROM ex_means"""
    for a, b in _PAIRS))

ORACLE["label_distance"] = with_ctes(["ex_means"], " UNION ALL ".join(
    f"""SELECT '{b}' AS label_a, '{a}' AS label_b, {_r6(f'1 - corr("{a}", "{b}")')} AS distance FROM ex_means"""
    for a, b in _PAIRS))

ORACLE["agreement_labels"] = with_ctes(["labelled", "agree_sets"], """
SELECT l.seq, l.id, a.unique_labels, a.agree_2, a.agree_3, a.no_agree
FROM labelled l LEFT JOIN agree_sets a USING (id)""")

ORACLE["agreement_coverage"] = with_ctes(["agree_sets"], " UNION ALL ".join(f"""
SELECT {t} AS min_agreement, count(*) FILTER (WHERE n_{'post' if t == 2 else t} > 0) AS n_examples,
       CAST(coalesce(sum(n_rows) FILTER (WHERE n_{'post' if t == 2 else t} > 0), 0) AS BIGINT) AS n_rows,
       {_r6(f"coalesce(sum(n_rows) FILTER (WHERE n_{'post' if t == 2 else t} > 0), 0) / sum(n_rows)")} AS row_share
FROM agree_sets""" for t in (2, 3)))

ORACLE["label_count_histogram"] = with_ctes(["agree_sets"], """
SELECT type, n_labels, count(*) AS n_examples FROM (
  SELECT 'pre-filter' AS type, n_pre AS n_labels FROM agree_sets
  UNION ALL SELECT 'post-filter', n_post FROM agree_sets) GROUP BY 1, 2""")

ORACLE["label_agreed_share"] = with_ctes(["ex_sums", "agree_sets"], _ranked(" UNION ALL ".join(f"""
SELECT '{e}' AS label, CAST(coalesce(sum(s."{e}") FILTER (WHERE a.n_post > 0), 0) AS BIGINT) AS n_agreed,
       {_r6(f'coalesce(sum(s."{e}") FILTER (WHERE a.n_post > 0), 0) / sum(s.n_rows)')} AS share
FROM ex_sums s JOIN agree_sets a USING (id)""" for e in EMOTIONS), "n_agreed"))

ORACLE["first_per_key"] = with_ctes(["ratings"], """
SELECT id, min(seq) AS seq, arg_min(rater_id, seq) AS rater_id FROM ratings GROUP BY id""")


def _bucket(e: str) -> str:
    from ..constants import SENTIMENT_MAPPING as M
    return "positive" if e in M["positive"] else "negative" if e in M["negative"] else "ambiguous"


ORACLE["sentiment_bucket"] = with_ctes(["ratings"], " UNION ALL ".join(
    f"""SELECT '{e}' AS label, '{_bucket(e)}' AS bucket, CAST(coalesce(sum("{e}"), 0) AS BIGINT) AS n_positive FROM ratings"""
    for e in EMOTIONS))


# --- word statistics (log-odds) -------------------------------------------------
cte("row_tokens", ["annot"], f"""
SELECT a.seq, a.id, unnest({S.analysis_tokens('a.text')}) AS word FROM annot a""")
cte("row_wc", ["row_tokens"], "SELECT id, word, count(*) AS n FROM row_tokens GROUP BY 1, 2")
cte("all_sums", ["ratings"], "SELECT id, " + ", ".join(
    f'sum("{e}") AS "{e}"' for e in EMOTIONS) + " FROM ratings GROUP BY id")
cte("ex_agree2", ["all_sums"], f"SELECT id, {_agree_sql(">= 2")} AS agreement FROM all_sums")
cte("label_list", [], "SELECT unnest(" + S.str_list(EMOTIONS) + ") AS label")
cte("members_exact", ["ex_agree2", "label_list"], """
SELECT a.id, l.label FROM ex_agree2 a JOIN label_list l ON list_contains(string_split(a.agreement, ','), l.label)""")
cte("members_contains", ["ex_agree2", "label_list"], """
SELECT a.id, l.label FROM ex_agree2 a JOIN label_list l ON contains(a.agreement, l.label)""")
cte("word_totals", ["row_wc"], "SELECT word, sum(n) AS t FROM row_wc GROUP BY 1")


def _log_odds_sql(members: str, main: str) -> str:
    """Counts of each word inside and outside each label's examples, both
    taken from the rows themselves; the prior is all rows together."""
    return with_ctes([members, "row_wc", "word_totals", "label_list"], f"""
, inside AS (SELECT m.label, w.word, sum(w.n) AS c FROM {members} m JOIN row_wc w USING (id) GROUP BY 1, 2)
, outside AS (
  SELECT l.label, w.word, sum(w.n) AS c FROM label_list l CROSS JOIN row_wc w
  WHERE NOT EXISTS (SELECT 1 FROM {members} m WHERE m.label = l.label AND m.id = w.id) GROUP BY 1, 2)
, n_inside AS (SELECT label, sum(c) AS n FROM inside GROUP BY 1)
, n_outside AS (SELECT label, sum(c) AS n FROM outside GROUP BY 1)
, terms AS (
  SELECT i.label AS emotion, i.word, CAST(i.c AS DOUBLE) AS c1, CAST(coalesce(o.c, 0) AS DOUBLE) AS c2,
         CAST(ni.n AS DOUBLE) AS n1, CAST(coalesce(no.n, 0) AS DOUBLE) AS n2, CAST(t.t AS DOUBLE) AS prior,
         CAST((SELECT sum(t) FROM word_totals) AS DOUBLE) AS n_prior
  FROM inside i JOIN word_totals t USING (word) JOIN n_inside ni USING (label)
  LEFT JOIN outside o ON o.label = i.label AND o.word = i.word LEFT JOIN n_outside no ON no.label = i.label)
, z AS (
  SELECT emotion, word, c1 / n1 AS freq,
         (ln((c1 + prior) / (n1 + n_prior - c1 - prior)) - ln((c2 + prior) / (n2 + n_prior - c2 - prior)))
           / sqrt(1 / (c1 + prior) + 1 / (c2 + prior)) AS z
  FROM terms)
{main}""").replace("\n, inside AS", ",\ninside AS", 1)


_SCORED = "SELECT emotion, word, round(z, 6) AS odds, round(freq, 6) AS freq FROM z WHERE z >= 3"
ORACLE["word_counts"] = with_ctes(["row_wc"], "SELECT word, CAST(sum(n) AS BIGINT) AS n FROM row_wc GROUP BY 1")
ORACLE["log_odds_words"] = _log_odds_sql("members_exact", _SCORED)
ORACLE["log_odds_words_contains"] = _log_odds_sql("members_contains", _SCORED)
ORACLE["top_words"] = _log_odds_sql("members_exact", """
SELECT emotion, word, round(z, 6) AS odds, round(freq, 6) AS freq, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY emotion ORDER BY z DESC, word) AS INTEGER) AS rank FROM z WHERE z >= 3)
WHERE rank <= 10""")


# --- evaluation ------------------------------------------------------------------
_M = S.str_list(MOOD_LABELS)
cte("preds", [], f"""
SELECT event_id AS id, {_M}[user_id % 3 + 1] AS y_true,
       CASE WHEN event_id % 10 < 7 THEN {_M}[user_id % 3 + 1] ELSE {_M}[event_id % 4 + 1] END AS y_pred
FROM events""")
cte("mood_list", [], f"SELECT unnest({_M}) AS label, unnest(range(0, {len(MOOD_LABELS)})) AS pos")


def _prf(src: str, label_src: str) -> str:
    return f"""
SELECT l.label, count(*) FILTER (WHERE p.y_true = l.label AND p.y_pred = l.label) AS tp,
       count(*) FILTER (WHERE p.y_pred = l.label) AS predicted,
       count(*) FILTER (WHERE p.y_true = l.label) AS support
FROM {label_src} l CROSS JOIN {src} p GROUP BY l.label"""


def _metric_cols() -> str:
    return """CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
       CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall,
       CASE WHEN tp + predicted + support = 0 THEN 0.0
            ELSE 2.0 * tp / (2 * tp + (predicted - tp) + (support - tp)) END AS f1"""


def _overall(src: str) -> str:
    return f"""
present_{src} AS (SELECT y_true AS label FROM {src} UNION SELECT y_pred FROM {src}),
counts_{src} AS ({_prf(src, f"present_{src}")}),
pcm_{src} AS (SELECT label, tp, predicted, support, {_metric_cols()} FROM counts_{src}),
overall_{src} AS (
  SELECT {_r6(f"(SELECT avg(CAST(y_true = y_pred AS DOUBLE)) FROM {src})")} AS accuracy,
         {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(precision * support) / sum(support) END")} AS precision,
         {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(recall * support) / sum(support) END")} AS recall,
         {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(f1 * support) / sum(support) END")} AS f1,
         {_r6("avg(precision)")} AS macro_precision, {_r6("avg(recall)")} AS macro_recall,
         {_r6("avg(f1)")} AS macro_f1
  FROM pcm_{src})"""


def _with(names: list[str], extra: str, main: str) -> str:
    base = with_ctes(names, "")
    if base.strip():
        return base.rstrip() + ",\n" + extra + "\n" + main
    return "WITH " + extra + "\n" + main


ORACLE["confusion_matrix"] = with_ctes(["preds", "mood_list"], f"""
SELECT t.label AS y_true, q.label AS y_pred, count(p.id) AS n,
       {_r6("count(p.id) / greatest(sum(count(p.id)) OVER (PARTITION BY t.label), 1)")} AS row_share
FROM mood_list t CROSS JOIN mood_list q
LEFT JOIN preds p ON p.y_true = t.label AND p.y_pred = q.label
GROUP BY t.label, q.label""")

ORACLE["per_class_metrics"] = _with(["preds", "mood_list"], f"pc AS ({_prf('preds', 'mood_list')})", f"""
SELECT label, {_r6("precision")} AS precision, {_r6("recall")} AS recall, {_r6("f1")} AS f1, support
FROM (SELECT label, support, {_metric_cols()} FROM pc)""")

ORACLE["overall_metrics"] = _with(["preds"], _overall("preds"), "SELECT * FROM overall_preds")

ORACLE["classification_report"] = _with(["preds", "mood_list"], f"""
pc AS ({_prf('preds', 'mood_list')}),
pm AS (SELECT label, tp, support, {_metric_cols()} FROM pc)""", f"""
SELECT label AS row, {_r6("precision")} AS precision, {_r6("recall")} AS recall, {_r6("f1")} AS f1,
       CAST(support AS BIGINT) AS support, CAST(list_position({_M}, label) - 1 AS INTEGER) AS row_order FROM pm
UNION ALL SELECT 'accuracy', NULL, NULL, {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(tp) / sum(support) END")},
       CAST(sum(support) AS BIGINT), {len(MOOD_LABELS)} FROM pm
UNION ALL SELECT 'macro avg', {_r6("avg(precision)")}, {_r6("avg(recall)")}, {_r6("avg(f1)")},
       CAST(sum(support) AS BIGINT), {len(MOOD_LABELS) + 1} FROM pm
UNION ALL SELECT 'weighted avg',
       {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(precision * support) / sum(support) END")},
       {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(recall * support) / sum(support) END")},
       {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(f1 * support) / sum(support) END")},
       CAST(sum(support) AS BIGINT), {len(MOOD_LABELS) + 2} FROM pm""")

cte("bench_preds", ["split"], """
SELECT s.mood AS y_true, (SELECT mood FROM split WHERE split = 'train' GROUP BY mood
                          ORDER BY count(*) DESC, mood LIMIT 1) AS y_pred
FROM split s WHERE s.split = 'test'""")

ORACLE["majority_benchmark"] = _with(["bench_preds"], _overall("bench_preds"),
                                     "SELECT 'Majority_Class_Benchmark' AS experiment, * FROM overall_bench_preds")

ORACLE["experiment_comparison"] = _with(["bench_preds", "preds"], _overall("bench_preds") + "," + _overall("preds"), """
SELECT 'Majority_Class_Benchmark' AS experiment, * FROM overall_bench_preds
UNION ALL SELECT 'Fixture_Predictions' AS experiment, * FROM overall_preds""")

# multi-label
cte("ml_scores", [], "SELECT vec_id, label, [" + ", ".join(S.folded("embedding", 10, c) for c in range(10)) + "] AS s FROM embeddings")
cte("ml", ["ml_scores"], """
SELECT e.vec_id AS id, CAST(r.j - 1 AS INTEGER) AS label, e.s[r.j] AS score,
       CASE WHEN r.j - 1 = e.label OR r.j - 1 = (e.label + e.vec_id % 3) % 10 THEN 1 ELSE 0 END AS y
FROM ml_scores e CROSS JOIN range(1, 11) r(j)""")
cte("ml_counts", ["ml"], """
SELECT label,
       count(*) FILTER (WHERE y = 1 AND score > 0.3) AS tp, count(*) FILTER (WHERE y = 0 AND score > 0.3) AS fp,
       count(*) FILTER (WHERE y = 1 AND NOT score > 0.3) AS fn, count(*) FILTER (WHERE y = 0 AND NOT score > 0.3) AS tn
FROM ml GROUP BY label""")
cte("ml_per", ["ml_counts"], """
SELECT label, tp, fp, fn, tn, tp + fn AS support,
       CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p,
       CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f,
       CASE WHEN tp + fp + fn + tn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + fn + tn) END AS acc
FROM ml_counts""")

ORACLE["multilabel_per_label"] = with_ctes(["ml_per"], f"""
SELECT label, {_r6("acc")} AS accuracy, {_r6("p")} AS precision, {_r6("r")} AS recall, {_r6("f")} AS f1 FROM ml_per""")

ORACLE["multilabel_metrics"] = with_ctes(["ml", "ml_per"], f"""
SELECT {_r6("(SELECT avg(ok) FROM (SELECT id, min(CAST((score > 0.3) = (y = 1) AS INTEGER)) AS ok FROM ml GROUP BY id))")} AS accuracy,
       {_r6("avg(p)")} AS macro_precision, {_r6("avg(r)")} AS macro_recall, {_r6("avg(f)")} AS macro_f1,
       {_r6("CASE WHEN sum(tp) + sum(fp) = 0 THEN 0.0 ELSE sum(tp) / (sum(tp) + sum(fp)) END")} AS micro_precision,
       {_r6("CASE WHEN sum(tp) + sum(fn) = 0 THEN 0.0 ELSE sum(tp) / (sum(tp) + sum(fn)) END")} AS micro_recall,
       {_r6("CASE WHEN 2 * sum(tp) + sum(fp) + sum(fn) = 0 THEN 0.0 ELSE 2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) END")} AS micro_f1,
       {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(p * support) / sum(support) END")} AS weighted_precision,
       {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(r * support) / sum(support) END")} AS weighted_recall,
       {_r6("CASE WHEN sum(support) = 0 THEN 0.0 ELSE sum(f * support) / sum(support) END")} AS weighted_f1
FROM ml_per""")

# labelled TSV and taxonomy
cte("b5", [], """
SELECT text, concat_ws(',', CAST(conv_id % 28 AS VARCHAR), CAST((conv_id + turn * 7) % 28 AS VARCHAR)) AS labels,
       concat_ws('-', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) AS id
FROM conversations""")

ORACLE["multi_hot"] = with_ctes(["b5"], """
SELECT id, array_to_string(list_transform(range(0, 28),
         lambda j: CAST(list_contains(list_transform(string_split(labels, ','), lambda x: CAST(x AS INTEGER)), j) AS INTEGER)), ',') AS multi_hot
FROM b5""")

from ..constants import EKMAN_MAPPING as _EK  # noqa: E402

cte("tx_pairs", [], "SELECT * FROM (VALUES " + ", ".join(
    f"({S.lit(g)}, {S.lit(m)})" for g, ms in _EK.items() for m in ms) + ") t(grp, member)")
cte("tx_old", [], f"SELECT unnest({S.str_list(EMOTIONS)}) AS label, unnest(range(0, {len(EMOTIONS)})) AS idx")
cte("tx_new", ["tx_pairs", "tx_old"], """
SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS idx FROM (
  SELECT DISTINCT grp AS label FROM tx_pairs
  UNION SELECT label FROM tx_old WHERE label NOT IN (SELECT member FROM tx_pairs))""")
cte("tx_map", ["tx_old", "tx_pairs", "tx_new"], """
SELECT list(n.idx ORDER BY o.idx) AS m FROM tx_old o LEFT JOIN tx_pairs p ON p.member = o.label
JOIN tx_new n ON n.label = coalesce(p.grp, o.label)""")
cte("b5_new", ["b5", "tx_map"], """
SELECT b.text, b.labels, b.id,
       array_to_string(list_transform(string_split(b.labels, ','), lambda x: t.m[CAST(x AS INTEGER) + 1]), ',') AS new_labels
FROM b5 b CROSS JOIN tx_map t""")

ORACLE["taxonomy_replace"] = with_ctes(["b5_new"], "SELECT text, labels, id, new_labels FROM b5_new")
ORACLE["taxonomy_labels"] = with_ctes(["b5_new", "tx_new"], """
SELECT n.idx, n.label, coalesce(u.n_uses, 0) AS n_uses FROM tx_new n LEFT JOIN (
  SELECT CAST(x AS INTEGER) AS idx, count(*) AS n_uses FROM (SELECT unnest(string_split(new_labels, ',')) AS x FROM b5_new)
  GROUP BY 1) u USING (idx)""")

# scoring
from ..sources.fixtures import RULE_PREFIXES as _RP  # noqa: E402

cte("rule_texts", [], f"""
SELECT doc_id AS id, {_M}[doc_id % 4 + 1] AS raw_mood,
       concat({S.str_list(_RP)}[(doc_id // 4) % 6 + 1], text) AS text
FROM documents""")
ORACLE["rule_override"] = with_ctes(["rule_texts"], f"""
SELECT id, raw_mood, coalesce(rule, 0) AS rule, {S.apply_rule('rule', 'raw_mood')} AS final_mood
FROM (SELECT id, raw_mood, {S.rule_hit('text', 'raw_mood')} AS rule FROM rule_texts)""")

cte("lg", [], "SELECT vec_id AS id, " + ", ".join(
    f"{S.folded('embedding', 4, c)} AS l{c + 1}" for c in range(4)) + " FROM embeddings")
cte("sm", ["lg"], """
SELECT id, l1, l2, l3, l4, e1 / s AS p1, e2 / s AS p2, e3 / s AS p3, e4 / s AS p4, am FROM (
  SELECT *, e1 + e2 + e3 + e4 AS s FROM (
    SELECT *, exp(l1 - m) AS e1, exp(l2 - m) AS e2, exp(l3 - m) AS e3, exp(l4 - m) AS e4,
           CASE WHEN l1 = m THEN 0 WHEN l2 = m THEN 1 WHEN l3 = m THEN 2 ELSE 3 END AS am
    FROM (SELECT *, greatest(l1, l2, l3, l4) AS m FROM lg)))""")
ORACLE["softmax_scores"] = with_ctes(["sm"], f"""
SELECT id, CAST(am AS INTEGER) AS argmax, {_M}[am + 1] AS mood, {_r6("p1")} AS p_happy, {_r6("p2")} AS p_sad,
       {_r6("p3")} AS p_angry, {_r6("p4")} AS p_neutral FROM sm""")

cte("scored_raw", ["rule_texts", "sm"], f"""
SELECT r.id, r.text, s.p1, s.p2, s.p3, s.p4, s.am AS raw_idx, {_M}[s.am + 1] AS raw_mood
FROM rule_texts r JOIN sm s ON s.id = r.id % (SELECT count(*) FROM embeddings)
WHERE NOT regexp_full_match(r.text, {S.lit(S.WS + '*')}) AND {S.light_clean_text('r.text')} <> ''""")
cte("scored_rule", ["scored_raw"], f"""
SELECT *, {S.rule_hit('text', 'raw_mood')} AS rule FROM scored_raw""")
cte("scored_final", ["scored_rule"], f"""
SELECT *, {S.apply_rule('rule', 'raw_mood')} AS final_mood FROM scored_rule""")
cte("scored_adj", ["scored_final"], f"""
SELECT *, [p1, p2, p3, p4] AS p, CAST(list_position({_M}, final_mood) - 1 AS INTEGER) AS final_idx FROM scored_final""")
cte("scored_sw", ["scored_adj"], """
SELECT id, raw_mood, final_mood, rule, raw_idx, final_idx, p,
       list_transform(range(0, 4), lambda i: CASE WHEN i = final_idx THEN greatest(p[raw_idx + 1], p[final_idx + 1])
                                               WHEN i = raw_idx THEN least(p[raw_idx + 1], p[final_idx + 1])
                                               ELSE p[i + 1] END) AS sw
FROM scored_adj""")
cte("scored_q", ["scored_sw"], """
SELECT id, raw_mood, final_mood, rule,
       CASE WHEN raw_idx = final_idx THEN p
            WHEN sw[1] + sw[2] + sw[3] + sw[4] > 0
              THEN list_transform(sw, lambda x: x / (sw[1] + sw[2] + sw[3] + sw[4]))
            ELSE sw END AS q
FROM scored_sw""")
ORACLE["score_texts"] = with_ctes(["scored_q"], f"""
SELECT id, raw_mood, final_mood, coalesce(rule, 0) AS rule, {_r6("q[1]")} AS p_happy, {_r6("q[2]")} AS p_sad,
       {_r6("q[3]")} AS p_angry, {_r6("q[4]")} AS p_neutral,
       (SELECT string_agg(lab, ',' ORDER BY pr DESC, ix)
        FROM (SELECT unnest({_M}) AS lab, unnest(q) AS pr, unnest(range(0, 4)) AS ix)) AS ranking
FROM scored_q""")

ORACLE["score_stream"] = ORACLE["score_texts"]


# --- features ----------------------------------------------------------------------
from ..constants import BASELINE_CONFIG as _BC, FINAL_CONFIG as _FC  # noqa: E402

_WT = "list_filter(string_split(clean_text, ' '), lambda t: length(t) >= 2)"
_W12 = (f"list_concat({_WT}, list_transform(range(1, len({_WT})), "
        f"lambda i: {_WT}[i] || ' ' || {_WT}[i + 1]))")
_CH = ("flatten(list_transform(list_filter(string_split(clean_text, ' '), lambda w: w <> ''), "
       "lambda w: flatten(list_transform(range(3, least(5, length(w) + 2) + 1), "
       "lambda n: list_transform(range(0, length(w) + 2 - n + 1), "
       "lambda o: substring(' ' || w || ' ', o + 1, n))))))")
cte("train_docs", ["split"], "SELECT id, clean_text FROM split WHERE split = 'train'")


def _block(name: str, terms: str, min_df, max_df, max_features, sublinear: bool) -> None:
    cte(f"{name}_tc_train", ["train_docs"], f"""
SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({terms}) AS term FROM train_docs) GROUP BY 1, 2""")
    cte(f"{name}_tc_all", ["processed"], f"""
SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({terms}) AS term FROM processed) GROUP BY 1, 2""")
    lo = f"{min_df}" if isinstance(min_df, int) else f"CAST({min_df} AS DOUBLE) * (SELECT count(*) FROM train_docs)"
    hi = f"{max_df}" if isinstance(max_df, int) else f"CAST({max_df} AS DOUBLE) * (SELECT count(*) FROM train_docs)"
    cte(f"{name}_vocab", [f"{name}_tc_train", "train_docs"], f"""
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, tf FROM (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM {name}_tc_train GROUP BY term
  HAVING count(*) >= {lo} AND count(*) <= {hi}
  ORDER BY tf DESC, term LIMIT {max_features})""")
    tfw = "(1.0 + ln(CAST(c.tf AS DOUBLE)))" if sublinear else "CAST(c.tf AS DOUBLE)"
    cte(f"{name}_w", [f"{name}_tc_all", f"{name}_vocab", "train_docs"], f"""
SELECT c.id, c.term, v.idx,
       {tfw} * (ln((1.0 + (SELECT count(*) FROM train_docs)) / (1.0 + v.df)) + 1.0) AS w
FROM {name}_tc_all c JOIN {name}_vocab v USING (term)""")
    cte(f"{name}_tfidf", [f"{name}_w"], f"""
SELECT id, term, idx, CASE WHEN sqrt(sum(w * w) OVER (PARTITION BY id)) > 0
                           THEN w / sqrt(sum(w * w) OVER (PARTITION BY id)) ELSE 0.0 END AS weight
FROM {name}_w""")


_block("bw", _WT, _BC["word"]["min_df"], _BC["word"]["max_df"], _BC["word"]["max_features"], _BC["word"]["sublinear"])
_block("fw", _W12, _FC["word"]["min_df"], _FC["word"]["max_df"], _FC["word"]["max_features"], _FC["word"]["sublinear"])
_block("fc", _CH, _FC["char"]["min_df"], _FC["char"]["max_df"], _FC["char"]["max_features"], _FC["char"]["sublinear"])

ORACLE["word_ngrams"] = with_ctes(["processed"], f"""
SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({_W12}) AS term FROM processed) GROUP BY 1, 2""")
ORACLE["char_ngrams"] = with_ctes(["processed"], f"""
SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({_CH}) AS term FROM processed) GROUP BY 1, 2""")
ORACLE["vocabulary"] = with_ctes(["fw_vocab"], "SELECT term, idx, df, tf FROM fw_vocab")
ORACLE["tfidf_word"] = with_ctes(["bw_tfidf"], f"SELECT id, term, {_r6('weight')} AS weight FROM bw_tfidf")
ORACLE["tfidf_sublinear"] = with_ctes(["fw_tfidf"], f"SELECT id, term, {_r6('weight')} AS weight FROM fw_tfidf")
ORACLE["feature_union"] = with_ctes(["fw_tfidf", "fc_tfidf", "fw_vocab"], f"""
SELECT id, CAST(idx AS BIGINT) AS feature, {_r6('weight')} AS weight FROM fw_tfidf
UNION ALL
SELECT id, CAST(idx + (SELECT count(*) FROM fw_vocab) AS BIGINT) AS feature, {_r6('weight')} AS weight FROM fc_tfidf""")
ORACLE["encode_sequences"] = with_ctes(["processed", "bw_vocab"], """
SELECT p.id,
       array_to_string(list_concat(ids, list_transform(range(0, 128 - len(ids)), lambda i: 0)), ',') AS input_ids,
       array_to_string(list_concat(list_transform(ids, lambda i: 1), list_transform(range(0, 128 - len(ids)), lambda i: 0)), ',') AS attention_mask
FROM processed p JOIN (
  SELECT id, list(coalesce(v.idx + 2, 1) ORDER BY pos) AS ids FROM (
    SELECT id, unnest(string_split(bert_text, ' ')[1:128]) AS term,
           unnest(range(1, len(string_split(bert_text, ' ')[1:128]) + 1)) AS pos FROM processed) t
  LEFT JOIN bw_vocab v USING (term) GROUP BY id) q USING (id)""")

ORACLE["scan_union"] = """
SELECT doc_id AS id, nullif(text, '') AS text, nullif(lang, '') AS lang,
       CASE WHEN doc_id % 3 < 2 THEN nullif(source, '') END AS source FROM documents"""

# the gradient certificate: an optimum on as many rows and features
ORACLE["model_certificate"] = with_ctes(["train_docs", "bw_vocab", "fw_vocab", "fc_vocab"], f"""
SELECT '{_BC["experiment"]}' AS experiment, true AS converged, (SELECT count(*) FROM train_docs) AS n_train,
       (SELECT count(*) FROM bw_vocab) AS n_features
UNION ALL SELECT '{_FC["experiment"]}', true, (SELECT count(*) FROM train_docs),
       (SELECT count(*) FROM fw_vocab) + (SELECT count(*) FROM fc_vocab)""")
