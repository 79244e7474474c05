"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins at quantiles of the training rows.  Boosting
goes round the features in turn; each turn fits one shallow tree on the bins
of one feature to the residuals of the logistic loss, and adds its leaf values
to that feature's lookup table.  Then the pairs whose best four-cell cut would
lower the residual loss most get tables of their own, boosted in turn as well.
A score is the sigmoid of an intercept plus one table entry per feature and
per pair, so scoring is vectorised bin look-ups and additions.

Learning uses a bounded sample of labelled rows (``SAMPLE`` rows, picked by
hash); the features come from the whole text and nothing else.

Defined results: a null or empty text has all-zero features and gets that
score; a document without a label is scored all the same; labels that are
null, or rows that agree in id with several labels, count once per row.
Without any labelled row, or with one class only, the score is the share of
label 1 (0.5 without rows).  Repeated rows, null ids and extra columns are
kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bound of the training sample, in rows.
SAMPLE = 20_000
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAVES, MIN_LEAF = 32, 120, 40, 6, 0.15, 4, 20

FEATURES = ["words", "word_length", "symbols", "digits", "uppers", "distinct", "repeat", "lines", "line_words",
            "dup_lines", "ends", "pipes", "bangs", "longest", "blanks"]


def features(text: str | None) -> list[float]:
    """Numbers that describe one whole text, in the order of FEATURES."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    low = np.bincount(raw[raw < 128], minlength=128)
    chars = len(raw)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    rows = max(1, len(lines))
    symbols = sum(int(low[ord(c)]) for c in "#*$%&|<>{}[]=_~^\\@+")
    letters = low[65:91].sum() + low[97:123].sum()
    repeat = sum(map(str.__eq__, words, words[1:]))
    ends = sum(x.rstrip()[-1:] in ".!?\"'" for x in lines)
    return [float(np.log1p(len(words))), sum(map(len, words)) / n, symbols / n, low[48:58].sum() / chars,
            low[65:91].sum() / max(1, letters), len(set(words)) / n ** 0.8, repeat / n, float(np.log1p(len(lines))),
            len(words) / rows, 1 - len(set(lines)) / rows, ends / rows, low[124] / n, low[33] / n,
            min(200, max(map(len, words), default=0)), (chars - sum(map(len, words))) / chars]


class Additive:
    """Lookup tables by feature and by pair of features."""

    def __init__(self, edges: list[np.ndarray], intercept: float):
        self.edges, self.intercept = edges, intercept
        self.single = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        at = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, table in enumerate(self.single):
            z += table[at[:, j]]
        for (i, j), table in self.pairs.items():
            z += table[at[:, i], at[:, j]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf value of each bin, by a tree that cuts best first into at most
    LEAVES runs of bins.  g, h, n: residual, curvature and rows by bin."""
    runs = [(0, len(g))]
    cg, ch, cn = (np.concatenate(([0.0], np.cumsum(v))) for v in (g, h, n))

    def best(a: int, b: int) -> tuple[float, int]:
        k = np.arange(a + 1, b)
        ok = (cn[k] - cn[a] >= MIN_LEAF) & (cn[b] - cn[k] >= MIN_LEAF)
        if not ok.any():
            return 0.0, 0
        part = lambda x, y: (cg[y] - cg[x]) ** 2 / (ch[y] - ch[x] + 1.0)
        gain = np.where(ok, part(a, k) + part(k, b) - part(a, b), 0.0)
        return float(gain.max()), int(k[gain.argmax()])

    while len(runs) < LEAVES:
        found = [(*best(a, b), i) for i, (a, b) in enumerate(runs)]
        gain, cut, i = max(found)
        if gain <= 1e-9:
            break
        a, b = runs.pop(i)
        runs += [(a, cut), (cut, b)]
    out = np.zeros(len(g))
    for a, b in runs:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _quadrants(cells: np.ndarray) -> np.ndarray:
    """Sums of the cells below and left of every inner corner."""
    return cells.cumsum(axis=0).cumsum(axis=1)


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best four-cell cut of a pair's grid: (gain, value of each cell)."""
    G, H = _quadrants(g), _quadrants(h)

    def four(S):
        a = S[:-1, :-1]
        b, c = S[:-1, -1:] - a, S[-1:, :-1] - a
        return a, b, c, S[-1, -1] - a - b - c

    gs, hs = four(G), four(H)
    gain = sum(x ** 2 / (y + 1.0) for x, y in zip(gs, hs, strict=True)) - G[-1, -1] ** 2 / (H[-1, -1] + 1.0)
    if not gain.size:
        return 0.0, np.zeros(g.shape)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    a, b, c, d = (x[i, j] / (y[i, j] + 1.0) for x, y in zip(gs, hs, strict=True))
    out = np.full(g.shape, d)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1] = a, b, c
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Train on features (rows by features) and labels 0 or 1."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(y) else np.zeros(0)
             for j in range(x.shape[1])]
    model = Additive(edges, float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    at, z = model.bins(x), np.full(len(y), model.intercept)

    def residual():
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    counts = [np.bincount(at[:, j], minlength=len(t)) for j, t in enumerate(model.single)]
    for _ in range(ROUNDS):
        for j, table in enumerate(model.single):
            g, h = residual()
            step = RATE * _tree(np.bincount(at[:, j], g, len(table)), np.bincount(at[:, j], h, len(table)), counts[j])
            table += step
            z += step[at[:, j]]

    def grid(i, j, v):
        shape = len(model.single[i]), len(model.single[j])
        return np.bincount(at[:, i] * shape[1] + at[:, j], v, shape[0] * shape[1]).reshape(shape)

    g, h = residual()
    gains = sorted(((_cross(grid(i, j, g), grid(i, j, h))[0], i, j)
                    for i in range(len(edges)) for j in range(i)), reverse=True)
    for _, i, j in gains[:PAIRS]:
        model.pairs[i, j] = np.zeros((len(model.single[i]), len(model.single[j])))
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in model.pairs.items():
            g, h = residual()
            step = RATE * _cross(grid(i, j, g), grid(i, j, h))[1]
            table += step
            z += step[at[:, i], at[:, j]]
    return model


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, sample: int) -> DataFrame:
    """(label, features) of at most about ``sample`` labelled documents that
    ``learn`` admits, picked by a hash of their id."""
    known = labels.where(learn & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64(F.lit("gam"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    return _with_features(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(
        F.col("quality").cast("double"), "text"), "quality double")


def _with_features(rows: DataFrame, first: str) -> DataFrame:
    """The first column, and the second, a text, as its features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))],
                                             names=[batch.schema.names[0], "features"])

    return rows.mapInArrow(run, f"{first}, features array<double>")


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Additive:
    rows = training_rows(docs, labels, learn, sample).collect()
    # in an order of the rows' own, so that reruns add up alike
    x = np.array([r["features"] for r in rows], float).reshape(len(rows), len(FEATURES))
    y = np.array([r["quality"] for r in rows], float)
    order = np.lexsort(np.column_stack([x, y]).T)
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Additive, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of ``docs`` and ``_score``."""
    source = docs.select(*columns, *([] if text_col in columns else [text_col]))
    at = source.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = source.select(*columns).withColumn("_score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(at)], float)
            values = shared.value.score(x.reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.array(values)], names=out.names)

    return source.mapInArrow(run, out)


def fold(id_col: str, of: int) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % of


THRESHOLD = 0.3


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(docs, labels, fold("doc_id", 5) != 0)
    return score(docs, model, ["doc_id"]).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))
