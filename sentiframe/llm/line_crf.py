"""Quality rules: base counts, and line labelling by a linear-chain CRF.

Every line with a word is a token of a chain.  Its features are levels of a
few ratios (``LEVELS``); a linear-chain conditional random field with the
states boilerplate and content weighs them together with the state of the line
before.  Viterbi decoding marks each line, and a document is kept if at least
``SHARE`` of its words stand in content lines.

Labels are known for documents, not for lines, so line labels are hidden.  The
weights are learned by EM under a constraint (posterior regularisation) from a
bounded sample of ``SAMPLE`` labelled documents, picked by hash: the expected
share of content lines is at least ``GOOD`` in a document of good quality and at
most ``POOR`` in a poor one.  The E-step adds to all lines of a document the
least tilt at which its share meets that, found by dual ascent beside the
weights; the M-step follows the gradient towards the tilted expectations.  A
document whose lines meet its constraint by themselves has no tilt, so clean
lines of a poor page and junk lines of a good one keep their own labels.

Defined results: words are runs of characters other than x20 and x09-x0D; a
null or empty text has no words and fails the base rule; blank lines are no
tokens; without labelled rows every line is content.  Repeated rows, null ids
and extra columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, WORD

#: FIXED VALUES: characters that count as symbols; words that mark notices.
SYMBOLS = "#*$%&|<>"
NOTICES = ("licens", "copyright", "all rights reserved", "cookie", "privacy policy", "terms of use", "subscribe", "sign up", "log in")
#: Upper ends of the levels of the ratios, and of the numbers of words.
RATIO, LENGTH = (0.0, 0.05, 0.2, 0.5), (2, 5, 10, 25)
#: Levels of each feature: words, symbols, upper-case words, a word after itself, words seen before in the line,
#: double exclamation marks, bars, an end mark, a copy of an earlier line, place, notice.
LEVELS = (5, 5, 5, 5, 5, 5, 5, 2, 2, 4, 2)
OFFSETS = np.concatenate(([0], np.cumsum(LEVELS)[:-1]))
SAMPLE, ITERATIONS, PENALTY, SHARE = 4_000, 80, 1.0, 0.5
#: Content shares that labelled documents must have in expectation; the step of the dual ascent and the largest tilt.
GOOD, POOR, ASCENT, MOST_TILT = 0.9, 0.25, 1.0, 6.0
#: Penalty of the steps between states, as a share of all lines: labels of whole documents say little about changes
#: within one, and without it the chain learns that states never change.
STEADY = 0.03
REPEAT_WINDOW = 5


words_of = re.compile(WORD).findall


def _level(x: float, ends: tuple) -> int:
    for i, end in enumerate(ends):
        if x <= end:
            return i
    return len(ends)


def line_features(text: str | None) -> tuple[np.ndarray, list[int]]:
    """(features of each line with a word as indexes of one weight vector,
    words of each such line)."""
    rows, sizes, seen = [], [], set()
    for line in (text or "").split("\n"):
        words = words_of(line)
        n = len(words)
        if not n:
            continue
        rows.append([
            _level(n, LENGTH), _level(sum(map(line.count, SYMBOLS)) / n, RATIO),
            _level(sum(map(str.isupper, words)) / n, RATIO), _level(sum(map(eq, words, words[1:])) / n, RATIO),
            _level(1 - len(set(words)) / n, RATIO), _level(line.count("!!") / n, RATIO), _level(line.count("|") / n, RATIO),
            int(words[-1][-1] in ".!?\"'"), int(line in seen), 0, int(any(map(line.lower().__contains__, NOTICES)))])
        sizes.append(n)
        seen.add(line)
    if rows:
        rows[0][9] += 1
        rows[-1][9] += 2
    return np.array(rows, np.int64).reshape(len(rows), len(LEVELS)) + OFFSETS, sizes


class Chain:
    """Weights: of each feature level for content, of each pair of states."""

    def __init__(self):
        self.emit = np.zeros(sum(LEVELS))
        self.step = np.zeros((2, 2))
        self.bias = 0.0

    def decode(self, features: np.ndarray) -> list[int]:
        """Most likely states by Viterbi; content wins ties."""
        if not len(features):
            return []
        content = (self.emit[features].sum(axis=1) + self.bias).tolist()
        (s00, s01), (s10, s11) = self.step.tolist()
        poor, good, back = 0.0, content[0], []
        for x in content[1:]:
            from0, from1 = poor + s00 > good + s10, poor + s01 > good + s11
            back.append((0 if from0 else 1, 0 if from1 else 1))
            poor, good = (poor + s00 if from0 else good + s10), (poor + s01 if from1 else good + s11) + x
        states = [0 if poor > good else 1]
        for b in reversed(back):
            states.append(b[states[-1]])
        return states[::-1]

    def content_share(self, text: str | None) -> float:
        features, sizes = line_features(text)
        states = self.decode(features)
        return sum(n for n, s in zip(sizes, states, strict=True) if s) / max(1, sum(sizes)) if sizes else 0.0


def _posterior(scores: np.ndarray, mask: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded chains.  scores: (chains, lines) of the
    content state; returns P(content) and the expected number of each step."""
    n, length = scores.shape
    e = np.stack([np.zeros_like(scores), scores], axis=2)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0]
    for t in range(1, length):
        go = np.logaddexp(alpha[:, t - 1, :1] + step[0], alpha[:, t - 1, 1:] + step[1]) + e[:, t]
        alpha[:, t] = np.where(mask[:, t, None], go, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        ahead = e[:, t + 1] + beta[:, t + 1]
        go = np.logaddexp(ahead[:, :1] + step[:, 0], ahead[:, 1:] + step[:, 1])
        beta[:, t] = np.where(mask[:, t + 1, None], go, 0.0)
    log_z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    p = np.exp(alpha[:, :, 1] + beta[:, :, 1] - log_z[:, None]) * mask
    pair = np.exp(alpha[:, :-1, :, None] + step + (e + beta)[:, 1:, None, :] - log_z[:, None, None, None])
    return p, (pair * mask[:, 1:, None, None]).sum(axis=(0, 1))


def fit(chains: list[np.ndarray], labels: list[int]) -> Chain:
    """Penalised likelihood of hidden line labels under the content shares that
    the documents' labels (1 good, 0 poor) ask for, by Adam steps."""
    model = Chain()
    pairs = [(c, y) for c, y in zip(chains, labels, strict=True) if len(c)]
    if len({y for _, y in pairs}) < 2:
        model.bias = 1.0 if not pairs or pairs[0][1] else -1.0
        return model
    pairs.sort(key=lambda x: len(x[0]))
    blocks = []
    for at in range(0, len(pairs), 256):
        part = pairs[at:at + 256]
        size = np.array([len(c) for c, _ in part])
        mask = np.arange(size.max()) < size[:, None]
        features = np.zeros((*mask.shape, len(LEVELS)), np.int64)
        features[mask] = np.concatenate([c for c, _ in part])
        good = np.array([y for _, y in part]) == 1
        blocks.append((features, mask, good, size, np.where(good, 2.0, -2.0)))
    total = sum(len(c) for c, _ in pairs)
    moments = [np.zeros(len(model.emit) + 5), np.zeros(len(model.emit) + 5)]
    for turn in range(1, ITERATIONS + 1):
        grad = -PENALTY * np.concatenate((model.emit, STEADY / PENALTY * total * model.step.ravel(), [0.0]))
        for features, mask, good, size, tilt in blocks:
            scores = model.emit[features].sum(axis=2) + model.bias
            p, steps = _posterior(scores, mask, model.step)
            q, tilted = _posterior(scores + tilt[:, None], mask, model.step)
            rest = q - p
            grad[:len(model.emit)] += np.bincount(features[mask].ravel(), np.repeat(rest[mask], len(LEVELS)), len(model.emit))
            grad[len(model.emit):-1] += (tilted - steps).ravel()
            grad[-1] += rest.sum()
            share = q.sum(axis=1) / size
            tilt[:] = np.where(good, np.clip(tilt + ASCENT * (GOOD - share), 0.0, MOST_TILT),
                               np.clip(tilt + ASCENT * (POOR - share), -MOST_TILT, 0.0))
        grad /= total
        for m, beta, g in zip(moments, (0.9, 0.99), (grad, grad ** 2), strict=True):
            m *= beta
            m += (1 - beta) * g
        move = 0.15 * (moments[0] / (1 - 0.9 ** turn)) / (np.sqrt(moments[1] / (1 - 0.99 ** turn)) + 1e-8)
        model.emit += move[:len(model.emit)]
        model.step += move[len(model.emit):-1].reshape(2, 2)
        model.bias += move[-1]
    return model


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = text.encode().split()  # bytes split at x20 and x09-x0D alone
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return (n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, _repeat_words(words))


def _repeat_words(words: list[bytes]) -> int:
    if len(words) <= REPEAT_WINDOW:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    last = len(words) - REPEAT_WINDOW + 1
    window = np.zeros(last, np.uint64)
    for i in range(REPEAT_WINDOW):  # 64-bit hash of each window
        window = (window ^ (h[i:i + last] + np.uint64(i))) * np.uint64(0x9E3779B97F4A7C15)
        window ^= window >> np.uint64(29)
    order = np.sort(window)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(window, twice))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + REPEAT_WINDOW, -1)
    return int((edge.cumsum()[:-1] > 0).sum())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Fit on at most about ``sample`` labelled documents."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64(F.lit("crf"), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * sample / n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(t.as_py())[0].astype(np.int16).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["quality", "lines"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select(F.col("quality").cast("int"), "text")
            .mapInArrow(run, "quality int, lines binary").collect())
    rows.sort(key=lambda r: (r["quality"], r["lines"]))  # reruns add up alike
    return fit([np.frombuffer(r["lines"], np.int16).astype(np.int64).reshape(-1, len(LEVELS)) for r in rows], [r["quality"] for r in rows])


def apply_rules(docs: DataFrame, model: Chain, share: float = SHARE) -> DataFrame:
    """(doc_id, base counts, base_failed, content_share, kept) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, content = [], []
            for t in batch.column(1):
                text = t.as_py()
                base.append(base_counts(text))
                content.append(shared.value.content_share(text))
            table = np.array(base, np.int64).reshape(len(base), len(counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(table[:, i]) for i in range(len(counts))), pa.array(content, pa.float64())],
                                             names=["doc_id", *counts, "content_share"])

    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, {', '.join(f'{c} long' for c in counts)}, content_share double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= share))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_rules(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
