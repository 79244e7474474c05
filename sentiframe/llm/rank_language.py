"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent character n-grams (1 to ``MOST_N``
letters, words padded with one blank) of a language's training texts.  A
document's own most frequent n-grams are ranked the same way, and each of them
costs the difference between its two ranks, or the profile length if the
profile lacks it.  The language with the smallest sum of these out-of-place
distances wins; ties go to the first by name.

Profiles count a bounded sample of ``SAMPLE`` texts per language, picked by
hash, whole texts each; documents are ranked by their whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score
0; so is every text when no language was learned.  The score is the lead of
the winner: 1 - its distance / the mean distance of the others, within 0 to 1
(1 with one language).  Repeated rows, null ids and extra columns are kept as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .gam import fold

#: Profile length, longest n-gram, bound of the training texts per language.
LENGTH, MOST_N, SAMPLE = 300, 3, 4_000
UNKNOWN = "und"
#: Stands for a blank in a packed n-gram; not 0, which would hide a leading one.
BLANK = np.int64(1)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, count) of a text, n-grams packed as 21 bits per character.
    Runs of other characters count as one blank; an n-gram holds a blank at
    its ends only."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each word
    x = np.where(letter, codes, BLANK)[keep].astype(np.int64)
    x = np.concatenate(([BLANK], x, [BLANK]))[:len(x) + 1 + int(x[-1] != BLANK)]
    inner = x != BLANK
    grams = [x[inner]]
    for n in range(2, MOST_N + 1):
        gram = np.zeros(max(0, len(x) - n + 1), np.int64)
        whole = np.ones(len(gram), bool)
        for i in range(n):
            gram = (gram << 21) | x[i:len(x) - n + 1 + i]
            if 0 < i < n - 1:
                whole &= inner[i:len(x) - n + 1 + i]
        grams.append(gram[whole])
    return np.unique(np.concatenate(grams), return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by n-gram."""
    if len(grams) > 4 * length:  # only what can be among the first
        least = np.partition(counts, len(counts) - length)[len(counts) - length]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:length]]


class Profiles:
    """Ranks of every learned n-gram in every language."""

    def __init__(self, by_lang: dict[str, np.ndarray], length: int):
        self.langs, self.length = sorted(by_lang), length
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *by_lang.values()]))
        self.ranks = np.full((len(self.langs), len(self.grams)), -1, np.int64)
        for k, lang in enumerate(self.langs):
            at = np.searchsorted(self.grams, by_lang[lang])
            self.ranks[k, at] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(*ngrams(text), self.length)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        theirs = np.where(self.grams[at] == own, self.ranks[:, at], -1)
        cost = np.where(theirs < 0, self.length, np.abs(theirs - np.arange(len(own))))
        total = cost.sum(axis=1)
        best = int(total.argmin())
        rest = (total.sum() - total[best]) / max(1, len(total) - 1)
        lead = 1.0 if len(total) == 1 else 1 - total[best] / rest if rest else 0.0
        return self.langs[best], float(min(1.0, max(0.0, lead)))


def learn(docs: DataFrame, admit: Column, length: int = LENGTH, sample: int = SAMPLE) -> Profiles:
    """Profiles of the languages of ``docs`` rows that ``admit`` admits."""
    known = docs.where(admit & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Profiles({}, length)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(1_000_000 * min(1.0, sample / n)))])
    picked = known.where(F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1_000_000)) < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                by_lang.setdefault(lang, []).append(ngrams(text.as_py()))
            for lang, found in by_lang.items():
                grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([c for _, c in found]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)],
                                                 names=["lang", "gram", "n"])

    counted = picked.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the best of each hash bucket first, so that no task sorts a language's n-grams
    order = [F.desc("n"), F.asc("gram")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(*order)
    top = counted.withColumn("r", F.row_number().over(part)).where(F.col("r") <= length)
    whole = Window.partitionBy("lang").orderBy(*order)
    rows = top.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= length).collect()
    by_lang: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r["r"]):
        by_lang.setdefault(r["lang"], []).append(r["gram"])
    return Profiles({lang: np.array(g, np.int64) for lang, g in by_lang.items()}, length)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = learn(docs, fold("doc_id", 4) != 2)
    return identify(docs, profiles).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
