"""Katz backoff language model over word pairs, counted and scored by context.

A text is its lower-cased words and one end token; the first token's context
is a start mark.  With c the training counts, N their sum over tokens and d_r
the Good-Turing discount of a count r (1 above ``CUT``), a token w after a
context h has the probability

* d_c * c(h w) / (c(h) + 1)      if h w was seen in training,
* a(h) * P(w)                    if h was seen, but never before w,
* P(w)                           if h was not seen,

where P(w) = d_c * c(w) / (N + 1) for known words; the rest of that sum is the
probability of one unknown word.  Every context keeps one unit in reserve (the
1 in the denominators) besides what Good-Turing takes, so there is always mass
to back off to, and a(h) = (mass not given to seen words) / (1 - sum of P over
words seen after h) makes each context's probabilities sum to one, the unknown
word included.

Words are known by 64-bit hashes, a pair by the two hashes of its words.  Pairs
are dealt into ``buckets`` that grow with the corpus, a context's pairs all to
one, so that a group holds whole contexts.  Four things keep groups even:

* words with at least one in ``HEAD`` of all tokens (``HEAD`` of them at most)
  have their counts broadcast;
* contexts with more tokens than a fair bucket are spread by the pair's hash;
* pairs with at least two in ``HOT`` of all tokens (found as those that are
  frequent in some batch, then counted exactly; ``HOT`` at most) are scored
  where they stand, by a broadcast count;
* what a group cannot know - the backoff weight of a spread context, the
  probability of a rare word - leaves it as a row for a join with the written
  tables of contexts and of words.

Logarithms of the parts add up, so a document's score is a sum over such rows;
counts of seen pairs per discounted r are kept apart, since the discounts are
known only when all pairs are counted.

Defined results: a null text is empty (its end token alone is scored).  A null
id belongs to the training part.  Repeated rows and ids are documents of their
own.  No training document: N = 0, every token is the unknown word with
probability 1.  An empty table gives none.  Only the id and text columns are
read.  Discounts that counts of counts make invalid (not in (0, 1], as in very
small corpora) fall back to the largest cut-off whose discounts are valid, and
to none if there is no such cut-off.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, written

CUT = 5  # counts above are not discounted
HEAD, HOT, LEAST_HOT = 1 << 20, 5_000, 1_000
BUCKET_TOKENS = 1_500_000
CHUNK_CHARS = 4_000_000
#: Keys of the start mark and the end token.
START, END = np.int64(0x1F83D9ABFB41BD6B), np.int64(0x5BE0CD19137E2179)


def discounts(n_r: list[float]) -> list[float]:
    """d_1 .. d_CUT from the numbers n_1 .. n_(CUT+1) of types by count."""
    for cut in range(min(CUT, len(n_r) - 1), 0, -1):
        if any(n <= 0 for n in n_r[:cut + 1]):
            continue
        common = (cut + 1) * n_r[cut] / n_r[0]
        if common >= 1:
            continue
        d = [((r + 1) * n_r[r] / n_r[r - 1] / r - common) / (1 - common) for r in range(1, cut + 1)]
        if all(0 < x <= 1 for x in d):
            return d + [1.0] * (CUT - cut)
    return [1.0] * CUT


def discounted(c: np.ndarray, d: list[float]) -> np.ndarray:
    """d_c * c for counts c."""
    return c * np.array([0.0, *d, 1.0])[np.minimum(c, CUT + 1)]


class Hash:
    """64-bit hashes of all words of a byte buffer at once: the sum of a
    random number for each byte times an odd base to the power of its place in
    the word, modulo 2^64.  A-Z have the numbers of a-z."""

    rng = np.random.Generator(np.random.PCG64(20240611))
    table = rng.integers(0, 2**64, 256, np.uint64)
    table[65:91] = table[97:123]
    base = rng.integers(0, 2**63, 1, np.uint64) * np.uint64(2) + np.uint64(1)
    blank = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
    powers = np.ones(1, np.uint64)

    @classmethod
    def words(cls, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, row) of every word of rows that lie between ``offsets``."""
        keep = ~cls.blank[data]
        start = keep.copy()
        start[1:] &= ~keep[:-1]
        first = offsets[:-1][offsets[:-1] < offsets[1:]]
        start[first] = keep[first]  # a word ends with its row
        starts = np.flatnonzero(start)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(keep)
        place = at - starts[np.cumsum(start)[at] - 1]
        longest = int(place.max()) + 1
        if len(cls.powers) < longest:
            cls.powers = np.concatenate(([np.uint64(1)], np.cumprod(np.repeat(cls.base, longest - 1))))
        values = cls.table[data[at]] * cls.powers[place]
        hashes = np.add.reduceat(values, np.searchsorted(at, starts))
        return (hashes ^ (hashes >> np.uint64(31))).view(np.int64), np.searchsorted(offsets, starts, side="right") - 1


class Tokens:
    """The tokens of some texts: ``keys`` of the distinct ones, and for each
    token its code, its context's code and its row."""

    def __init__(self, texts: pa.Array):
        raw = texts.cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        hashes, row = Hash.words(data, offsets - offsets[0])
        words, code = np.unique(hashes, return_inverse=True)
        self.keys = np.concatenate((words, [START, END]))
        start, end = len(words), len(words) + 1
        per_row = np.bincount(row, minlength=len(raw)) + 1
        ends = np.cumsum(per_row)
        self.row = np.repeat(np.arange(len(raw)), per_row)
        self.word = np.full(int(ends[-1]) if len(ends) else 0, end, np.int64)
        inner = np.ones(len(self.word), bool)
        inner[ends - 1] = False
        self.word[inner] = code
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[ends - per_row] = start
        self.per_row = per_row

    def pairs(self) -> np.ndarray:
        return self.context * len(self.keys) + self.word


class Lookup:
    """Sorted keys with values; ``get`` gives 0 for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self.find(keys)
        return np.where(at >= 0, self.values[at], 0) if len(self.keys) else np.zeros(len(keys), self.values.dtype)


def mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One 64-bit number of two, to spread and to look up by (a match is
    compared with both)."""
    x = h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) + w.view(np.uint64)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


class Model:
    """What a task needs to know of the whole corpus."""

    def __init__(self, n: int, vocabulary: int, n_r: list[int], texts: int, buckets: int, words: tuple[np.ndarray, np.ndarray]):
        self.n, self.vocabulary, self.texts, self.buckets = n, vocabulary, texts, buckets
        self.d = discounts(n_r)
        seen = sum(r * m * (1 - d) for r, m, d in zip(range(1, CUT + 1), n_r, self.d, strict=False))
        self.unknown = (1 + seen) / (n + 1)
        self.head = Lookup(*words)
        self.fair = max(1, n // max(1, buckets))
        self.set_hot(*(np.zeros(0, np.int64) for _ in range(3)))

    def set_hot(self, h: np.ndarray, w: np.ndarray, c: np.ndarray) -> None:
        order = np.argsort(mixed(h, w))
        self.hot_h, self.hot_w, self.hot_c = h[order], w[order], c[order]
        self.hot_mix = mixed(self.hot_h, self.hot_w)

    def hot(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Index of each pair among the hot ones, or -1."""
        if not len(self.hot_mix):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hot_mix, mixed(h, w)), len(self.hot_mix) - 1)
        return np.where((self.hot_h[at] == h) & (self.hot_w[at] == w), at, -1)

    def contexts(self, keys: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Tokens after each context, where that is known: a word is followed
        by a token each time it stands in a text."""
        return np.where(keys == START, self.texts, np.where(keys == END, 0, head))

    def bucket(self, h: np.ndarray, w: np.ndarray, after: np.ndarray) -> np.ndarray:
        spread = after > self.fair
        key = mixed(h, np.where(spread, w, 0))
        return ((key.view(np.uint64) >> np.uint64(11)) % np.uint64(self.buckets)).astype(np.int64)

    def probability(self, c: np.ndarray) -> np.ndarray:
        """P(w) of words by their training counts."""
        return np.where(c > 0, discounted(c, self.d) / (self.n + 1), self.unknown)


#: The rows that a group returns.  doc: a document's own row; part: a share of
#: its score; backoff, rare: contexts and words whose weights a part still
#: lacks; word: rare words of the base score; context: a context's share of
#: what its backoff weight needs; follower: rare words seen after a context.
DOC, PART, BACKOFF, RARE, WORD, CONTEXT, FOLLOWER = range(7)
PARTS = "kind int, doc long, a long, b long, n long, x double, m array<long>"
BLOB = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def _pack(**arrays: np.ndarray) -> bytes:
    columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in arrays.values()]
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays(columns, names=list(arrays))
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    batch = pa.ipc.open_stream(blob).read_next_batch()
    return {name: batch.column(i).flatten().to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)}


def _small(x: np.ndarray) -> np.ndarray:
    """As the smallest unsigned type that holds it."""
    most = int(x.max(initial=0))
    return x.astype(np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.int64)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Tokens]]:
    texts = batch.column(batch.num_columns - 1)
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at = 0
    for a, b in chunks([range(n) for n in lengths.tolist()], CHUNK_CHARS):
        yield a, b, Tokens(pc.fill_null(texts.slice(a, b - a), ""))
        at = b
    assert at == batch.num_rows


def _source(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(~held_out, F.lit(True)).alias("train"),
                       F.col(text_col).alias("text"))


def count(source: DataFrame, hot: int = HOT) -> DataFrame:
    """(h, w, c): training counts of every word (h null), and of pairs in
    those chunks where they are at least one in ``hot``.  Written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, t in _pieces(batch):
                mine = train[a:b][t.row]
                words = np.bincount(t.word[mine], minlength=len(t.keys))
                at = np.flatnonzero(words)
                often = words * hot >= mine.sum()  # a pair is no more frequent than its words
                both = mine & often[t.word] & (often[t.context] | (t.context == len(t.keys) - 2))
                pairs, c = np.unique(t.pairs()[both], return_counts=True)
                often = (c * hot >= mine.sum()) & (c >= 2)
                pairs, c = pairs[often], c[often]
                h = pa.array(np.concatenate((np.zeros(len(at), np.int64), t.keys[pairs // len(t.keys)])),
                             mask=np.arange(len(at) + len(pairs)) < len(at))
                yield pa.RecordBatch.from_arrays(
                    [h, pa.array(np.concatenate((t.keys[at], t.keys[pairs % len(t.keys)]))), pa.array(np.concatenate((words[at], c)))],
                    names=["h", "w", "c"])

    rows = source.mapInArrow(run, "h long, w long, c long")
    return written(rows.groupBy("h", "w").agg(F.sum("c").alias("c")), "word-counts")


def _hot_counts(source: DataFrame, model: Model) -> DataFrame:
    """Exact training counts of the model's hot pairs."""
    shared = source.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        total = np.zeros(len(m.hot_mix), np.int64)
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, t in _pieces(batch):
                first, second = np.isin(t.keys, m.hot_h), np.isin(t.keys, m.hot_w)
                some = np.flatnonzero(train[a:b][t.row] & first[t.context] & second[t.word])
                at = m.hot(t.keys[t.context[some]], t.keys[t.word[some]])
                total += np.bincount(at[at >= 0], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(m.hot_h), pa.array(m.hot_w), pa.array(total)], names=["h", "w", "c"])

    return source.mapInArrow(run, "h long, w long, c long").groupBy("h", "w").agg(F.sum("c").alias("c"))


def learn(source: DataFrame, head: int = HEAD, hot: int = HOT, least_hot: int = LEAST_HOT,
          bucket_tokens: int = BUCKET_TOKENS) -> tuple[Model, DataFrame]:
    """The model as far as words go, with its hot pairs, and the written table
    of training counts (w, c).  ``least_hot`` must be above CUT + 1."""
    counts = count(source, hot)
    words = counts.where(F.col("h").isNull()).select("w", "c")
    texts = source.where("train").count()
    row = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), *[F.count(F.when(F.col("c") == r, 1)) for r in range(1, CUT + 2)]).head()
    n, vocabulary, *n_r = row
    buckets = max(64, -(-n // bucket_tokens))
    frequent = words.where(F.col("c") * head >= n).toArrow()  # ``head`` rows at most: their counts add up to n or less
    model = Model(n, vocabulary, n_r, texts, buckets, tuple(frequent.column(k).to_numpy() for k in ("w", "c")))
    pairs = counts.where(F.col("h").isNotNull() & (F.col("c") * hot >= n) & (F.col("c") >= least_hot))  # ``hot`` rows at most, likewise
    found = pairs.select("h", "w", "c").toArrow()
    if found.num_rows:
        model.set_hot(*(found.column(k).to_numpy() for k in ("h", "w", "c")))
        exact = _hot_counts(source, model).toArrow()
        model.set_hot(*(exact.column(k).to_numpy() for k in ("h", "w", "c")))
    return model, words


def _deal(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's documents and pairs as blobs by bucket."""
    task, done = TaskContext.get().partitionId() << 40, 0
    for batch in batches:
        train = batch.column(1).to_numpy(zero_copy_only=False)
        for a, b, t in _pieces(batch):
            rows = np.arange(a, b)
            first, done = task + done, done + len(rows)
            in_head = model.head.find(t.keys)
            c_head = model.head.get(t.keys)
            after = model.contexts(t.keys, c_head)
            h, w, row = t.context, t.word, t.row
            known = c_head[w]
            base = np.bincount(row, weights=np.where(known > 0, np.log10((known + 1) / (model.n + model.vocabulary + 1)), 0.0), minlength=len(rows))
            n_known = np.bincount(row[known > 0], minlength=len(rows))
            rare = np.unique(row[known == 0] * len(t.keys) + w[known == 0], return_counts=True)
            codes = t.pairs()
            order = np.argsort(codes)  # tokens by pair
            codes = codes[order]
            fresh = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
            times = np.diff(fresh, append=len(codes))
            ph, pw = codes[fresh] // len(t.keys), codes[fresh] % len(t.keys)
            at = model.hot(t.keys[ph], t.keys[pw])
            is_hot = at >= 0
            log_hot = np.zeros(len(fresh))
            log_hot[is_hot] = np.log10(model.hot_c[at[is_hot]]) - np.log10(after[ph[is_hot]] + 1)
            score = np.bincount(row[order], weights=np.repeat(log_hot, times), minlength=len(rows))
            ids = batch.column(0).slice(a, b - a)
            bucket = [int(first % model.buckets)]
            blobs = [_pack(kind=np.zeros(1, np.int64), id=ids.fill_null(0).to_numpy(), null=np.asarray(ids.is_null()).astype(np.int8),
                           train=train[a:b].astype(np.int8), tokens=t.per_row, known=n_known, base=base, score=score,
                           first=np.array([first]), rare_row=_small(rare[0] // len(t.keys)), rare_word=t.keys[rare[0] % len(t.keys)],
                           rare_n=_small(rare[1]))]
            to = np.where(is_hot, -1, model.bucket(t.keys[ph], t.keys[pw], after[ph]))
            to = np.repeat(to, times).astype(np.int16 if model.buckets < 1 << 15 else np.int64)
            by_bucket = np.argsort(to, kind="stable")  # then by pair
            order, to = order[by_bucket], to[by_bucket]
            bounds = np.searchsorted(to, np.arange(model.buckets + 1))
            code = np.empty(len(t.keys), np.int64)  # of a word within a blob: broadcast words by their place there, then others
            in_training = train[a:b].astype(np.int8)
            for k in np.flatnonzero(np.diff(bounds)):
                take = order[bounds[k]:bounds[k + 1]]
                words = np.unique(np.concatenate((h[take], w[take])))
                words = words[np.argsort(np.where(in_head[words] < 0, len(model.head.keys), in_head[words]), kind="stable")]
                n_head = int((in_head[words] >= 0).sum())
                code[words] = np.arange(len(words))
                bucket.append(int(k))
                blobs.append(_pack(kind=np.ones(1, np.int64), head=_small(np.diff(in_head[words[:n_head]], prepend=0)), tail=t.keys[words[n_head:]],
                                   h=_small(code[h[take]]), w=_small(code[w[take]]),
                                   doc=_small(row[take]), first=np.array([first]), train=in_training))
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(blobs, pa.binary())], schema=BLOB)


def _rows(kind: int, n: int, doc=None, a=None, b=None, count=None, x=None, m=None) -> pa.Table:
    column = lambda v, t: pa.nulls(n, t) if v is None else pa.array(v, t)
    lists = pa.nulls(n, pa.list_(pa.int64())) if m is None else pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel(), pa.int64()))
    return pa.table({"kind": pa.array(np.full(n, kind), pa.int32()), "doc": column(doc, pa.int64()), "a": column(a, pa.int64()),
                     "b": column(b, pa.int64()), "n": column(count, pa.int64()), "x": column(x, pa.float64()), "m": lists})


def _grade(model: Model, group: pa.Table) -> pa.Table:
    """A bucket's pairs counted and scored."""
    out, parts = [], []
    for blob in group.column("blob"):
        p = _unpack(blob.as_py())
        if p["kind"][0]:
            parts.append(p)
            continue
        n, first = len(p["id"]), int(p["first"][0])
        docs = first + np.arange(n)
        ids = pa.array(p["id"], mask=p["null"] > 0)
        out.append(_rows(DOC, n, doc=docs, a=ids, b=p["train"], count=p["tokens"], x=p["base"], m=p["known"][:, None]))
        out.append(_rows(PART, n, doc=docs, x=p["score"], m=np.zeros((n, CUT), np.int64)))
        out.append(_rows(WORD, len(p["rare_row"]), doc=first + p["rare_row"].astype(np.int64), a=p["rare_word"], count=p["rare_n"]))
    if not parts:
        return pa.concat_tables(out) if out else _rows(DOC, 0)
    words = [np.concatenate((model.head.keys[np.cumsum(p["head"].astype(np.int64))], p["tail"])) for p in parts]
    keys, at = np.unique(np.concatenate(words), return_inverse=True)
    at = at.astype(np.int32)
    starts = np.cumsum([0, *map(len, words)])
    h, w = (np.concatenate([at[s:][p[side]] for s, p in zip(starts, parts, strict=False)]) for side in ("h", "w"))
    doc = np.concatenate([int(p["first"][0]) + p["doc"].astype(np.int64) for p in parts])
    train = np.concatenate([p["train"][p["doc"]] for p in parts]) > 0
    del parts, words, at
    pairs, pair = np.unique(h.astype(np.int64) * len(keys) + w, return_inverse=True)
    del h, w
    pair = pair.astype(np.int32)
    c = np.bincount(pair, weights=train, minlength=len(pairs)).astype(np.int64)
    ph, pw = pairs // len(keys), pairs % len(keys)
    c_head = model.head.get(keys)
    # a context that is not broadcast has all its pairs here
    after = model.contexts(keys, c_head)
    inside = np.bincount(ph, weights=c, minlength=len(keys)).astype(np.int64)
    after = np.where((c_head > 0) | (keys == START), after, inside)
    p_word = model.probability(c_head)
    seen = c > 0
    # scores: seen pairs, then unseen ones with what is known of them
    log_pair = np.where(seen, np.log10(np.maximum(c, 1)) - np.log10(after[ph] + 1.0), np.where(c_head[pw] > 0, np.log10(p_word[pw]), 0.0))
    ds, d = np.unique(doc, return_inverse=True)
    del doc, train
    x = np.bincount(d, weights=log_pair[pair], minlength=len(ds))
    low = np.where(c <= CUT, c, 0)[pair]
    m = np.bincount(d * (CUT + 1) + low, minlength=len(ds) * (CUT + 1)).reshape(len(ds), CUT + 1)[:, 1:]
    out.append(_rows(PART, len(ds), doc=ds, x=x, m=m))
    for kind, which, side in ((BACKOFF, ~seen & (after[ph] > 0), ph), (RARE, ~seen & (c_head[pw] == 0), pw)):
        code, times = np.unique(d[which[pair]] * len(keys) + side[pair[which[pair]]], return_counts=True)
        out.append(_rows(kind, len(code), doc=ds[code // len(keys)], a=keys[code % len(keys)], count=times))
    # what contexts need: followers by count, and the sum of P over them
    ph, pw, c = ph[seen], pw[seen], c[seen]
    has = np.unique(ph)
    n_r = np.bincount(ph * (CUT + 2) + np.minimum(c, CUT + 2) - 1, minlength=len(keys) * (CUT + 2)).reshape(len(keys), CUT + 2)[has, :CUT + 1]
    mass = np.bincount(ph, weights=np.where(c_head[pw] > 0, p_word[pw], 0.0), minlength=len(keys))[has]
    out.append(_rows(CONTEXT, len(has), a=keys[has], count=after[has], x=mass, m=n_r))
    tail = c_head[pw] == 0
    out.append(_rows(FOLLOWER, int(tail.sum()), a=keys[ph[tail]], b=keys[pw[tail]]))
    return pa.concat_tables(out)


def _of(source: DataFrame, kind: int) -> DataFrame:
    return source.where(F.col("kind") == kind)


def grade(source: DataFrame, model: Model) -> DataFrame:
    """The written rows of all buckets (``PARTS``) and the hot pairs'."""
    spark = source.sparkSession
    shared = spark.sparkContext.broadcast(model)
    blobs = source.mapInArrow(lambda batches: _deal(shared.value, batches), "bucket int, blob binary")
    rows = blobs.groupBy("bucket").applyInArrow(lambda group: _grade(shared.value, group), PARTS)
    after = model.contexts(model.hot_h, model.head.get(model.hot_h))
    mass = model.probability(model.head.get(model.hot_w))
    hot = [(CONTEXT, None, int(h), None, int(n), float(x), [0] * (CUT + 1)) for h, n, x in zip(model.hot_h, after, mass, strict=True)]
    rows = rows.unionByName(spark.createDataFrame(hot, PARTS)) if hot else rows
    return written(rows, "graded")


def _m(r: int) -> Column:
    return F.sum(F.get("m", F.lit(r - 1)))


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    every row of ``docs``; ``held_out`` rows are not learnt from.  ``sizes``
    are those of ``learn``; they change no result."""
    source = _source(docs, held_out, id_col, text_col)
    model, words = learn(source, **sizes)
    rows = grade(source, model)
    n, v = float(model.n), float(model.vocabulary)
    log_base = lambda c: F.log10((c + 1) / F.lit(n + v + 1))
    d1 = F.array(*[F.lit(x) for x in model.d])
    at = F.least(F.col("c"), F.lit(CUT)).cast("int") - 1
    p_word = words.select(F.col("w").alias("a"), "c", (F.when(F.col("c") > CUT, 1.0).otherwise(F.get(d1, at)) * F.col("c") / F.lit(n + 1)).alias("p"))
    unknown = F.lit(model.unknown)

    # order 2: discounts, then the backoff weight of every context
    m = [x or 0 for x in _of(rows, CONTEXT).agg(*[_m(r) for r in range(1, CUT + 2)]).head()]
    d2 = discounts(m)
    rare_mass = _of(rows, FOLLOWER).select(F.col("a").alias("h"), F.col("b").alias("a")).join(p_word, "a").groupBy("h").agg(F.sum("p").alias("x"))
    shares = _of(rows, CONTEXT).select("a", "n", "x", *[F.get("m", F.lit(r - 1)).alias(f"m{r}") for r in range(1, CUT + 1)])
    none = [F.lit(0).cast("long").alias(f"m{r}") for r in range(1, CUT + 1)]
    shares = shares.unionByName(rare_mass.select(F.col("h").alias("a"), F.lit(0).cast("long").alias("n"), "x", *none))
    of_context = shares.groupBy("a").agg(F.max("n").alias("n"), F.sum("x").alias("x"), *[F.sum(f"m{r}").alias(f"m{r}") for r in range(1, CUT + 1)])
    given = sum((F.col(f"m{r}") * F.lit(r * (1 - d2[r - 1])) for r in range(1, CUT + 1)), F.lit(1.0))
    weight = F.log10(given / (F.col("n") + 1) / (1 - F.col("x")))
    contexts = written(of_context.select("a", weight.alias("weight")), "contexts")

    zero = F.lit(0).cast("long")
    backoff = _of(rows, BACKOFF).select("doc", "a", "n").join(contexts, "a").select(
        "doc", zero.alias("known"), F.lit(0.0).alias("base"), (F.col("n") * F.col("weight")).alias("score"))
    rare = _of(rows, RARE).select("doc", "a", "n", F.lit(True).alias("scored")).unionByName(
        _of(rows, WORD).select("doc", "a", "n", F.lit(False).alias("scored")))
    rare = rare.join(p_word, "a", "left").select(
        "doc", F.when(~F.col("scored") & F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("known"),
        F.when(F.col("scored"), 0.0).otherwise(F.col("n") * log_base(F.coalesce("c", F.lit(0)))).alias("base"),
        F.when(F.col("scored"), F.col("n") * F.log10(F.coalesce("p", unknown))).otherwise(0.0).alias("score"))
    log_d = sum((F.get("m", F.lit(r - 1)) * F.lit(math.log10(d2[r - 1])) for r in range(1, CUT + 1)), F.lit(0.0))
    parts = _of(rows, PART).select("doc", zero.alias("known"), F.lit(0.0).alias("base"), (F.col("x") + log_d).alias("score"))
    own = _of(rows, DOC).select("doc", F.get("m", F.lit(0)).alias("known"), F.col("x").alias("base"), F.lit(0.0).alias("score"),
                                F.struct(F.col("a").alias("id"), (F.col("b") == 0).alias("held_out"), F.col("n").alias("n_tokens")).alias("own"))
    every = own.unionByName(parts.unionByName(backoff).unionByName(rare), allowMissingColumns=True)
    summed = every.groupBy("doc").agg(F.max("own").alias("own"), F.sum("known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return summed.select(F.col("own.id").alias(id_col), "own.held_out", "own.n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scores(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
