"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves and each half is quantised by a codebook of
its own, so that k centroids a half make k * k cells.  A query ranks the
centroids of both halves by distance and visits centroid pairs in the order of
the sum of the two distances, with a heap, until the visited cells hold
``share`` of all vectors.  Entries of visited cells are reranked by the inner
product of the original vectors.

Every vector is indexed.  The codebooks are fitted on a bounded sample of
``SAMPLE`` vectors (picked by hash) and so is ``share``: the part of the sample
that must be visited to find ``RECALL`` of the sample's own neighbours, which
are further away than those among all vectors.  Entries are grouped by the
centroid of the first half; groups are cut into blocks of bounded size on
both sides, so a cell that holds a third of all vectors is many blocks.

Defined results: vectors that are null, zero, of another length than most of
the sample, or with a null or non-finite component take no part, nor do rows
with a null id.  Where an id repeats, its smallest vector stands for it.  Ties
go to the smaller id; scores are added up alike for equal vectors, so these
tie.  Fewer candidates than ``k`` give fewer rows, an empty table none.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

SAMPLE, RECALL, TRIALS, TURNS = 20_000, 0.95, 256, 15
#: Most queries and entries of one block, and queries scored at once.
QUERY_BLOCK, ENTRY_BLOCK, AT_ONCE = 4096, 8192, 256
SLACK = 1e-9


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (2 * x @ centres.T - (centres ** 2).sum(axis=1)).argmax(axis=1)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(TURNS):
        at = nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def centroids(n: int) -> int:
    """Centroids a half for n vectors: cells grow with the root of n."""
    return int(2 ** np.clip(round(np.log2(max(2, n)) / 2 - 3), 1, 8))


class MultiIndex:
    """Two codebooks, the vectors in each cell, and the share to visit."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.counts = np.zeros((len(first), len(second)), np.int64)
        self.share = 1.0

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, :self.cut], self.first), nearest(x[:, self.cut:], self.second)

    def visit(self, q: np.ndarray) -> list[tuple[int, int]]:
        """Centroid pairs by summed distance (multi-sequence traversal): a
        pair enters the heap when both pairs before it have left it."""
        d1 = ((self.first - q[:self.cut]) ** 2).sum(axis=1)
        d2 = ((self.second - q[self.cut:]) ** 2).sum(axis=1)
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        d1, d2, o1, o2 = d1[o1].tolist(), d2[o2].tolist(), o1.tolist(), o2.tolist()
        counts, need = self.counts.tolist(), self.share * self.counts.sum()
        done = [0] * len(o1)  # pairs that have left the heap, by place of the first half
        heap, out, found = [(d1[0] + d2[0], 0, 0)], [], 0
        while heap and found < need:
            _, a, b = heapq.heappop(heap)
            done[a] = b + 1
            out.append((o1[a], o2[b]))
            found += counts[o1[a]][o2[b]]
            if a + 1 < len(o1) and (b == 0 or done[a + 1] >= b):
                if done[a + 1] == b:
                    heapq.heappush(heap, (d1[a + 1] + d2[b], a + 1, b))
            if b + 1 < len(o2) and (a == 0 or done[a - 1] > b + 1):
                heapq.heappush(heap, (d1[a] + d2[b + 1], a, b + 1))
        return out


def fit(x: np.ndarray, n: int, k: int) -> MultiIndex:
    """Codebooks from a sample of n vectors, and the share that finds RECALL
    of the k nearest of sample vectors in the sample."""
    rng = np.random.default_rng(7)
    half, size = x.shape[1] // 2, centroids(n)
    index = MultiIndex(kmeans(x[:, :half], size, rng), kmeans(x[:, half:], size, rng))
    a, b = index.cells(x)
    np.add.at(index.counts, (a, b), 1)
    needed: list[float] = []
    for t in rng.permutation(len(x))[:TRIALS]:
        scores = x @ x[t]
        scores[t] = -np.inf
        near = np.argsort(-scores, kind="stable")[:min(k, len(x) - 1)]
        order = index.visit(x[t])
        upto = np.cumsum([index.counts[c] for c in order])
        place = {c: int(u) for c, u in zip(order, upto, strict=True)}
        needed += [place[int(a[v]), int(b[v])] / len(x) for v in near]
    index.share = float(np.quantile(needed, RECALL)) if needed else 1.0
    return index


def _best(q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple:
    """(query number, id, score) of each query's k best entries that reach its
    least score.  Products pick candidates; scores are then added up row by
    row, alike for equal vectors."""
    s = q @ x.T
    s[q_ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        least = np.maximum(least, np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k])
    i, j = np.nonzero(s >= (least - SLACK)[:, None])
    i, j = i[np.isfinite(s[i, j])], j[np.isfinite(s[i, j])]
    score = (q[i] * x[j]).sum(axis=1)
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i, side="left")
    keep = np.arange(len(i)) - first < k
    return i[keep], ids[j[keep]], score[keep]


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, by
    inner product, among all other vectors."""
    spark = vectors.sparkSession
    entries = written(vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
                      .groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    n = entries.count()
    part = entries.where(F.pmod(F.xxhash64(F.lit("ann"), "vec_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, SAMPLE / max(1, n))))
    rows = sorted((r["vec_id"], r["embedding"]) for r in part.collect())
    schema = "query_id long, rank int, vec_id long, score double"
    if not rows:
        return spark.createDataFrame([], schema)
    dim = Counter(len(v) for _, v in rows).most_common(1)[0][0]
    entries = entries.where(F.size("embedding") == dim)
    sample_ids = np.array([i for i, v in rows if len(v) == dim])
    sample = np.array([v for _, v in rows if len(v) == dim], np.float64)
    index = fit(sample, n, k)
    shared = spark.sparkContext.broadcast(index)
    vector = next(f for f in entries.schema.fields if f.name == "embedding").dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = shared.value.cells(matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                             names=["vec_id", "embedding", "a", "b"])

    placed = written(entries.mapInArrow(place, f"vec_id long, embedding {vector}, a int, b int"), "cells")
    index.counts[:] = 0
    for r in placed.groupBy("a", "b").count().collect():  # no more rows than cells
        index.counts[r["a"], r["b"]] = r["count"]
    known = spark.sparkContext.broadcast((index, sample_ids, sample, *index.cells(sample)))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sample_ids, sample, sample_a, sample_b = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                ids, q = part.column(0).to_numpy(), matrix(part.column(1), dim)
                s = q @ sample.T
                s[ids[:, None] == sample_ids[None, :]] = -np.inf
                number, first, masks = [], [], []
                for row in range(len(q)):
                    seen = np.zeros(index.counts.shape, bool)
                    for cell in index.visit(q[row]):
                        seen[cell] = True
                    s[row, ~seen[sample_a, sample_b]] = -np.inf
                    some = np.flatnonzero(seen.any(axis=1))
                    number += [row] * len(some)
                    first += some.tolist()
                    masks += [np.packbits(m).tobytes() for m in seen[some]]
                # k-th best sample vector that is visited: nothing below it is among the k best found
                least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(q), -np.inf)
                number = np.array(number, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[number]), part.column(1).take(pa.array(number)), pa.array(least[number] - SLACK),
                     pa.array(first, pa.int32()), pa.array(masks, pa.binary())],
                    names=["query_id", "query", "least", "a", "cells"])

    visited = written(placed.where(is_query).select("vec_id", "embedding").mapInArrow(
        visits, f"query_id long, query {vector}, least double, a int, cells binary"), "visits")
    asked = {r["a"]: r["count"] for r in visited.groupBy("a").count().collect()}  # one row per centroid

    def blocks(sizes: dict[int, int], most: int) -> Column:
        return F.get(F.array(*[F.lit(-(-sizes.get(a, 0) // most) or 1) for a in range(len(index.first))]), F.col("a"))

    held = dict(enumerate(index.counts.sum(axis=1).tolist()))
    n_q, n_e = blocks(asked, QUERY_BLOCK), blocks(held, ENTRY_BLOCK)
    one, every = (lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")), (lambda n: F.explode(F.sequence(F.lit(0), n - 1)))
    left = visited.withColumn("qb", one("query_id", n_q)).withColumn("eb", every(n_e))
    right = placed.withColumn("eb", one("vec_id", n_e)).withColumn("qb", every(n_q))

    def rerank(queries, found):
        ids, b = found.column("vec_id").to_numpy(), found.column("b").to_numpy()
        out = []
        if queries.num_rows and found.num_rows:
            x = matrix(found.column("embedding"), dim)
            q_ids, q = queries.column("query_id").to_numpy(), matrix(queries.column("query"), dim)
            least = queries.column("least").to_numpy()
            masks = np.array([np.unpackbits(np.frombuffer(m, np.uint8)) for m in queries.column("cells").to_pylist()], bool)
            for cell in np.unique(b):
                e, asking = np.flatnonzero(b == cell), np.flatnonzero(masks[:, cell])
                for at in range(0, len(asking), AT_ONCE):
                    w = asking[at:at + AT_ONCE]
                    i, v, s = _best(q_ids[w], q[w], least[w], ids[e], x[e], k)
                    out.append((w[i], v, s))
        if out:
            i, v, s = (np.concatenate(c) for c in zip(*out, strict=True))
            order = np.lexsort((v, -s, i))
            i, v, s = i[order], v[order], s[order]
            keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
            i, v, s = q_ids[i[keep]], v[keep], s[keep]
        else:
            i, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table({"query_id": i, "vec_id": v, "score": s})

    keys = ["a", "qb", "eb"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 20 == 0)
