"""Embedding whitening by a weighted covariance of the distinct vectors.

Components become integers (``floor(scale * c) + offset``), and identical
integer vectors are grouped: a distinct vector is held once, with its number
of copies.  Sums per dimension are exact.  The covariance is a centred
matrix product per batch of distinct vectors, each row weighted by its copies
(``weights="counts"``) or by one (``weights="one"``), added up over batches by
Spark.  Only the d x d matrix reaches the driver; its eigenvectors go back to
the tasks, which whiten every distinct vector once.  The result is joined back
to the rows by the vector itself.

A group of copies meets the others of its kind as a count (partial
aggregation); the join back has two plain sides, of which the distinct one is
a written table, so AQE can split a vector that a third of all rows hold.

Defined results: rows whose vector is null, empty, or holds an entry that is
null, non-finite or too large for a long take no part, nor do vectors of another length than the most
frequent one (ties: the longer).  Null and repeated ids are kept as they are.
Components whose eigenvalue is not above ``RANK`` times the largest have no
defined direction and are left out, so equal vectors alone, or an empty table,
give no rows.  Extra columns are not read.  A deviation beyond a long is an
error, never a wrapped number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

RANK = 1e-12
LARGEST = 2.0 ** 62  # entries times scale stay below, so that they are longs
AT_ONCE = 4096  # vectors of one matrix product


def integers(v: Column, scale: int, offset: int) -> Column:
    """Entries as whole numbers; null where one is null, non-finite or beyond
    a long (NaN is above all numbers in Spark)."""
    scaled = lambda c: F.lit(float(scale)) * c.cast("double")
    return F.transform(v, lambda c: F.when(F.abs(scaled(c)) < LARGEST, F.floor(scaled(c)).cast("long") + F.lit(offset).cast("long")))


def usable(v: Column, scale: int) -> Column:
    good = F.forall(v, lambda c: c.isNotNull() & (F.abs(F.lit(float(scale)) * c.cast("double")) < LARGEST))
    return v.isNotNull() & (F.size(v) > 0) & good


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Fit:
    """n and the exact sums of the fit list, with its whitening components."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, k: int):
        self.n, self.sums, self.covariance = n, sums, covariance
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[:, order]
        kept = (values > RANK * max(values[0], 0.0))[:k] if len(values) else []
        m = int(np.sum(kept))
        self.values, self.vectors = values[:m], vectors[:, :m]
        trace = float(np.trace(covariance))
        self.explained = self.values / trace if m else self.values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: in Python's integers where longs could wrap."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if bound < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return np.array([[self.n * int(c) - s for c, s in zip(row, self.sums, strict=True)] for row in x.tolist()], object)

    def deviations(self, centred: np.ndarray) -> list[int]:
        """Squared length of each row of ``centred``."""
        largest = int(np.abs(centred).max(initial=0))
        if centred.dtype == object or largest * largest * centred.shape[1] >= 2**63:
            centred = centred.astype(object)
        return (centred * centred).sum(axis=1).tolist()

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ (self.vectors / np.sqrt(self.values))


def _products(distinct: DataFrame, centre, width: int) -> np.ndarray:
    """Sum over ``distinct`` (x, weight) of weight * y y^T, where y is the row
    that ``centre`` makes of x: one matrix a task, added up by entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                y = centre(part.column(0))
                total += (y * part.column(1).to_numpy().astype(np.float64)[:, None]).T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    rows = distinct.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # width^2 / 2 rows
    out = np.zeros((width, width))
    for r in rows:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def distinct_vectors(vectors: DataFrame, scale: int = 64, offset: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(rows with their integer vector x, written table of (x, copies))."""
    good = vectors.where(usable(F.col("embedding"), scale))
    sizes = good.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.agg(F.max(F.struct("n", "dim"))["dim"].alias("dim")).head()["dim"]
    rows = good.where(F.size("embedding") == (best or 0)).select("vec_id", integers(F.col("embedding"), scale, offset).alias("x"))
    return rows, written(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "distinct-vectors")


def fit(distinct: DataFrame, k: int, weights: str = "counts") -> Fit | None:
    """Whitening of the fit list: every vector (``counts``) or every distinct
    one once (``one``)."""
    weight = {"counts": F.col("copies"), "one": F.lit(1).cast("long")}[weights]
    listed = distinct.select("x", weight.alias("weight"))
    dim = listed.select(F.max(F.size("x"))).head()[0]
    if dim is None:
        return None
    exact = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)") * F.col("weight")) for i in range(dim)]
    n, *sums = listed.agg(F.sum("weight"), *exact).head()
    sums = [int(s) for s in sums]
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])  # x - S/n without large numbers
    covariance = _products(listed, lambda column: (matrix(column, dim) - whole) - rest, dim) / n
    return Fit(int(n), sums, covariance, k)


def whiten(vectors: DataFrame, k: int = 32, weights: str = "counts", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, component int, n, deviation long, whitened, explained,
    identity_error double) for every usable row and component up to ``k``."""
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows, distinct = distinct_vectors(vectors, scale, offset)
    fitted = fit(distinct, k, weights)
    if fitted is None or not len(fitted.values):
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(fitted)
    dim, m = len(fitted.sums), len(fitted.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                centred = model.centred(matrix(part.column(0), dim))
                y = model.whitened(centred)
                flat = pa.array(y.ravel())
                offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * m)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(model.deviations(centred), pa.int64()),
                     pa.ListArray.from_arrays(offsets, flat)], names=["x", "copies", "deviation", "y"])

    done = written(distinct.mapInArrow(project, "x array<long>, copies long, deviation long, y array<double>"), "whitened")
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    means = np.array([r or 0.0 for r in done.agg(*[F.sum(F.get("y", F.lit(i)) * weight) / fitted.n for i in range(m)]).head()])
    products = _products(done.select("y", weight.alias("weight")), lambda column: matrix(column, m) - means, m)
    error = float(np.abs(products / fitted.n - np.eye(m)).max())
    explained = F.array(*[F.lit(float(e)) for e in fitted.explained])
    back = rows.join(done.select("x", "deviation", "y"), "x")
    return (back.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
                    "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
