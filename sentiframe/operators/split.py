"""Deterministic stratified split, fixed-size sample, split overlap.

Rows are ranked inside their class by ``md5(seed || '|' || key)`` (then the key).
Exact per-class quotas follow the stratified-shuffle rule: the train quota of
a class is floor(n_c * n_train / n) plus one unit for the classes with the
largest remainders (ties: class name ascending); test takes the rest.

Scale: ranking a whole class with one window would put every row of a class
into one task.  Instead the rows of a class are counted by leading digits of
the hash; the one bucket that straddles the quota is counted again by more
digits, until it holds at most ``ROWS_PER_BUCKET`` rows, and only these get a
running count by hash, which finds the one hash at which the quota ends.  All
this reads a written table of (class, hash).  The rows themselves only compare
their hash with that one, so they are neither shuffled nor sorted; only where
the quota ends among rows of one equal hash (a repeated key) are those ranked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SPLIT_SEED, TEST_SIZE
from ..session import written


ROWS_PER_BUCKET, CHARS, HASH_CHARS = 100_000, 2, 32


def _hashed(df: DataFrame, key_col: str, seed: str) -> DataFrame:
    """A null key is hashed as the empty string."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col(key_col), F.lit("")))))


def _straddling(keyed: DataFrame, quotas: DataFrame, class_col: str, chars: int, bound: int) -> DataFrame:
    """(class, _quota, _prefix, _before, _size): the leading digits of the
    bucket in which each class's quota ends, and how many of its rows have
    lower ones.  A class without a quota has no row."""
    state = quotas.where(F.col("_quota") > 0).select(
        class_col, F.least("_quota", "_nc").alias("_quota"), F.lit("").alias("_prefix"), F.lit(0).cast("long").alias("_before"), F.col("_nc").alias("_size"))
    state, depth = written(state, "straddle"), 0
    while depth < HASH_CHARS and (state.agg(F.max("_size")).head()[0] or 0) > bound:
        rows = keyed.select(class_col, "_h").join(state, class_col).where(F.substring("_h", 1, depth) == F.col("_prefix"))
        depth += chars
        counts = rows.groupBy(class_col, "_quota", "_before", F.substring("_h", 1, depth).alias("_prefix")).agg(F.count(F.lit(1)).alias("_size"))
        lower = Window.partitionBy(class_col).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)  # 16^chars rows at most
        counts = counts.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_size").over(lower), F.lit(0)))
        inside = (F.col("_before") < F.col("_quota")) & (F.col("_before") + F.col("_size") >= F.col("_quota"))
        state = written(counts.where(inside), "straddle")
    return state


def _last_hash(hashes: DataFrame, state: DataFrame, class_col: str) -> DataFrame:
    """``state`` with the whole hash at which each class's quota ends as
    ``_prefix``; ``_size`` counts the rows of that hash."""
    rows = hashes.join(state, class_col).where(F.col("_h").startswith(F.col("_prefix")))
    counts = rows.groupBy(class_col, "_quota", "_before", "_h").agg(F.count(F.lit(1)).alias("_size"))
    lower = Window.partitionBy(class_col).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)  # one small bucket a class
    counts = counts.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_size").over(lower), F.lit(0)))
    inside = (F.col("_before") < F.col("_quota")) & (F.col("_before") + F.col("_size") >= F.col("_quota"))
    return written(counts.where(inside).select(class_col, "_quota", F.col("_h").alias("_prefix"), "_before", "_size"), "straddle")


def _first_by_hash(keyed: DataFrame, quotas_of: Callable[[DataFrame], DataFrame], class_col: str, key_col: str,
                   chars: int, bound: int) -> DataFrame:
    """``keyed`` with ``_in``; ``quotas_of`` makes the quotas of (class, _h)."""
    hashes = written(keyed.select(class_col, "_h"), "hashes")
    state = _straddling(hashes, quotas_of(hashes), class_col, chars, bound)
    return _decided(keyed, _last_hash(hashes, state, class_col), class_col, key_col)


def _decided(keyed: DataFrame, state: DataFrame, class_col: str, key_col: str) -> DataFrame:
    """``keyed`` with ``_in``: whether a row is among its class's quota, which
    ends in ``state`` at a whole hash."""
    placed = keyed.join(F.broadcast(state), class_col, "left")  # one row a class
    tied = F.col("_before") + F.col("_size") > F.col("_quota")
    if state.where(tied).isEmpty():
        return placed.withColumn("_in", F.coalesce(F.col("_h") <= F.col("_prefix"), F.lit(False)))
    open_ = F.coalesce(tied & (F.col("_h") == F.col("_prefix")), F.lit(False))
    sure = placed.where(~open_).withColumn("_in", F.coalesce(F.col("_h") <= F.col("_prefix"), F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(class_col).orderBy("_h", key_col))
    ranked = placed.where(open_).withColumn("_in", F.col("_before") + rank <= F.col("_quota"))
    return sure.unionByName(ranked)


def _quotas(bucket_counts: DataFrame, class_col: str, test_size: float) -> DataFrame:
    per_class = bucket_counts.groupBy(class_col).agg(F.sum("_n").alias("_nc"))
    total = Window.partitionBy()  # class-sized table: bounded by the number of classes
    with_n = per_class.select(class_col, "_nc", F.sum("_nc").over(total).alias("_ntot"))
    with_n = with_n.withColumn(
        "_n_train", F.col("_ntot") - F.ceil(F.lit(float(test_size)) * F.col("_ntot")))
    with_base = with_n.select(
        class_col, "_nc", "_n_train",
        F.expr("(_nc * _n_train) div _ntot").alias("_base"),
        F.expr("(_nc * _n_train) % _ntot").alias("_rem"))
    need = F.col("_n_train") - F.sum("_base").over(total)
    rank = F.row_number().over(Window.orderBy(F.desc("_rem"), F.col(class_col)))
    return with_base.select(
        class_col, "_nc", (F.col("_base") + F.when(rank <= need, 1).otherwise(0)).alias("_quota"))


def stratified_split(df: DataFrame, class_col: str, key_col: str,
                     test_size: float = TEST_SIZE, seed: str = SPLIT_SEED,
                     labels: tuple[str, str] = ("train", "test"),
                     chars: int = CHARS, bound: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add a ``split`` column with exact stratified quotas.  Rows without a
    class belong to no stratum and are left out."""
    keyed = _hashed(df.where(F.col(class_col).isNotNull()), key_col, seed)
    def quotas(hashes):
        return _quotas(hashes.groupBy(class_col).agg(F.count(F.lit(1)).alias("_n")), class_col, test_size)

    first, second = labels
    return _first_by_hash(keyed, quotas, class_col, key_col, chars, bound).select(
        *df.columns, F.when(F.col("_in"), F.lit(first)).otherwise(F.lit(second)).alias("split"))


def train_val_test_split(df: DataFrame, class_col: str, key_col: str,
                         test_size: float = TEST_SIZE, val_size: float = 0.1,
                         seed: str = SPLIT_SEED) -> DataFrame:
    """Test split first, then a validation share of the training rows."""
    first = written(stratified_split(df, class_col, key_col, test_size, seed), "split")
    train = first.where(F.col("split") == "train").drop("split")
    test = first.where(F.col("split") == "test")
    second = stratified_split(train, class_col, key_col, val_size, seed + "|val",
                              labels=("train", "validation"))
    return second.unionByName(test)


def fixed_sample(df: DataFrame, key_col: str, n: int, seed: str = SPLIT_SEED, chars: int = CHARS,
                 bound: int = ROWS_PER_BUCKET) -> DataFrame:
    """Seeded sample of min(n, rows) rows without replacement (O3): the first
    n by hash, then key, cut like a split with one class."""
    keyed = _hashed(df, key_col, seed).withColumn("_all", F.lit(1))
    def quotas(hashes):
        return hashes.groupBy("_all").agg(F.count(F.lit(1)).alias("_nc")).withColumn("_quota", F.lit(n))

    return _first_by_hash(keyed, quotas, "_all", key_col, chars, bound).where("_in").select(*df.columns)


def split_overlap(split_df: DataFrame, key_col: str = "clean_text",
                  a: str = "train", b: str = "test") -> DataFrame:
    """Number of distinct keys present in both splits (J4 leak check)."""
    left = split_df.where(F.col("split") == a).select(key_col).distinct()
    right = split_df.where(F.col("split") == b).select(key_col)
    return left.join(right, key_col, "left_semi").agg(F.count(F.lit(1)).alias("overlap"))
