"""Rater agreement and annotation-corpus statistics.

Everything is computed from one ``groupBy(id)`` with one sum per label (the
reference scans the data once per agreement threshold).  Wide-to-long turns
use ``unpivot`` on label-sized results.  Hot ids: the per-id aggregation combines
map-side, and the one join back to annotation rows (``agreement_per_row``)
has sides that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import EMOTIONS, SENTIMENT_MAPPING
from ..session import written


def _r6(c):
    return F.round(c.cast("double"), 6)


def n_labels(labels: list[str] = EMOTIONS, df: DataFrame | None = None):
    """Labels per annotation row; uses a precomputed ``n_labels`` column when
    the table carries one."""
    if df is not None and "n_labels" in df.columns and labels == EMOTIONS:
        return F.col("n_labels")
    return sum(F.coalesce(F.col(e), F.lit(0)) for e in labels)


def labelled_rows(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Annotation rows with at least one label."""
    return ratings.where(n_labels(labels, ratings) != 0)


def label_sums_per_example(rows: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """(id, n_rows, one rater-sum column per label)."""
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"),
                                  *[F.sum(e).alias(e) for e in labels])


def _in_range(e: str, lo: int, hi: int | None = None):
    """Rater sum of at least ``lo``, and at most ``hi`` unless that is None."""
    return F.col(e) >= lo if hi is None else F.col(e).between(lo, hi)


def n_agreed(labels: list[str], lo: int, hi: int | None = None):
    """Number of labels whose rater sum is in range."""
    return sum(_in_range(e, lo, hi).cast("int") for e in labels)


def agreed(sums_row_labels: list[str], lo: int, hi: int | None = None) -> F.Column:
    """Comma-joined labels whose rater sum is in range, in label order."""
    return F.concat_ws(",", *[F.when(_in_range(e, lo, hi), F.lit(e)) for e in sums_row_labels])


def agreement_sets(sums: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """All four agreement variants from one per-example aggregation."""
    return sums.select("id", "n_rows", *labels,
                       agreed(labels, 1).alias("unique_labels"),
                       agreed(labels, 2).alias("agree_2"),
                       agreed(labels, 3).alias("agree_3"),
                       agreed(labels, 1, 1).alias("no_agree"))


def agreement_from_positions(rows: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """The four variants per example from rows that carry their labels as an
    array of positions (``labels``): sums per (id, position) combine map-side
    with two narrow columns, and an example's at most ``len(labels)`` sums are
    put together afterwards."""
    sums = rows.select("id", F.explode("labels").alias("at")).groupBy("id", "at").agg(F.count(F.lit(1)).alias("n"))
    per_id = sums.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("sums"))
    names = F.array(*[F.lit(e) for e in labels])

    def agreed_of(lo: int, hi: int | None = None):
        kept = F.filter("sums", lambda s: (s["n"] >= lo) & (s["n"] <= hi if hi is not None else F.lit(True)))
        return F.array_join(F.transform(kept, lambda s: F.get(names, s["at"])), ",")

    return per_id.select("id", agreed_of(1).alias("unique_labels"), agreed_of(2).alias("agree_2"),
                         agreed_of(3).alias("agree_3"), agreed_of(1, 1).alias("no_agree"))


def agreement_per_row(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Per-example agreement mapped back onto each labelled annotation row.

    The sets are written first: then both sides of the join are plain
    shuffles, which AQE can split where one id holds many rows (it does not
    split a side that an aggregation feeds).  Ratings that carry ``labels``,
    an array of positions, are summed by position; others by column."""
    rows = labelled_rows(ratings, labels)
    if "labels" in ratings.columns:
        sets = agreement_from_positions(rows, labels)
    else:
        sets = agreement_sets(label_sums_per_example(rows, labels), labels).select(
            "id", "unique_labels", "agree_2", "agree_3", "no_agree")
    return rows.select("seq", "id").join(written(sets, "agreement"), "id", "left")


def corpus_stats(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Examples, annotations, raters, unclear share, labelled rows and the
    share of labelled rows with more than three labels (A4, A5, A7)."""
    n = n_labels(labels, ratings)
    return ratings.agg(
        F.count_distinct("id").alias("n_examples"),
        F.count(F.lit(1)).alias("n_annotations"),
        F.count_distinct("rater_id").alias("n_raters"),
        _r6(F.count(F.when(F.col("example_very_unclear"), 1)) / F.count(F.lit(1))).alias("unclear_share"),
        F.count(F.when(n != 0, 1)).alias("n_labelled"),
        _r6(F.count(F.when(n > 3, 1)) / F.count(F.when(n != 0, 1))).alias("share_gt3"),
    )


MEASURES = {"n_examples": "id", "n_raters": "rater_id"}


def distinct_sketches(ratings: DataFrame, parts: int = 64, bits: int = 12) -> DataFrame:
    """(measure, part, register, rank): HyperLogLog sketches of examples and
    raters over ``parts`` parts of the rows (A4, approximate).

    A value's hash picks one of 2^bits registers by its first bits, which keeps
    the highest rank (leading zeros of the other bits, and one).  Sketches
    merge by the maximum of each register, in any order and exactly: a table of
    them is extended by adding rows, without reading old ones.  Partial
    aggregation leaves at most 2^bits rows a part and measure."""
    values = F.array(*[F.struct(F.lit(m).alias("measure"), F.xxhash64(c).alias("h"), F.col(c).isNotNull().alias("counts"))
                       for m, c in MEASURES.items()])
    rows = ratings.select(F.pmod(F.xxhash64("seq"), F.lit(parts)).alias("part"), F.explode(values).alias("v")).where("v.counts")
    rest = F.shiftleft(F.col("v.h"), bits)
    rank = F.when(rest == 0, 65 - bits).otherwise(65 - F.length(F.bin(rest)))
    return rows.groupBy("v.measure", "part", F.shiftrightunsigned(F.col("v.h"), 64 - bits).alias("register")).agg(F.max(rank).alias("rank"))


def distinct_estimates(sketches: DataFrame, bits: int = 12) -> DataFrame:
    """(measure, n_estimate) of merged sketches: the harmonic mean of the
    registers, or by the empty ones where counts are small."""
    m = float(2 ** bits)
    merged = sketches.groupBy("measure", "register").agg(F.max("rank").alias("rank"))
    sums = merged.groupBy("measure").agg(F.count(F.lit(1)).alias("used"), F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("z"))
    empty = F.lit(m) - F.col("used")
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (F.col("z") + empty)
    small = (raw <= 2.5 * m) & (empty > 0)
    return sums.select("measure", F.round(F.when(small, m * F.log(F.lit(m) / empty)).otherwise(raw)).cast("long").alias("n_estimate"))


def approximate_distinct(ratings: DataFrame, parts: int = 64, bits: int = 12) -> DataFrame:
    """Per measure: the exact distinct count, the estimate from merged
    sketches, whether that equals the estimate of one pass over all rows, and
    whether it is within three standard errors (1.04 / sqrt(2^bits) each)."""
    merged = distinct_estimates(distinct_sketches(ratings, parts, bits), bits)
    one_pass = distinct_estimates(distinct_sketches(ratings, 1, bits), bits).withColumnRenamed("n_estimate", "n_pass")
    exact = ratings.agg(*[F.count_distinct(c).alias(m) for m, c in MEASURES.items()]).unpivot([], list(MEASURES), "measure", "n_exact")
    error = 3 * 1.04 / 2 ** (bits / 2)
    estimate = F.coalesce("n_estimate", F.lit(0))
    return exact.join(merged, "measure", "left").join(one_pass, "measure", "left").select(
        "measure", "n_exact", estimate.alias("n_estimate"), F.col("n_estimate").eqNullSafe(F.col("n_pass")).alias("merged_equals_pass"),
        (F.abs(estimate - F.col("n_exact")) <= F.lit(error) * F.col("n_exact")).alias("within_error"))


def label_cardinality(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Share of labelled annotations per number of labels."""
    rows = labelled_rows(ratings, labels)
    total = rows.select(F.count(F.lit(1))).scalar()
    return rows.groupBy(n_labels(labels, rows).alias("n_labels")).agg(
        F.count(F.lit(1)).alias("n_rows"), _r6(F.count(F.lit(1)) / total).alias("share"))


def ranked_labels(table: DataFrame, value: str) -> DataFrame:
    """A label-sized table sorted by a value, descending, with the place of
    each label (O1); ties go by label."""
    order = [F.desc(value), F.asc("label")]
    return table.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy(*order)


def label_prevalence(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Per label: positive annotations and share of labelled annotations."""
    rows = labelled_rows(ratings, labels)
    wide = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(e).cast("long").alias(e) for e in labels])
    long = wide.unpivot("_n", labels, "label", "n_positive")
    return ranked_labels(long.select("label", "n_positive", _r6(F.col("n_positive") / F.col("_n")).alias("share")), "n_positive")


def mean_ratings(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Mean 0/1 rating per example and label over labelled rows."""
    return labelled_rows(ratings, labels).groupBy("id").agg(
        *[F.avg(e).alias(e) for e in labels])


def _correlations(ratings: DataFrame, labels: list[str]) -> DataFrame:
    """(label_a, label_b, r) of every unordered label pair; NaN where a label
    does not vary, as in pandas.

    An example's means are a sparse vector (few labels are rated), led by a
    constant 1.  The products of its entries, summed by pair of positions, are
    the number of examples, the sums, and the cross products at once: one
    label-sized aggregation, which then feeds every pair."""
    means = mean_ratings(ratings, labels)
    entries = F.array(F.struct(F.lit(0).alias("i"), F.lit(1.0).alias("x")),
                      *[F.struct(F.lit(i + 1).alias("i"), F.col(e).cast("double").alias("x")) for i, e in enumerate(labels)])
    sparse = means.select(F.filter(entries, lambda s: s["x"] != 0).alias("v")).select(
        F.explode("v").alias("a"), "v").select("a", F.explode("v").alias("b"))
    moments = sparse.where(F.col("a.i") >= F.col("b.i")).groupBy(
        F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.sum(F.col("a.x") * F.col("b.x")).alias("m"))
    by_pair = moments.agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws("|", F.col("i").cast("string"), F.col("j").cast("string")), "m"))).alias("m"))
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"), F.lit(labels[i]).alias("a"), F.lit(labels[j]).alias("b"))
                      for i in range(len(labels)) for j in range(i)])
    rows = by_pair.select("m", F.explode(pairs).alias("p"))

    def moment(i, j):
        key = F.concat_ws("|", i.cast("string"), j.cast("string"))
        return F.coalesce(F.try_element_at("m", key), F.lit(0.0))

    zero, i, j = F.lit(0), F.col("p.i"), F.col("p.j")
    n = moment(zero, zero)
    spread = lambda k: n * moment(k, k) - moment(k, zero) * moment(k, zero)
    cross = n * moment(i, j) - moment(i, zero) * moment(j, zero)
    r = F.when((spread(i) > 0) & (spread(j) > 0), cross / (F.sqrt(spread(i)) * F.sqrt(spread(j)))).otherwise(F.lit(float("nan")))
    return rows.select(F.col("p.a").alias("label_a"), F.col("p.b").alias("label_b"), r.alias("r"))


def label_correlation(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Pearson correlation of per-example mean ratings for each label pair
    (A10), long form (label_a, label_b, corr), lower triangle i > j (A12)."""
    return _correlations(ratings, labels).select("label_a", "label_b", _r6(F.col("r")).alias("corr"))


def label_distance(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Correlation distance 1 - r per unordered label pair."""
    return _correlations(ratings, labels).select(
        F.col("label_b").alias("label_a"), F.col("label_a").alias("label_b"), _r6(F.lit(1.0) - F.col("r")).alias("distance"))


def agreement_coverage(ratings: DataFrame, labels: list[str] = EMOTIONS,
                       thresholds: tuple[int, ...] = (2, 3)) -> DataFrame:
    """Per threshold t: examples with a label agreed by >= t raters, the
    annotation rows of those examples and their share of labelled rows (A14)."""
    sums = label_sums_per_example(labelled_rows(ratings, labels), labels)
    aggs = [F.sum("n_rows").alias("_total")]
    for t in thresholds:
        hit = n_agreed(labels, t) > 0
        aggs += [F.count(F.when(hit, 1)).alias(f"e{t}"), F.sum(F.when(hit, F.col("n_rows"))).alias(f"r{t}")]
    wide = sums.agg(*aggs)
    parts = [wide.select(F.lit(t).alias("min_agreement"), F.col(f"e{t}").alias("n_examples"),
                         F.coalesce(F.col(f"r{t}"), F.lit(0)).cast("long").alias("n_rows"),
                         _r6(F.coalesce(F.col(f"r{t}"), F.lit(0)) / F.col("_total")).alias("row_share"))
             for t in thresholds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def label_count_histogram(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Examples per number of distinct labels before (>= 1 rater) and after
    (>= 2 raters) the agreement filter (A15, U2)."""
    sums = label_sums_per_example(labelled_rows(ratings, labels), labels)
    pre = n_agreed(labels, 1)
    post = n_agreed(labels, 2)
    per_ex = sums.select(pre.alias("pre-filter"), post.alias("post-filter"))
    long = per_ex.unpivot([], ["pre-filter", "post-filter"], "type", "n_labels")
    return long.groupBy("type", "n_labels").agg(F.count(F.lit(1)).alias("n_examples"))


def label_agreed_share(ratings: DataFrame, labels: list[str] = EMOTIONS) -> DataFrame:
    """Per label: its positive annotations inside examples with a 2+ agreed
    label, divided by all labelled annotations (A16)."""
    sums = label_sums_per_example(labelled_rows(ratings, labels), labels)
    hit = n_agreed(labels, 2) > 0
    wide = sums.agg(F.sum("n_rows").alias("_total"),
                    *[F.coalesce(F.sum(F.when(hit, F.col(e))), F.lit(0)).cast("long").alias(e)
                      for e in labels])
    long = wide.unpivot("_total", labels, "label", "n_agreed")
    return ranked_labels(long.select("label", "n_agreed", _r6(F.col("n_agreed") / F.col("_total")).alias("share")), "n_agreed")


def first_per_key(ratings: DataFrame, key: str = "id", order: str = "seq",
                  cols: tuple[str, ...] = ("rater_id",)) -> DataFrame:
    """First row per key by an explicit ordering column (W1), via ``min_by``
    (partial aggregation, no sort, no window)."""
    return ratings.groupBy(key).agg(F.min(order).alias(order),
                                    *[F.min_by(c, order).alias(c) for c in cols])


def sentiment_buckets(ratings: DataFrame, labels: list[str] = EMOTIONS,
                      mapping: dict[str, list[str]] = SENTIMENT_MAPPING) -> DataFrame:
    """Per label: sentiment bucket (positive / negative / else ambiguous) and
    its positive annotations (L5, J2)."""
    wide = ratings.agg(*[F.coalesce(F.sum(e), F.lit(0)).cast("long").alias(e) for e in labels])
    long = wide.unpivot([], labels, "label", "n_positive")

    def bucket(label: str) -> str:
        if label in mapping.get("positive", []):
            return "positive"
        if label in mapping.get("negative", []):
            return "negative"
        return "ambiguous"

    lookup = F.create_map(*[x for e in labels for x in (F.lit(e), F.lit(bucket(e)))])
    return long.select("label", lookup[F.col("label")].alias("bucket"), "n_positive")
