"""Agreement with few and many raters, and a hot example."""
import pytest
from pyspark.sql import functions as F

from sentiframe.constants import EMOTIONS
from sentiframe.operators import agreement as AG
from sentiframe.operators import words as W

SCHEMA = "id long, rater_id long, seq long, example_very_unclear boolean, " + ", ".join(f"{e} int" for e in EMOTIONS)


def rating(i, rater, seq, *labels):
    return (i, rater, seq, not labels, *[int(e in labels) for e in EMOTIONS])


def table(spark, votes):
    """votes: {example: {label: raters}}"""
    rows = []
    for i, by_label in votes.items():
        for label, n in by_label.items():
            rows += [rating(i, r, len(rows) + r, label) for r in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def test_any_number_of_raters_agrees(spark):
    r = table(spark, {1: {"joy": 150, "love": 3}, 2: {"anger": 1}, 3: {"fear": 2, "grief": 1}, 4: {"pride": 3}})
    got = {x.id: x for x in AG.agreement_sets(AG.label_sums_per_example(r)).collect()}
    assert (got[1].unique_labels, got[1].agree_2, got[1].agree_3, got[1].no_agree) == ("joy,love",) * 3 + ("",)
    assert (got[2].unique_labels, got[2].agree_2, got[2].no_agree) == ("anger", "", "anger")
    assert (got[3].unique_labels, got[3].agree_2, got[3].agree_3, got[3].no_agree) == ("fear,grief", "fear", "", "grief")
    assert (got[4].agree_2, got[4].agree_3) == ("pride", "pride")
    cover = {x.min_agreement: (x.n_examples, x.n_rows) for x in AG.agreement_coverage(r).collect()}
    assert cover == {2: (3, 159), 3: (2, 156)}
    assert {x.label for x in W.label_membership(r).where("id = 1").collect()} == {"joy", "love"}


def test_hot_example_is_split(spark):
    """One id holds nine tenths of the rows; the join back reads it in parts."""
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rows = [rating(1 if i % 10 else 2 + i, i, i, "joy") for i in range(20_000)]
        ratings = spark.createDataFrame(rows, SCHEMA).repartition(8)
        out = AG.agreement_per_row(ratings)
        assert out.count() == 20_000
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skewed" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_correlation_of_constant_and_mixed_labels(spark):
    r = table(spark, {1: {"joy": 2}, 2: {"joy": 1, "anger": 1}, 3: {"anger": 3}, 4: {"joy": 1, "love": 1}})
    got = {(x.label_a, x.label_b): x.corr for x in AG.label_correlation(r).collect()}
    assert len(got) == len(EMOTIONS) * (len(EMOTIONS) - 1) // 2
    pair = next(v for k, v in got.items() if set(k) == {"joy", "anger"})
    assert pair == pytest.approx(-0.852803, abs=1e-6)  # means 1, .5, 0, .5 and 0, .5, 1, 0
    assert all(v != v for k, v in got.items() if "fear" in k)


def test_ranks_use_unrounded_scores(spark):
    df = spark.createDataFrame([("a", "x", 3.0000001, 0.5), ("a", "b", 3.00000005, 0.5)], "emotion string, word string, z double, freq double")
    from pyspark.sql import functions as F
    top = W.top_k_per_group(df, "emotion", [F.desc("z"), F.asc("word")], 2, "word")
    assert [(r.word, r.rank) for r in top.orderBy("rank").collect()] == [("x", 1), ("b", 2)]


def test_sketches_merge_and_estimate(spark):
    rows = spark.range(30_000).selectExpr("id AS seq", "id % 9000 AS id", "id % 700 AS rater_id")
    got = {r.measure: r for r in AG.approximate_distinct(rows, parts=13).collect()}
    assert {m: r.n_exact for m, r in got.items()} == {"n_examples": 9000, "n_raters": 700}
    assert all(r.merged_equals_pass and r.within_error for r in got.values())
    assert all(abs(r.n_estimate - r.n_exact) <= 0.05 * r.n_exact for r in got.values())
    half = [AG.distinct_sketches(rows.where(f"seq % 2 = {i}"), parts=5) for i in (0, 1)]
    added = {r.measure: r.n_estimate for r in AG.distinct_estimates(half[0].unionByName(half[1])).collect()}
    assert added == {m: r.n_estimate for m, r in got.items()}  # new rows' sketches extend the old


def test_positions_and_columns_agree(spark):
    rows = [(1, 1, [0, 3]), (2, 1, [3]), (3, 1, [27]), (4, 2, [5]), (5, 2, [5]), (6, 2, [5]), (7, 3, []), (8, 4, [1, 2])]
    base = spark.createDataFrame(rows, "seq long, id long, labels array<int>")
    wide = base.select("seq", "id", F.size("labels").alias("n_labels"), "labels",
                       *[F.array_contains("labels", F.lit(i)).cast("int").alias(e) for i, e in enumerate(EMOTIONS)])
    a = AG.agreement_per_row(wide).collect()
    b = AG.agreement_per_row(wide.drop("labels")).collect()
    assert sorted(a) == sorted(b) and len(a) == 7


def test_labels_are_sorted_by_value(spark):
    rows = [rating(i, 1, i, *labels) for i, labels in enumerate([("joy",), ("anger", "joy"), ("anger",), ("fear",), ("joy",)])]
    got = AG.label_prevalence(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.label, r["rank"], r.n_positive) for r in got[:3]] == [("joy", 1, 3), ("anger", 2, 2), ("fear", 3, 1)]
    assert [r["rank"] for r in got] == list(range(1, len(EMOTIONS) + 1))
    assert [r.label for r in got[3:]] == sorted(r.label for r in got[3:])
