"""Override rules, softmax/argmax, probability repair, label algebra."""
import math

from pyspark.sql import functions as F

from sentiframe.functions import labels as L
from sentiframe.functions.rules import apply_rule, rule_hit

CASES = [
    ("I am not so happy", "happy", 1, "sad"),
    ("never   really happy", "happy", 1, "sad"),
    ("no feeling good", "happy", 2, "sad"),
    ("great, but so tired now", "happy", 3, "sad"),
    ("but\nsad", "happy", None, "happy"),          # '.' does not cross a newline
    ("we waited and it got cancelled", "neutral", 4, "angry"),
    ("waited, last minute change", "happy", 4, "angry"),
    ("not happy, but crying", "happy", 1, "sad"),   # first rule wins
    ("not happy", "sad", None, "sad"),              # rule 1 only for happy
    ("éhappy not happy", "happy", 1, "sad"),
    ("nothappy", "happy", None, "happy"),
    ("butempty", "happy", None, "happy"),
    ("plain note", "angry", None, "angry"),
]


def test_rules(spark):
    df = spark.createDataFrame([(t, p) for t, p, _, _ in CASES], "text string, pred string")
    out = df.select(rule_hit("text", "pred").alias("r")).select("r", apply_rule("r", F.lit(None))).collect()
    rows = df.select(rule_hit("text", "pred").alias("r"), "pred").select(
        "r", apply_rule("r", "pred").alias("f")).collect()
    for (text, _, rule, final), row in zip(CASES, rows):
        assert row.r == rule, text
        assert row.f == final, text
    assert len(out) == len(CASES)


def test_softmax_argmax_repair(spark):
    df = spark.createDataFrame([([1.0, 3.0, 2.0, 3.0],)], "z array<double>")
    row = df.select(L.softmax("z").alias("p"), L.argmax("z").alias("a")).first()
    assert row.a == 1
    assert math.isclose(sum(row.p), 1.0)
    rep = df.select(L.softmax("z").alias("p")).select(
        L.repair_probabilities("p", F.lit(1), F.lit(0)).alias("q"), "p").first()
    assert math.isclose(sum(rep.q), 1.0)
    assert rep.q[0] == max(rep.p[0], rep.p[1]) / sum(rep.q) * sum(rep.q)
    ranked = df.select(L.rank_labels(L.softmax("z")).alias("r")).first().r
    assert ranked == ["sad", "neutral", "angry", "happy"]


def test_single_class(spark):
    cols = ["joy", "love", "sadness", "anger", "approval"]
    data = [(1, 1, 0, 0, 0), (1, 0, 1, 0, 0), (0, 0, 0, 0, 1), (0, 0, 0, 1, 1), (None, 0, 0, 0, 0)]
    df = spark.createDataFrame(data, ", ".join(f"{c} int" for c in cols))
    got = [r.m for r in df.select(L.single_class(cols).alias("m")).collect()]
    assert got == ["happy", None, None, "angry", None]


def test_count_labels_and_multi_hot(spark):
    df = spark.createDataFrame([("1,3",), ("",), (None,), ("2,2",)], "labels string")
    rows = df.select(L.count_labels("labels").alias("n"),
                     L.multi_hot(L.id_list("labels"), 4).alias("h")).collect()
    assert [r.n for r in rows] == [2, 0, 0, 2]
    assert [list(r.h) for r in rows] == [[0, 1, 0, 1], [0, 0, 0, 0], [0, 0, 0, 0], [0, 0, 1, 0]]
