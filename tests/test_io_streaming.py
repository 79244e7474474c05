"""Sources, sinks and the streaming path."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from sentiframe.sources import io as IO
from sentiframe.sources import versions as V
from sentiframe.streaming import scoring as ST
from tests.conftest import SF_SMALL

def test_label_list_and_mapping(spark):
    d = tempfile.mkdtemp(prefix="sf-io-")
    with open(os.path.join(d, "labels.txt"), "w") as f:
        f.write("b\na\nc")
    with open(os.path.join(d, "map.json"), "w") as f:
        f.write('{"g1": ["a", "b"], "g2": ["c"]}')
    labels = [(r.idx, r.label) for r in IO.read_label_list(spark, os.path.join(d, "labels.txt")).collect()]
    assert labels == [(0, "b"), (1, "a"), (2, "c")]
    pairs = sorted((r.group, r.member) for r in IO.read_mapping(spark, os.path.join(d, "map.json")).collect())
    assert pairs == [("g1", "a"), ("g1", "b"), ("g2", "c")]


def test_tsv_roundtrip_and_load_or_build(spark):
    d = tempfile.mkdtemp(prefix="sf-io-")
    df = spark.createDataFrame([("hi, there", "1,2", "a"), ('say "x"', "3", "b")], IO.LABELLED_TSV_SCHEMA)
    IO.write_csv(df, os.path.join(d, "tsv"), sep="\t", header=False)
    back = IO.scan_parts(spark, os.path.join(d, "tsv"), IO.LABELLED_TSV_SCHEMA, sep="\t", header=False)
    assert sorted(back.collect()) == sorted(df.collect())
    calls = []

    def build():
        calls.append(1)
        return df
    p = os.path.join(d, "cache")
    V.load_or_build(spark, p, build, {"text", "labels"})
    V.load_or_build(spark, p, build, {"text", "labels"})
    assert len(calls) == 1


def test_a_broken_version_is_an_error_and_stays(spark, tmp_path):
    folder = str(tmp_path / "table")

    def broken(path):
        os.makedirs(path)
        with open(os.path.join(path, "part-0.parquet"), "wb") as f:
            f.write(b"not a parquet file")

    path = V.publish(spark, folder, broken)
    with pytest.raises(Exception, match="(?i)parquet"):
        V.load_or_build(spark, folder, lambda: spark.range(1), {"id"})
    assert V.current(spark, folder) == path and len(os.listdir(folder)) >= 2


def test_a_crash_before_publication_leaves_the_old_version(spark, tmp_path):
    folder = str(tmp_path / "table")
    assert V.current(spark, folder) is None
    V.load_or_build(spark, folder, lambda: spark.range(3), {"id"})

    def crash(path):
        spark.range(9).write.parquet(path)  # written whole, but not published
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        V.publish(spark, folder, crash)
    assert V.load_or_build(spark, folder, lambda: spark.range(5), {"id"}).count() == 3
    assert V.load_or_build(spark, folder, lambda: spark.range(5), {"id"}, force_rebuild=True).count() == 5
    assert V.load_or_build(spark, folder, lambda: spark.range(7), {"id"}).count() == 5
    wider = V.load_or_build(spark, folder, lambda: spark.range(2).selectExpr("id", "id AS more"), {"id", "more"})
    assert sorted(wider.columns) == ["id", "more"] and wider.count() == 2


def test_the_fingerprint_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    one = V.fingerprint(spark.read.parquet(path))
    assert one == V.fingerprint(spark.read.parquet(path))
    spark.range(1).write.mode("append").parquet(path)
    assert one != V.fingerprint(spark.read.parquet(path))


def test_persisted_split_is_pruned(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train"), (2, "test"), (3, "train")], "id long, split string")
    path = str(tmp_path / "split")
    V.load_or_build(spark, path, lambda: rows, {"id", "split"}, partition_by="split")
    back = V.load_or_build(spark, path, lambda: rows, {"id", "split"}, partition_by="split").where("split = 'test'")
    assert [r.id for r in back.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in back._jdf.queryExecution().executedPlan().toString()


def test_parts_of_different_layouts(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, text string, lang string").schema
    one = spark.createDataFrame([(1, 'a "quoted", text\nwith lines ', "en"), (2, "", None)], schema)
    two = spark.createDataFrame([(" b", 3)], "text string, id long")
    IO.write_csv(one.select("lang", "id", "text"), str(tmp_path / "p1"))
    IO.write_csv(two, str(tmp_path / "p0"))
    got = IO.scan_by_name(spark, [str(tmp_path / "p1"), str(tmp_path / "p0")], schema)
    assert got.schema.names == schema.names
    assert sorted(map(tuple, got.collect())) == [(1, 'a "quoted", text\nwith lines ', "en"), (2, None, None), (3, " b", None)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|Path does not exist"):
        IO.scan_by_name(spark, [str(tmp_path / "none")], schema)


def test_text_and_json_sinks(spark, tmp_path):
    lines = spark.createDataFrame([(i, f"line {i}") for i in range(50)], "n int, line string").repartition(5)
    IO.write_text(lines, str(tmp_path / "report"), "n", "line")
    files = sorted(p for p in os.listdir(tmp_path / "report") if p.startswith("part-"))
    text = "".join(open(tmp_path / "report" / f).read() for f in files)
    assert text.splitlines() == [f"line {i}" for i in range(50)]
    IO.write_json(spark.createDataFrame([("f1", 0.5)], "metric string, value double"), str(tmp_path / "metrics"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "metrics")).collect()] == [("f1", 0.5)]


def test_scored_stream_matches_batch(spark, tmp_path):
    docs = spark.createDataFrame([(1, "not so happy"), (2, "a fine day"), (3, " ")], "id long, text string")
    logits = spark.createDataFrame([(1, [2.0, 0.0, 0.0, 0.0]), (2, [0.0, 0.0, 1.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0])], "id long, logits array<double>")
    docs.write.parquet(str(tmp_path / "in"))
    stream = ST.score_stream(ST.read_text_stream(spark, str(tmp_path / "in")), logits)
    q = stream.writeStream.format("memory").queryName("sf_score").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(spark.sql("SELECT * FROM sf_score").collect()) == sorted(ST.score_stream(docs, logits).collect())


def test_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="sf-stream-")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    docs.write.mode("overwrite").parquet(os.path.join(d, "in"))
    stream = ST.clean_stream(ST.read_text_stream(spark, os.path.join(d, "in")))
    q = stream.writeStream.format("memory").queryName("sf_clean").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = sorted(spark.sql("SELECT * FROM sf_clean").collect())
    want = sorted(ST.clean_stream(docs).collect())
    assert got == want


def test_a_broken_stream_goes_on_without_repeats(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"not so happy {i}") for i in range(40)], "id long, text string")
    logits = docs.selectExpr("id", "array(2.0D, 0.0D, 0.0D, 0.0D) AS logits")
    docs.repartition(8).write.parquet(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def scored():
        return ST.score_stream(ST.read_text_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1), logits)

    first = (scored().writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(processingTime="0 seconds").start())
    while not first.recentProgress:
        first.awaitTermination(0.05)
    first.stop()  # in the middle: some files are still to come
    begun = len([f for f in os.listdir(os.path.join(checkpoint, "commits")) if f.isdigit()])
    ST.write_stream(scored(), out, checkpoint)
    ST.write_stream(scored(), out, checkpoint)  # nothing is left
    assert 0 < begun
    got = spark.read.parquet(out)
    assert sorted(got.collect()) == sorted(ST.score_stream(docs, logits).collect())
    docs.selectExpr("id + 100 AS id", "text").write.mode("append").parquet(str(tmp_path / "in"))
    logits = logits.union(logits.selectExpr("id + 100", "logits"))
    ST.write_stream(scored(), out, checkpoint)  # files that came later
    assert spark.read.parquet(out).count() == 80
