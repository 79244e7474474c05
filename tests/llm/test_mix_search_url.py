"""Mixing, nearest neighbours, URL filter, and the pipeline."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sentiframe.llm import mixing, multi_index, url_filter
from sentiframe.llm.common import unit, written
from tests.llm import fixtures


def brute_targets(sizes, most=3.0, weights=(1, 2, 3)):
    """Share by weight, cap, share the excess again until nothing is above."""
    total, w = float(sum(sizes)), [weights[i % len(weights)] for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    rest = total
    while rest > 1e-9 and open_:
        level = rest / sum(w[i] for i in open_)
        over = {i for i in open_ if target[i] + level * w[i] >= most * sizes[i]}
        if not over:
            for i in open_:
                target[i] += level * w[i]
            break
        for i in open_:
            target[i] += level * w[i]
        rest = sum(target[i] - most * sizes[i] for i in over)
        for i in over:
            target[i] = most * sizes[i]
        open_ -= over
    return target


def test_targets_equal_resharing(spark):
    rng = np.random.default_rng(0)
    for trial in range(6):
        sizes = rng.integers(0, 1000, size=rng.integers(1, 12)) ** (1 + trial % 3)
        rows = [(i, f"s{i:02d}", int(x)) for i, x in enumerate(sizes)]
        got = mixing.source_targets(spark.createDataFrame(rows, "doc_id long, source string, size long"), (1.0, 2.0, 3.0), 3.0).collect()
        want = brute_targets([r[2] for r in rows])
        for r in got:
            assert r["target"] == pytest.approx(want[r["s"]], rel=1e-9, abs=1e-6)


def test_hypergeometric_draws(spark):
    n = 20_000
    draws = (spark.range(n).select(mixing.hypergeometric(F.lit(7.0), F.lit(5.0), F.lit(20.0), unit(F.xxhash64("id"))).alias("x"))
             .groupBy("x").count().collect())
    for r in draws:
        p = math.comb(7, int(r["x"])) * math.comb(13, 5 - int(r["x"])) / math.comb(20, 5)
        assert abs(r["count"] / n - p) < 5 * math.sqrt(p * (1 - p) / n)


def test_tree_deals_out_all_quotas(spark):
    quotas = {0: 1000, 1: 0, 2: 37, 3: 500}
    got = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "s int, quota long"), 7, 3).collect()
    by_shard = {}
    for s, q in quotas.items():
        runs = sorted((r["first"], r["last"]) for r in got if r["s"] == s)
        assert runs[0][0] == 0 and runs[-1][1] == q and all(a[1] == b[0] for a, b in zip(runs, runs[1:], strict=False))
    for r in got:
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + r["last"] - r["first"]
    assert len(by_shard) == 7 and max(by_shard.values()) - min(by_shard.values()) <= 3


def planned(spark, docs):
    return mixing.plan(written(mixing.sizes(docs), "sizes"))


def test_mix_of_odd_rows(spark):
    docs, rows = fixtures.documents(spark), fixtures.rows()
    got = planned(spark, docs).collect()
    assert len(got) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
    sizes = [sum(size(r[1]) for r in rows if r[3] == s) for s in names]
    want = dict(zip(names, brute_targets(sizes), strict=True))
    for s, total in zip(names, sizes, strict=True):
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {total}
        assert mine[0]["target"] == pytest.approx(want[s])
        taken = sum(r["size"] * len(r["shards"]) for r in mine)
        assert abs(taken - want[s]) <= max([r["size"] for r in mine])
    assert all(len(r["shards"]) <= 3 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, planned(spark, docs.repartition(5)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(len(r["shards"]) for r in got)


def test_mix_of_empty_and_wordless_tables(spark):
    docs = fixtures.documents(spark)
    assert planned(spark, docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    blank = docs.withColumn("text", F.lit(" "))
    assert {r["target"] for r in planned(spark, blank).collect()} == {0.0}


def test_mix_carries_columns_of_any_name(spark):
    docs = fixtures.documents(spark)
    names = ["_words", "_id", "_source", "_size", "_shards", "row", "id", "from", "words", "shards", "copy", "shard"]
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    mixed = mixing.mix(more)
    assert mixed.columns == more.columns
    assert sorted(map(str, mixed.select(*docs.columns[:2], "lang", "source").collect())) == sorted(
        map(str, mixing.mix(docs).select(*docs.columns[:2], "lang", "source").collect()))
    assert all(r[c] == f"{c}{r['doc_id']}" for r in mixed.where("doc_id is not null").collect() for c in names)


def test_mix_comes_near_targets(spark):
    got = mixing.op1_mixing(spark, "/root/testdata/sf0.01").groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] for r in got)


def test_traversal_is_in_order_and_complete():
    rng = np.random.default_rng(1)
    for _ in range(10):
        m = multi_index.MultiIndex(rng.normal(size=(5, 3)), rng.normal(size=(7, 3)))
        m.counts[:] = 1
        q = rng.normal(size=6)
        order = m.visit(q)
        d = [((m.first[a] - q[:3]) ** 2).sum() + ((m.second[b] - q[3:]) ** 2).sum() for a, b in order]
        assert len(set(order)) == 35 and all(x <= y + 1e-12 for x, y in zip(d, d[1:], strict=False))


def brute_search(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = min(good.get(i, v), v)
    out = []
    for q in (i for i in good if i % 20 == 0):
        near = sorted((-sum(np.float64(a) * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q)
        out += [(q, r + 1, i, pytest.approx(-s)) for r, (s, i) in enumerate(near[:k])]
    return sorted(out, key=lambda x: x[:2])


def test_search_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    vec = lambda: [float(np.float32(x)) for x in rng.integers(-4, 5, size=4)]
    rows = [(i, vec()) for i in range(70)] + [(100 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(50)]
    rows += [(None, vec()), (200, None), (201, [0.0] * 4), (202, [1.0, None, 2.0, 3.0]), (220, [float("nan"), 1.0, 1.0, 1.0]),
             (240, [float("inf"), 1.0, 1.0, 1.0]), (260, [1.0, 2.0]), (20, vec()), rows[40]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    index_all = multi_index.RECALL
    try:
        multi_index.RECALL = 1.0
        got = multi_index.search(table, F.col("vec_id") % 20 == 0, 20).collect()
    finally:
        multi_index.RECALL = index_all
    want = brute_search(rows, 20)
    hits = {(w[0], w[2]) for w in want} & {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == len(want) and len(hits) >= 0.9 * len(want)
    good = dict(rows[:70] + rows[70:120])
    for r in got:
        if r["query_id"] != 20 and r["vec_id"] != 20:
            assert r["score"] == pytest.approx(float(np.dot(good[r["query_id"]], good[r["vec_id"]])))
    for q in {r["query_id"] for r in got}:
        mine = [(r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q]
        assert [m[0] for m in sorted(mine)] == list(range(1, len(mine) + 1))
        assert sorted(mine) == sorted(mine, key=lambda m: m[1:])
    assert multi_index.search(table.limit(0), F.lit(True)).count() == 0


def test_recall(spark):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()}
    ids = np.array(sorted(rows))
    x = np.stack([rows[i] for i in ids])
    got = multi_index.op4_nearest(spark, "/root/testdata/sf0.1").collect()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ rows[q]
        s[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits += len(best & {r["vec_id"] for r in got if r["query_id"] == q})
        total += len(best)
    assert hits / total >= 0.9


URLS = [None, "", "x", "http://", "HTTP://A.B.ORG", "a://ORG/x?y#z", "a://x.com?u/fr/", "a://b#c/d", "://É.example.org/es/É", "http://a://b/c",
        "https://example.org/en/1x", "https://example.org/en/2", "http://notexample.org/es/", "http://sub.example.org/es/1?x",
        "http://com/fr/", "http://x.com/de/a", "http://x.com/fr", "http://x.com:80/fr/a", "https://casino-bonus.example.net/win",
        "https://quiet-garden.example.net/en/5", "http://" + "a" * 50_000 + ".org/" + "b" * 50_000]


def brute_url(u):
    if u is None or "://" not in u:
        return "", "", None, None
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_url_filter(spark):
    rows = [*enumerate(URLS), (None, URLS[4]), (3, URLS[3])]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in rows], "page_id long, url string, host string, verdict string")
    model = url_filter.train(spark)
    got = url_filter.judge(pages, model).collect()
    assert len(got) == len(rows)
    for r in got:
        url = URLS[4] if r["page_id"] is None else URLS[r["page_id"]]
        host, path, rule, verdict = brute_url(url)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["block_score"] >= url_filter.THRESHOLD else "allow"))
    by_id = {r["page_id"]: r["verdict"] for r in got}
    assert by_id[URLS.index("https://casino-bonus.example.net/win")] == "block"
    assert by_id[URLS.index("https://quiet-garden.example.net/en/5")] == "allow"
    assert url_filter.judge(pages.limit(0), model).count() == 0


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    fixtures.labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = fixtures.documents(spark)
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, str(tmp_path)), "test")
        seen.append(docs.count())
        if name != "byte-level BPE":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert seen[1] <= seen[0] and seen[2] == seen[1] and seen[3] < seen[2] and seen[5] == seen[4]
    empty = fixtures.documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = written(stage(spark, empty, str(tmp_path)), "test")
        assert empty.count() == 0


def test_pipeline_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    out = corpus_pipeline.run(spark, sf)
    assert out.where(F.col("ids_sha256").isNull() | F.col("decoded_sha256").isNull()).count() == 0
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    poor = out.join(labels.where("quality = 0"), "doc_id", "left_semi").select("doc_id").distinct().count()
    assert out.count() > 0 and poor <= 0.2 * labels.where("quality = 0").count()


@pytest.mark.parametrize("n_shards", [3, 500])
def test_one_partition_per_shard(spark, n_shards):
    docs = fixtures.documents(spark)
    plan = mixing.plan(written(mixing.sizes(docs), "sizes"), n_shards=n_shards)
    taken = plan.select("doc_id", F.explode("shards").alias("shard"))
    want = sorted(map(str, taken.select("doc_id").collect()))
    sizes = [r["n"] for r in taken.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()]
    mixed = mixing.mix(docs, n_shards=n_shards)
    got = [r["n"] for r in mixed.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sorted(got) == sorted(sizes) and len(got) <= n_shards
    assert sorted(map(str, mixed.select("doc_id").collect())) == want


def test_number_of_shards_follows_the_words():
    assert mixing.shards_for(None) == mixing.shards_for(1e6) == mixing.LEAST_SHARDS
    assert mixing.shards_for(1e13) == -(-10**13 // mixing.SHARD_WORDS)
