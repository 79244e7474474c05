"""Fill-in-middle against regular expressions, whitening against one dense
computation with whole numbers."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentiframe.llm import fim, whiten
from tests.llm import fixtures

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text, rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rng = random.Random(7)
    parts = ["a", "é", "中文", "😀", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", " ", "\x85", "<", "<S", "P>", "<P", "word"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    long = ["中 文" * 3000, " " * 9000, "x" * 9000 + " y", ("w " * 5000), "é" * 4096 + " " + "é" * 4095 + "a b", "no <M> cut here"]
    return [*fixtures.texts(), *made, *long]


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_cuts_equal_regular_expressions(block, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", block)
    for text in odd_texts():
        data = (text or "")[:20_000].encode()
        units = UNIT.findall(data.decode())
        blocks = fim.Blocks(data)
        assert blocks.units == len(units)
        for k in {0, 1, len(units) // 3, len(units) - 1, len(units)}:
            if 0 <= k <= len(units):
                head = "".join(units[:k])
                assert blocks.cut(k) == (len(head.encode()), len(head))


def test_fenwick_descends_to_the_block():
    units, points = np.array([0, 3, 0, 0, 2, 1, 0]), np.array([5, 4, 6, 1, 2, 3, 9])
    tree = fim.Fenwick(units, points)
    for k in range(1, 7):
        block = int(np.searchsorted(np.cumsum(units), k))
        assert tree.find(k) == (block, units[:block].sum(), points[:block].sum())


@pytest.mark.parametrize("rate, spm", [(50, 80), (100, 0)])
def test_fim_table(spark, rate, spm):
    rows = [(i if i % 40 else None, t, "kept", 1) for i, t in enumerate(odd_texts())]
    rows += rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form2 string, c0 int").repartition(3)
    got = fim.transform(docs, keep=("form2", "c0"), rate=rate, spm=spm).withColumn("back", fim.restore()).collect()
    want = [(i, "kept", 1, *plain_fim(i, t, rate, spm), t or "") for i, t, _, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {r.form for r in got} == ({"plain", "psm", "spm"} if spm else {"plain", "psm"})
    assert fim.transform(docs.limit(0)).count() == 0


def test_fim_restores_parts_that_look_like_markers(spark):
    texts = ["<P <S <M x> <", "< <P y S> <M", "S> P> M> <S"]
    docs = spark.createDataFrame([(i, t) for i in range(40) for t in texts], "doc_id long, text string")
    got = fim.transform(docs, rate=100).select("doc_id", "form", fim.restore().alias("back")).collect()
    assert sorted(r.back for r in got) == sorted(texts * 40)


def plain_whitening(vectors, weights="counts"):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], object)
    fit = x if weights == "counts" else np.array(sorted({tuple(r) for r in x.tolist()}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (x * n - sums)
    y = (centred / n).astype(float)
    f = ((fit * n - sums) / n).astype(float)
    values, v = np.linalg.eigh(f.T @ f / n)
    return n, [int((r * r).sum()) for r in centred], y, values[::-1], v[:, ::-1], np.trace(f.T @ f / n)


SCHEMA = "vec_id long, embedding array<float>, label int, x long, y array<int>, copies int, weight double"


def vectors(seed=3, n=300, dim=6):
    rng = np.random.default_rng(seed)
    rows = [(i, v.tolist()) for i, v in enumerate((rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim))).astype(np.float32))]
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(None, rows[8][1]), (5, rows[9][1])]
    bad = [(1, None), (2, []), (3, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (4, [float("nan")] * dim), (6, [float("inf")] * dim), (8, [1.0, 2.0]),
           (9, [3e38] + [0.0] * (dim - 1))]
    return rows, bad


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_equals_dense(spark, weights):
    good, bad = vectors()
    table = spark.createDataFrame([(i, v, 1, 1, [1], 1, 1.0) for i, v in good + bad], SCHEMA).repartition(4)
    got = whiten.whiten(table, k=4, weights=weights).collect()
    n, deviations, y, values, v, trace = plain_whitening([v for _, v in good], weights)
    assert len(got) == 4 * len(good)
    assert {r["n"] for r in got} == {n}
    want = {}
    for (i, _), d, row in zip(good, deviations, y, strict=True):
        for k in range(4):
            want.setdefault((i, k + 1, d), []).append(float(row @ v[:, k] / np.sqrt(values[k])))
    signs = {}
    for r in got:
        options = want[r["vec_id"], r["component"], r["deviation"]]
        best = min(options, key=lambda o: abs(abs(o) - abs(r["whitened"])))
        assert abs(r["whitened"]) == pytest.approx(abs(best), rel=1e-7, abs=1e-9)
        if abs(best) > 1e-6:
            signs.setdefault(r["component"], set()).add(np.sign(best) == np.sign(r["whitened"]))
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-9
    assert all(len(s) == 1 for s in signs.values())  # one sign for all rows


def test_whitening_without_directions(spark):
    table = lambda rows: spark.createDataFrame([(i, v, 1, 1, [1], 1, 1.0) for i, v in rows], SCHEMA)
    assert whiten.whiten(table([])).count() == 0
    assert whiten.whiten(table([(1, None), (2, [])])).count() == 0
    assert whiten.whiten(table([(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    flat = whiten.whiten(table([(i, [float(i % 3), 2.0]) for i in range(6)])).collect()  # one dimension does not vary
    assert {r["component"] for r in flat} == {1} and len(flat) == 6 and flat[0]["explained"] == pytest.approx(1.0)


def test_deviations_do_not_wrap():
    model = whiten.Fit(10**9, [0, 0], np.eye(2), 2)
    centred = model.centred(np.array([[5, 0], [10**9, 10**9]]))
    assert model.deviations(centred) == [25 * 10**18, 2 * 10**36]


def test_queries_read_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    got = fim.op12_fim(spark, sf)
    assert got.count() == n
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("own"))
    assert got.join(docs, "doc_id").where("restored_sha256 <> own").count() == 0
    usable = spark.read.parquet(f"{sf}/embeddings.parquet").where("embedding is not null").count()
    assert whiten.op13_whitening(spark, sf).count() == 32 * usable
