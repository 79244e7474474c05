"""Line dedup and SimHash against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sentiframe.llm import line_runs, simhash_trie
from tests.llm import fixtures

BLANKS = " \t\n\x0b\x0c\r"
ASCII_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def key_of(line):
    return line.strip(BLANKS).translate(ASCII_LOWER)


def expected_lines(rows):
    last = 2**63
    owner = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            k = key_of(line)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, last), last if i is None else i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 10 or owner[key_of(x)] == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n_batches,fanout", [(1, 2), (5, 2), (7, 3)])
def test_line_dedup_equals_brute_force(spark, n_batches, fanout):
    got = line_runs.line_dedup(fixtures.documents(spark), n_batches=n_batches, fanout=fanout, keep=("source",)).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got), key=str) == expected_lines(fixtures.rows())


def test_line_dedup_carries_columns_of_any_name(spark):
    names = ("lines", "id", "row", "dropped", "carried", "source")
    docs = fixtures.documents(spark).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    out = line_runs.line_dedup(docs, keep=names)
    assert out.columns == ["doc_id", *names, "n_lines", "n_dropped", "text"]
    plain = line_runs.line_dedup(fixtures.documents(spark))
    assert sorted(map(str, out.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert all(r[c] == f"{c}{r['doc_id']}" for r in out.where("doc_id is not null").collect() for c in names)
    with pytest.raises(ValueError):
        line_runs.line_dedup(docs, keep=("n_lines",))


def test_line_dedup_of_empty_table(spark):
    assert line_runs.line_dedup(fixtures.documents(spark).limit(0)).count() == 0


def test_levels_compact(spark):
    runs = line_runs.LineRuns(fanout=2)
    lines = line_runs.line_hashes(fixtures.documents(spark), 10)
    for low in range(0, 60, 15):
        runs.add(lines.where((lines.id >= low) & (lines.id < low + 15)))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    owners = runs.owners()
    assert owners.count() == owners.select("h1", "h2").distinct().count()


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for x in shingles:
        h = xxhash.xxh64(x, seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(values, budget):
    label = np.arange(len(values))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    while True:
        new = np.array([label[near[i]].min() for i in range(len(values))])
        if (new == label).all():
            return label
        label = new


def test_simhash_equals_brute_force(spark):
    rows = fixtures.rows()
    got = simhash_trie.near_duplicates(fixtures.documents(spark)).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64) for r in got) == sorted((str(r[0]), f) for r, f in zip(rows, prints, strict=True))
    label = brute_components(np.array(prints, np.uint64), 2)
    for r in got:
        of = next(i for i, f in enumerate(prints) if f == r["fp"] % 2**64)
        members = [rows[i][0] for i in range(len(rows)) if label[i] == label[of]]
        assert r["component_id"] == min((m for m in members if m is not None), default=None)
        assert r["group_size"] == len(members)


def test_simhash_of_empty_table_and_keep_one(spark):
    docs = fixtures.documents(spark)
    assert simhash_trie.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash_trie.keep_one(docs).select("doc_id").collect()
    ids = [r[0] for r in kept]
    assert len(ids) == len(set(ids))
    named = {r["component_id"] for r in simhash_trie.near_duplicates(docs).collect()}
    assert set(ids) == named


def test_keep_one_keeps_a_row_of_every_group(spark):
    """Null ids, and one id on unlike texts, stand in groups of their own."""
    unlike = [f"{w} alone in a text of its own, about {w} and no more than {w}" for w in ("stone", "river", "paper", "light")]
    rows = [(None, unlike[0], "a"), (None, unlike[1], "a"), (7, unlike[2], "a"), (7, unlike[3], "a"),
            (None, unlike[2], "a"), (None, unlike[1], "a"), (8, unlike[3], "a"), (7, unlike[3], None), (9, None, "a"), (9, "", "a")]
    want = None
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3)
        got = sorted(map(tuple, simhash_trie.keep_one(docs).collect()), key=str)
        assert sorted((r[:2] for r in got), key=str) == sorted(
            [(None, unlike[0]), (None, unlike[1]), (7, unlike[2]), (7, unlike[3]), (9, None)], key=str)
        assert want in (None, got)
        want = got


@pytest.mark.parametrize("n", [1, 3, 60])
@pytest.mark.parametrize("depth", [0, 3])
def test_trie_links_in_subtrees(n, depth):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, size=n, dtype=np.uint64) * np.uint64(2)
    flips = [base ^ (np.uint64(1) << rng.integers(0, 64, size=n).astype(np.uint64)) for _ in range(4)]
    values = np.unique(np.concatenate([base, *flips, flips[0] ^ np.uint64(1)]))
    forest = simhash_trie.Forest(len(values))
    own = values >> np.uint64(64 - depth) if depth else np.zeros(len(values), np.uint64)
    for mask in simhash_trie._masks(depth, 2):
        for lo in range(1 << depth):
            hi = lo ^ mask
            if hi < lo:
                continue
            a, b = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
            parent = simhash_trie.trie_links(values[a], None if lo == hi else values[b], depth, 2)
            at = a if lo == hi else np.concatenate((a, b))
            forest.link(at[np.arange(len(parent))], at[parent])
    assert (forest._roots(np.arange(len(values))) == brute_components(values, 2)).all()


def test_dense_group_gives_a_forest():
    one = np.uint64(1)
    near = [one << np.uint64(i) | one << np.uint64(j) for i in range(64) for j in range(64)]
    parent = simhash_trie.trie_links(np.unique(np.array(near, np.uint64)), None, 0, 2)
    assert (parent != np.arange(len(parent))).sum() == len(parent) - 1


def test_components_of_chain_and_star(spark):
    chain = [(i, i - 1) for i in range(1, 40)] + [(200 + i, 200) for i in range(1, 30)] + [(500, 499)]
    got = {r["node"]: r["root"] for r in simhash_trie.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 40)}, **{200 + i: 200 for i in range(1, 30)}, 500: 499}


def test_digests(spark, tmp_path):
    fixtures.documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["kept_sha256"]) for r in line_runs.op9_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, _, _, t in expected_lines(fixtures.rows())}
    prints = {(r["doc_id"], r["fingerprint"]) for r in simhash_trie.op10_simhash(spark, str(tmp_path)).collect()}
    assert prints == {(i, f"{brute_fingerprint(t):016x}") for i, t, *_ in fixtures.rows()}


def test_crowded_prefixes_go_deeper(spark, monkeypatch):
    """Templated values, which share most leading bits, make no large group and lose no link."""
    rng = np.random.default_rng(5)
    spread = rng.integers(0, 1 << 63, 300, dtype=np.uint64) << np.uint64(1)
    shared = (np.uint64(0xF5A3) << np.uint64(48)) | rng.integers(0, 1 << 14, 1500, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)
    values = np.unique(np.concatenate((spread, shared, rng.choice(np.concatenate((spread, shared)), 400) ^ flips)))
    largest, joined = [], simhash_trie._join_pairs

    def watched(placed, depth, budget):
        largest.append((depth, placed.groupBy("lo", "hi").count().agg(F.max("count")).head()[0]))
        return joined(placed, depth, budget)

    monkeypatch.setattr(simhash_trie, "_join_pairs", watched)
    distinct = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash_trie.trie_self_join(distinct, 2, subtree=16)
    got = {r["node"]: r["root"] for r in simhash_trie.components(links).collect()}
    assert len(largest) > 2 and all(n <= simhash_trie.CROWDED * 16 for _, n in largest)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    label = np.arange(len(values))
    while True:  # the smallest label among neighbours, until nothing changes
        now = np.array([label[row].min() for row in near])
        if (now == label).all():
            break
        label = now
    groups = {}
    for v, at in zip(values.view(np.int64).tolist(), label.tolist(), strict=True):
        groups.setdefault(at, []).append(v)
    assert {v: min(g) for g in groups.values() if len(g) > 1 for v in g} == {a: b for a, b in got.items()} | {
        b: b for b in got.values()}
