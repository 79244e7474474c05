"""SimHash near-dedup by a self-join of a binary trie.

Fingerprints are computed per document and reduced to distinct values, so a
group of copies is one entry.  The distinct values form a binary trie.  Its
join visits pairs of nodes of the same depth together, adds a differing bit
when it goes down different sides, and leaves a pair as soon as the Hamming
budget is exceeded.  The top levels are spread by Spark: subtrees under a
prefix of ``prefix_bits`` are paired with those whose prefix differs in no
more bits than the budget, and each pair is one group; a pair with too many
values is spread again over deeper levels.  Within a group the
traversal goes level by level over arrays of node ranges, depth first in
bounded slices.  A group returns a spanning forest of its links rather than
all of them, so a dense cluster costs no more rows than it has members;
components over all groups come from alternating star steps on written
tables.

Defined results: a null or empty text, or one of blanks only, has the
fingerprint zero and links like any other; fewer words than the shingle
length make one shingle of them all; a bit is 1 only if more than half the
shingle hashes have it.  Repeated rows are kept.  A null id takes part, but a
component is named by the smallest id that is not null (null if none is).
Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SEED = 42
LANES = np.uint64(0x0101010101010101)
#: Node pairs that are looked at together.
NODE_PAIRS = 200_000
#: A pair of subtrees that holds more than so many times the usual values goes further down.
CROWDED = 8
#: Node pairs with so few entry pairs are compared entry by entry.
LEAF = 32


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), np.uint64)
    # bit k of all eight bytes at once: 255 hashes add up in byte lanes without a carry
    ones = np.empty((8, 8), np.int64)
    starts = np.arange(0, len(hashes), 255)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, starts)
        ones[:, k] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = (2 * ones.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def text_hash() -> Column:
    """128 bits of the text; null for a null text."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def fingerprints(docs: DataFrame, shingle: int = 3, hashed: bool = False) -> DataFrame:
    """(doc_id, fp) with the 64 bits in a signed long, and text_hash if asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", *batch.schema.names[2:]])

    extra = [text_hash().alias("text_hash")] if hashed else []
    return docs.select("doc_id", "text", *extra).mapInArrow(
        run, "doc_id long, fp long" + (", text_hash binary" if hashed else ""))


class Forest:
    """Union by smaller index over arrays of links."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def _roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self._roots(a), self._roots(b)
            go = a != b
            a, b = a[go], b[go]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            self.parent = self.parent[self.parent]


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Where the 1 side begins in node ranges of sorted ``values``."""
    below = np.uint64(63) - depth
    first = values[low]
    edge = ((first >> below) | np.uint64(1)) << below
    return np.clip(np.searchsorted(values, edge), low, high)


def trie_links(values: np.ndarray, other: np.ndarray | None, depth: int, budget: int) -> np.ndarray:
    """Parents of a spanning forest of the links within ``values`` (sorted,
    distinct), or between ``values`` and ``other`` when given; indexes run over
    values, then other."""
    right = values if other is None else other
    base = 0 if other is None else len(values)
    forest = Forest(base + len(right))
    if not len(values) or not len(right):
        return forest.parent
    err = 0
    if other is not None:  # the bits in which the two prefixes differ
        err = int(np.bitwise_count((values[0] ^ right[0]) >> np.uint64(64 - depth))) if depth else 0
        if err > budget:
            return forest.parent
    start = np.array([[0, len(values), 0, len(right), err, depth]], np.int64)
    stack = [start]
    while stack:
        node = stack.pop()
        if len(node) > NODE_PAIRS:
            half = len(node) // 2
            stack += [node[:half], node[half:]]
            continue
        a0, a1, b0, b1, e, d = node.T
        pairs = (a1 - a0) * (b1 - b0)
        leaf = (pairs <= LEAF) | (d >= 64)
        if leaf.any():
            x = node[leaf]
            count = pairs[leaf]
            which = np.repeat(np.arange(len(x)), count)
            k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            width = (x[:, 3] - x[:, 2])[which]
            i, j = x[which, 0] + k // width, x[which, 2] + k % width
            if other is None:
                i, j = i[i < j], j[i < j]
            near = np.bitwise_count(values[i] ^ right[j]) <= budget
            forest.link(i[near], base + j[near])
            node = node[~leaf]
            a0, a1, b0, b1, e, d = node.T
        if not len(node):
            continue
        du = d.astype(np.uint64)
        am, bm = _split(values, a0, a1, du), _split(right, b0, b1, du)
        same = (a0 == b0) if other is None else np.zeros(len(node), bool)
        children = [(a0, am, b0, bm, e, None), (am, a1, bm, b1, e, None), (a0, am, bm, b1, e + 1, None),
                    (am, a1, b0, bm, e + 1, ~same)]  # of a node and itself, the two sides meet once
        parts = []
        for x0, x1, y0, y1, err_, also in children:
            go = (x1 > x0) & (y1 > y0) & (err_ <= budget)
            if also is not None:
                go &= also
            parts.append(np.stack([x0[go], x1[go], y0[go], y1[go], err_[go], d[go] + 1], axis=1))
        if len(node := np.concatenate(parts)):
            stack.append(node)
    return forest.parent


def prefix_bits(n: int, subtree: int) -> int:
    """Depth at which a subtree of ``n`` values holds about ``subtree``."""
    return min(24, max(0, math.ceil(math.log2(max(1, n) / subtree))))


def _place(nodes: DataFrame, depth: int, bits: int, budget: int) -> DataFrame:
    """``nodes`` (fp, lo, hi, second, ..), values in pairs of nodes at
    ``depth``, in the pairs of nodes ``bits`` levels below: a value goes to the
    pair of its own prefix with every prefix on the other side that keeps the
    differing bits within the budget.  A pair of a node with itself has lo = hi
    and one side."""
    below = F.shiftrightunsigned("fp", 64 - depth - bits) if depth + bits else F.lit(0).cast("long")
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("e")) for m in _masks(bits, budget)])
    left = F.lit(budget) - F.bit_count(F.col("lo").bitwiseXOR(F.col("hi")))
    rest = [c for c in nodes.columns if c not in ("fp", "lo", "hi", "second")]
    to = nodes.withColumn("own", below).withColumn("mask", F.explode(F.filter(masks, lambda x: x["e"] <= left)))
    other = F.shiftleft(F.when(F.col("second"), F.col("lo")).otherwise(F.col("hi")), bits).bitwiseOR(
        F.col("own").bitwiseXOR(F.col("mask.m")).bitwiseAND(F.lit((1 << bits) - 1)))
    to = to.withColumn("other", other).withColumn(
        "second", F.when(F.col("lo") == F.col("hi"), F.col("own") > F.col("other")).otherwise(F.col("second")))
    return to.select("fp", F.when(F.col("second"), F.col("other")).otherwise(F.col("own")).alias("lo"),
                     F.when(F.col("second"), F.col("own")).otherwise(F.col("other")).alias("hi"), "second", *rest)


def _join_pairs(placed: DataFrame, depth: int, budget: int) -> DataFrame:
    """Spanning links (a, b) of each pair of nodes at ``depth``."""
    def join(key, table):
        fp = table.column("fp").to_numpy().view(np.uint64)
        second = table.column("second").to_numpy(zero_copy_only=False)
        values, other = np.sort(fp[~second]), None
        if key[0].as_py() != key[1].as_py():
            other = np.sort(fp[second])
        parent = trie_links(values, other, depth, budget)
        every = values if other is None else np.concatenate((values, other))
        moved = np.flatnonzero(parent != np.arange(len(parent)))
        a, b = every[moved].view(np.int64), every[parent[moved]].view(np.int64)
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return placed.groupBy("lo", "hi").applyInArrow(join, "a long, b long")


def trie_self_join(distinct: DataFrame, budget: int = 2, subtree: int = 1 << 13, step: int = 6) -> DataFrame:
    """(a, b) spanning links, a > b, between distinct values of ``fp`` that
    differ in at most ``budget`` bits.

    Pairs of nodes are first cut at the depth where evenly spread values would
    make subtrees of ``subtree``.  A pair that holds more than ``CROWDED``
    times that (templated texts share leading bits) goes ``step`` levels
    further down, with the bits it has spent, until it is no larger; so a
    group's size is bounded whatever the values are."""
    nodes = distinct.select("fp", F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), F.lit(False).alias("second"))
    depth, bits, links = 0, prefix_bits(distinct.count(), subtree), None
    while True:
        placed, down = _place(nodes, depth, bits, budget), depth + bits
        # sizes come from one row per node and side, not from every value
        node = F.shiftrightunsigned("fp", 64 - down) if down else F.lit(0)
        counted = nodes.groupBy("lo", "hi", "second", node.alias("node")).agg(F.min("fp").alias("fp"), F.count(F.lit(1)).alias("n")).drop("node")
        sizes = _place(counted, depth, bits, budget).groupBy("lo", "hi").agg(
            F.sum("n").alias("n"), F.max("second").alias("right"), F.min("second").alias("left"))
        both = (F.col("lo") == F.col("hi")) | (F.col("right") & ~F.col("left"))
        crowded = written(sizes.where(F.col("n") > CROWDED * subtree).select("lo", "hi", both.alias("both")), "crowded")
        some = down < 64 and not crowded.isEmpty()
        part = _join_pairs(placed.join(crowded, ["lo", "hi"], "left_anti") if some else placed, down, budget)
        links = part if links is None else links.union(part)
        if not some:
            return links
        # a pair with one empty side has no links
        nodes = written(placed.join(crowded.where("both").drop("both"), ["lo", "hi"]).select("fp", "lo", "hi", "second"), "nodes")
        depth, bits = down, min(step, 64 - down)


def _masks(depth: int, budget: int) -> list[int]:
    """Numbers of ``depth`` bits with at most ``budget`` ones."""
    out = {0}
    for _ in range(budget):
        out |= {m | (1 << i) for m in out for i in range(depth)}
    return sorted(out)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by
    alternating star steps.  A large star gives every larger neighbour of a
    node its smallest one, a small star does so for the smaller neighbours;
    the table of links ends as one star per component."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = edges  # a > b: neighbours that are smaller
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        back = near.join(least, "a")
        if large:
            out = back.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = (back.where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                   .union(least.select("a", F.col("m").alias("b"))))
        return out.where(F.col("a") != F.col("b")).distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head())

    edges = written(links.distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = written(star(star(edges, True), False), "links")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 2, subtree: int = 1 << 13,
                    hashed: bool = False) -> DataFrame:
    """(doc_id, fp, root, component_id, group_size) of every row of ``docs``,
    and text_hash if asked for; root is the fingerprint that tells a group from
    all others, also where the groups' ids are equal or null."""
    prints = written(fingerprints(docs, shingle, hashed), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct")
    linked = components(trie_self_join(distinct.select("fp"), budget, subtree))
    rooted = (distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", F.coalesce("root", "fp").alias("root"), "first_id", "n"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("n").alias("group_size"))
    classes = written(rooted.select("fp", "root").join(named, "root").select("fp", "root", "component_id", "group_size"), "classes")
    return prints.join(classes, "fp").select(*prints.columns, "root", "component_id", "group_size")


def keep_one(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """One row of each group: that of the smallest id, rows without an id last;
    among rows of one id, that of the smallest text hash; among rows of one id
    and text, that of the smallest hash of the other columns."""
    groups = near_duplicates(docs, shingle, budget, hashed=True)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]) & text_hash().eqNullSafe(kept["kept_hash"]), "left_semi")
    rest = [x for c in docs.columns if c not in ("doc_id", "text") for x in (F.col(c).isNull(), F.col(c))]
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(F.lit(0), *rest)).alias("one")
    return rows.groupBy("doc_id", text_hash().alias("text_hash")).agg(one).select("one.*")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id", "group_size")
