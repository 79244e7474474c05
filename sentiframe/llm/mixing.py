"""Mixing sources to target weights with a multivariate-hypergeometric tree.

1. Targets: sources share all words by weight; a target stops at ``most``
   times its source's size and the excess is shared again by weight.
2. Blocks: a source's units (documents) fall by hash into blocks of about
   ``units_per_block``; the block number is the block's place in a random
   permutation of the source.  Whole passes over the source and then a prefix
   of the permutation make up the target; in the block where the prefix ends
   documents are chosen, largest first, as long as they fit, and one more if
   that comes nearer.  That gives each
   source an exact quota of block draws.
3. Splitting tree: a node holds the quotas of a run of output shards and how
   many draws it gets.  Its left half takes a multivariate-hypergeometric
   share of the quotas, its right half the rest, down to single shards, so
   shards are what dealing a random permutation of all draws would give,
   without a permutation of all draws.
4. A shard draws, from each source, the next draws of its permutation; draws
   of different shards are disjoint.  Within a shard documents are shuffled
   by a hash.

All of it is hashes, windows and joins, so reruns agree.  Windows run over
blocks (two levels, so no window holds more than a super-block of
``SUPER`` blocks or one row per super-block) and over sources and shards,
never over documents.

Defined results: sizes count the runs of characters other than x20 and
x09-x0D; a null or empty text has size 0 and counts as taken with 0 words; a
null source is a source of its own, last in order; rows that agree in source,
id and size are one unit and are taken together; a null id is an id.  An empty
table gives an empty mix.  Extra columns are carried by ``mix`` alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, unit, written

SUPER = 1024
#: Words of one output shard (some 100 MB of text) and fewest shards.
SHARD_WORDS, LEAST_SHARDS = 1 << 24, 64
#: Levels of the splitting tree that one task computes before nodes are dealt anew.
TREE_LEVELS = 6
#: Half-width, in standard deviations, of the range in which a draw is
#: inverted; the mass beyond it is below the resolution of a double.
SIGMAS = 12.0


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every row."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, s, source_size, n_units, target): s is the source's place by
    code point, null last.  The target is min(most * size, level * weight) for
    the one level at which targets add up to all words: with sources in order
    of cap per weight, the first k are capped for the smallest k whose level
    does not exceed the next cap per weight."""
    by_place = Window.orderBy(F.col("source").asc_nulls_last())
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_units"))
    place = totals.withColumn("s", F.row_number().over(by_place) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    capped = (place.withColumn("w", F.get(cycle, F.col("s") % len(weights)))
              .withColumn("cap", F.col("source_size").cast("double") * most)
              .withColumn("edge", F.col("cap") / F.col("w")))
    order = Window.orderBy("edge", "s")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = (F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    level = capped.withColumn("level", left / weight).withColumn(
        "level", F.min(F.when(F.col("level") <= F.col("edge"), F.struct("edge", "s", "level"))).over(every)["level"])
    return level.select("source", "s", "source_size", "n_units",
                        F.when(F.col("level").isNull(), F.col("cap")).otherwise(
                            F.least("cap", F.col("level") * F.col("w"))).alias("target"))


def hypergeometric(good: Column, draws: Column, total: Column, u: Column) -> Column:
    """Number of ``good`` items among ``draws`` taken from ``total`` (doubles
    holding whole numbers), by inversion of ``u`` in [0, 1)."""
    mean = draws * good / total
    spread = F.sqrt(mean * (1 - good / total) * (total - draws) / F.greatest(total - 1, F.lit(1.0)))
    low = F.greatest(F.lit(0.0), good + draws - total, F.floor(mean - SIGMAS * spread - 1).cast("double"))
    high = F.least(good, draws, F.ceil(mean + SIGMAS * spread + 1).cast("double"))

    def following(weight: Column, x: Column) -> Column:
        """Probability of x + 1 from that of x, up to one common factor."""
        return weight * (good - x) * (draws - x) / ((x + 1) * (total - good - draws + x + 1))

    steps = F.sequence(low.cast("long"), high.cast("long"))
    mass = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum")),
        lambda a, x: F.struct(following(a["weight"], x.cast("double")).alias("weight"), (a["sum"] + a["weight"]).alias("sum")),
        lambda a: a["sum"])
    found = F.aggregate(
        steps, F.struct(F.lit(1.0).alias("weight"), F.lit(0.0).alias("sum"), mass.alias("mass"), low.alias("at")),
        lambda a, x: F.struct(
            following(a["weight"], x.cast("double")).alias("weight"), (a["sum"] + a["weight"]).alias("sum"), a["mass"].alias("mass"),
            F.when(a["sum"] <= u * a["mass"], x.cast("double")).otherwise(a["at"]).alias("at")),
        lambda a: a["at"])
    return F.when((total <= 0) | (draws <= 0) | (good <= 0), F.lit(0.0)).otherwise(found)


def _left_share(quotas: Column, draws: Column, seed: Column) -> Column:
    """Multivariate-hypergeometric share of ``quotas`` (array of doubles) for
    ``draws`` draws: one draw after the other source, out of what is left."""
    total = F.aggregate(quotas, F.lit(0.0), lambda a, x: a + x)
    start = F.struct(draws.alias("draws"), total.alias("total"), F.array().cast("array<double>").alias("taken"))

    def step(a: Column, q: Column) -> Column:
        x = hypergeometric(q, a["draws"], a["total"], unit(F.xxhash64(seed, F.size(a["taken"]))))
        # the draw is made once, as the only element of an array
        return F.get(F.transform(F.array(x), lambda d: F.struct(
            (a["draws"] - d).alias("draws"), (a["total"] - q).alias("total"),
            F.concat(a["taken"], F.array(d)).alias("taken"))), F.lit(0))

    return F.aggregate(quotas, start, step, lambda a: a["taken"])


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(shard, s, first, last): places, from ``first`` up to but not including
    ``last``, of source s's draws that go to a shard.  ``quotas``: (s, quota).
    """
    root = quotas.agg(F.array_sort(F.collect_list(F.struct("s", "quota"))).alias("q")).select(
        F.lit(0).alias("low"), F.lit(n_shards).alias("high"),
        F.transform("q", lambda x: x["s"]).alias("sources"), F.transform("q", lambda x: x["quota"].cast("double")).alias("q"))
    nodes = root
    for level in range((n_shards - 1).bit_length()):
        if level and level % TREE_LEVELS == 0:
            nodes = nodes.repartition("low")
        wide = F.col("high") - F.col("low")
        middle = F.col("low") + F.ceil(wide / 2).cast("int")
        total = F.aggregate("q", F.lit(0.0), lambda a, x: a + x)
        draws = F.round(total * (F.col("middle") - F.col("low")) / wide)
        nodes = (nodes.withColumn("middle", middle)
                 .withColumn("left", F.when(wide < 2, F.col("q")).otherwise(
                     _left_share(F.col("q"), draws, F.xxhash64(F.lit(seed), "low", "high"))))
                 .select("sources", F.explode(F.when(wide < 2, F.array(F.struct("low", "high", "q"))).otherwise(F.array(
                     F.struct("low", F.col("middle").alias("high"), F.col("left").alias("q")),
                     F.struct(F.col("middle").alias("low"), "high",
                              F.zip_with("q", "left", lambda x, y: x - y).alias("q"))))).alias("n"))
                 .select("sources", "n.low", "n.high", "n.q"))
    leaves = nodes.select(F.col("low").alias("shard"), F.explode(F.arrays_zip("sources", "q")).alias("x")).select(
        "shard", F.col("x.sources").alias("s"), F.col("x.q").cast("long").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("s").orderBy("shard"))
    return leaves.select("shard", "s", (upto - F.col("n")).alias("first"), upto.alias("last"))


def shards_for(words: float | None) -> int:
    """Number of output shards for so many words."""
    return max(LEAST_SHARDS, math.ceil((words or 0) / SHARD_WORDS))


def plan(sized: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: float = 3.0, n_shards: int | None = None,
         units_per_block: int = 64, seed: int = 17) -> DataFrame:
    """(doc_id, source, size, source_size, target, shards) of every row of
    ``sized``: one shard number for each time the document is taken.  The
    number of shards follows the words to take unless it is given."""
    source = written(source_targets(sized, weights, most), "targets")
    n_shards = n_shards or shards_for(source.agg(F.sum("target")).head()[0])
    words = F.round("target").cast("long")
    source = source.select(
        "source", "s", "source_size", "target",
        F.ceil(F.col("n_units") / units_per_block).cast("long").alias("n_blocks"),
        F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("source_size") > 0, words % F.col("source_size")).otherwise(0).alias("rest"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    facts = source.select(F.col("source").alias("_source"), "s", "n_blocks")
    block = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.col("n_blocks"))
    placed = written(sized.join(facts, same).select("doc_id", "s", "size", block.alias("block")), "placed")
    units = placed.groupBy("s", "block", "doc_id", "size").agg(F.count(F.lit(1)).alias("n"))

    # words before each block, in two levels
    blocks = (placed.groupBy("s", "block").agg(F.sum("size").alias("words"))
              .withColumn("super", F.floor(F.col("block") / SUPER)))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    supers = blocks.groupBy("s", "super").agg(F.sum("words").alias("words")).select(
        "s", "super", F.coalesce(F.sum("words").over(before(Window.partitionBy("s").orderBy("super"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("words").over(before(Window.partitionBy("s", "super").orderBy("block"))), F.lit(0))
    ranked = blocks.withColumn("inside", inside).join(supers, ["s", "super"]).select(
        "s", "block", "words", (F.col("inside") + F.col("base")).alias("upto"))
    # the block in which the rest ends; blocks before it are taken whole
    ends = (ranked.join(source.select("s", "rest"), "s")
            .where((F.col("upto") < F.col("rest")) & (F.col("rest") <= F.col("upto") + F.col("words")))
            .select("s", F.col("block").alias("end"), (F.col("rest") - F.col("upto")).alias("room")))
    quotas = written(source.join(ends, "s", "left").select(
        "s", "source", "source_size", "target", "n_blocks", "passes", F.coalesce("end", F.lit(-1)).alias("end"),
        F.coalesce("room", F.lit(0)).alias("room"),
        (F.col("passes") * F.col("n_blocks") + F.coalesce(F.col("end") + 1, F.lit(0))).alias("quota")), "quotas")

    # documents of the last block, largest first, as long as they fit, then the smallest other if nearer
    last = units.join(quotas.select("s", "end", "room"), "s").where(F.col("block") == F.col("end"))
    listed = last.groupBy("s", "room").agg(F.sort_array(F.collect_list(F.struct(
        (F.col("size") * F.col("n")).alias("words"), F.xxhash64(F.lit(seed), "doc_id").alias("h"), "doc_id", "size")), False).alias("units"))
    def fit(a: Column, x: Column) -> Column:
        fits = x["words"] <= a["room"]
        return F.struct((a["room"] - F.when(fits, x["words"]).otherwise(0)).alias("room"),
                        F.when(fits, a["skipped"]).otherwise(x["words"]).alias("skipped"),
                        F.when(fits, a["at"]).otherwise(F.size(a["fits"])).alias("at"),
                        F.concat(a["fits"], F.array(fits)).alias("fits"))

    def nearest(a: Column) -> Column:
        """The smallest document left out comes in if that is nearer."""
        more = (a["at"] >= 0) & (a["skipped"] - a["room"] < a["room"])
        return F.transform(a["fits"], lambda f, i: f | (more & (i == a["at"])))

    start = F.struct("room", F.lit(0).cast("long").alias("skipped"), F.lit(-1).alias("at"),
                     F.array().cast("array<boolean>").alias("fits"))
    fold = F.aggregate("units", start, fit, nearest)
    fitting = (listed.select("s", F.explode(F.arrays_zip(F.col("units"), fold.alias("fits"))).alias("x"))
               .where("x.fits").select("s", F.col("x.units.doc_id").alias("_id"), F.col("x.units.size").alias("_size"), F.lit(True).alias("fits")))

    # draws of blocks by shard: place p is block p mod n_blocks of pass p div n_blocks
    shards = split_quotas(quotas.select("s", "quota"), n_shards, seed).where(F.col("last") > F.col("first"))
    draws = (shards.select("shard", "s", F.explode(F.sequence("first", F.col("last") - 1)).alias("place"))
             .join(quotas.select("s", "n_blocks", "passes", "end"), "s")
             .select("s", (F.col("place") % F.col("n_blocks")).alias("block"), "shard", "end", "passes",
                     F.floor(F.col("place") / F.col("n_blocks")).alias("pass")))
    partial = (F.col("block") == F.col("end")) & (F.col("pass") == F.col("passes"))
    taken = draws.groupBy("s", "block").agg(
        F.sort_array(F.collect_list(F.when(~partial, F.struct("pass", "shard")))).alias("whole"),
        F.max(F.when(partial, F.col("shard"))).alias("part"))
    taken = written(taken.select("s", "block", F.transform("whole", lambda x: x["shard"]).alias("whole"), "part"), "draws")

    picked = (placed.join(taken, ["s", "block"], "left")
              .join(fitting.withColumnRenamed("s", "_s"),
                    (F.col("s") == F.col("_s")) & F.col("part").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_id"))
                    & (F.col("size") == F.col("_size")), "left")
              .select("doc_id", "s", "size", F.concat(
                  F.coalesce("whole", F.array().cast("array<int>")),
                  F.when(F.col("fits"), F.array("part")).otherwise(F.array().cast("array<int>"))).alias("shards")))
    return picked.join(quotas.select("s", "source", "source_size", "target"), "s").select(
        "doc_id", "source", "size", "source_size", "target", "shards")


def mix(docs: DataFrame, seed: int = 17, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, repeated as often as they are
    taken, one partition per shard, shuffled within it.  All columns of
    ``docs`` are kept and none is added."""
    planned = written(plan(written(sizes(docs), "sizes"), seed=seed, **options)
                      .select("doc_id", "source", "size", "shards").distinct(), "mix")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    # the whole row is one column, so that its names meet no other
    keyed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("from"), size.alias("words"))
    copies = keyed.join(planned, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("source").eqNullSafe(F.col("from"))
                        & (F.col("words") == F.col("size"))).select("row", "id", F.posexplode("shards").alias("copy", "shard"))
    shards = planned.agg(F.max(F.array_max("shards"))).head()[0]
    return (copies.repartitionById((shards or 0) + 1, F.col("shard"))
            .sortWithinPartitions("shard", F.xxhash64(F.lit(seed), "shard", "id", "copy"))
            .select("row.*"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    planned = plan(written(sizes(docs), "sizes"))
    return planned.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.size("shards")).alias("taken"), "shards")
