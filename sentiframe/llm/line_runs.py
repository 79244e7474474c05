"""Line dedup with levelled sorted runs of line hashes.

State is a set of runs: sorted tables (hash -> smallest document holding the
line), disjoint by hash, filed by level.  Documents arrive in batches of
ascending id.  A batch's lines are reduced to the first holder per hash,
merge-anti-joined with every run, and what is new becomes a run of level 0.
When a level holds ``fanout`` runs they are compacted into one run of the next
level, so a hash is rewritten once per level and there are only a few runs to
join, however many batches came before.  A line then goes from every document
but the holder that its run names.

Defined results: a line's key is the line stripped of x20 and x09-x0D with
A-Z lower-cased; keys under ``min_chars`` code points are never dropped.  A
null or empty text has one empty line.  Rows with the same id are one
document, and a null id is a document after all others; each such row loses
the lines that its id does not own.  Repeats inside the owner stay.  Only the
id and text columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, lower_ascii, written

LAST_ID = 2**63 - 1


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Runs of (h1, h2, owner) by level, each a table in the shared folder."""

    def __init__(self, fanout: int = 2):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, run: DataFrame) -> DataFrame:
        return written(run.sortWithinPartitions("h1", "h2"), "line-run")

    def add(self, lines: DataFrame) -> None:
        """Take in a batch's (h1, h2, id) lines; ids must not be below those
        of earlier batches."""
        new = lines.groupBy("h1", "h2").agg(F.min("id").alias("owner"))
        for run in self.runs():
            new = new.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti")
        self._file(self._write(new), 0)

    def _file(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.unionByName(other)
            self.levels[level] = []
            self._file(self._write(merged.repartition("h1", "h2")), level + 1)

    def owners(self) -> DataFrame:
        first, *rest = self.runs()
        for run in rest:
            first = first.unionByName(run)
        return first


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, pos, h1, h2) of every line whose key is long enough; 128 hash
    bits tell keys apart, ``row`` tells rows of one id apart by their text."""
    # the row's hash is taken before the lines are exploded
    lines = docs.select(
        F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("row"),
        F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "line"))
    return (lines.select("id", "row", "pos", line_key(F.col("line")).alias("key"))
            .where(F.char_length("key") >= min_chars)
            .select("id", "row", "pos", F.xxhash64("key").alias("h1"),
                    F.xxhash64(F.lit("line"), F.col("key")).alias("h2")))


def batch_bounds(lines: DataFrame, n_batches: int) -> list[int]:
    """Upper ids of all batches but the last, at quantiles of the lines' ids."""
    if n_batches < 2:
        return []
    at = [i / n_batches for i in range(1, n_batches)]
    found = lines.select(F.percentile_approx("id", at, 1000)).head()[0]
    return sorted(set(found or []))


def dropped_lines(docs: DataFrame, min_chars: int = 10, n_batches: int = 4, fanout: int = 2) -> DataFrame:
    """(id, row, dropped: array of line positions) of rows that lose lines."""
    lines = written(line_hashes(docs, min_chars), "lines")
    runs = LineRuns(fanout)
    low: int | None = None
    for high in [*batch_bounds(lines, n_batches), None]:
        batch = lines if low is None else lines.where(F.col("id") > low)
        runs.add(batch if high is None else batch.where(F.col("id") <= high))
        low = high
    lost = lines.join(runs.owners(), ["h1", "h2"]).where(F.col("owner") != F.col("id"))
    return written(lost.groupBy("id", "row").agg(F.collect_set("pos").alias("dropped")), "dropped")


def line_dedup(docs: DataFrame, min_chars: int = 10, n_batches: int = 4, fanout: int = 2,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, kept columns, n_lines, n_dropped, remaining text) of every row
    of ``docs``.  Kept columns may have any names but those of the result."""
    clash = {"doc_id", "n_lines", "n_dropped", "text"} & set(keep)
    if clash:
        raise ValueError(f"columns of the result cannot be kept from the input: {sorted(clash)}")
    docs = docs.select("doc_id", "text", *keep)
    drops = dropped_lines(docs, min_chars, n_batches, fanout)
    # carried columns are one struct, so that their names meet no other
    split = docs.select(F.struct("doc_id", *keep).alias("carried"), F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64("text").alias("row"),
                        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    both = split.join(drops, ["id", "row"], "left")
    n_lines = F.size("lines")
    # array_except hashes the dropped positions, so this is linear in the lines
    left = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("dropped"))
    kept = F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    out = both.select("carried", n_lines.cast("long").alias("n_lines"),
                      F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("text"))
    return out.select("carried.*", "n_lines", "n_dropped", "text")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
holders AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
flagged AS (
    SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND h.owner <> k.doc_id AS gone
    FROM keyed k LEFT JOIN holders h ON k.key = h.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (WHERE gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""
