"""Fill-in-middle transformation, cut with a Fenwick tree over text blocks.

A text is cut after two numbers of units, where a unit is a word with the
blanks before it, or the blanks at the end.  Its UTF-8 bytes are taken in
blocks of ``BLOCK`` bytes; a Fenwick tree holds how many units end in each
block and how many code points begin there.  A binary-lifting descent finds
the block that holds the last unit before a cut, with the units and code
points of all blocks before it; only that block is then looked at byte by
byte.  Units end before a blank byte or at the end of the text, never inside
a code point, so the parts are cut as bytes.

The order of the parts is drawn from a hash of the document's id, so reruns
agree.  ``restore`` finds the three markers, which no cut text contains, and
gives the exact text back.

Defined results: a null text is an empty one, and empty texts are plain; so
are texts that hold a marker.  A null id is hashed as the empty string.  Rows
are independent of each other, so repeated rows and ids are kept as they are;
an empty table gives none.  Columns to keep are named by the caller and may
have any name but those of the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: FIXED VALUES: the markers before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 4096
#: Rows of a result batch together hold about so many bytes of text.
BATCH_BYTES = 4_000_000
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Fenwick:
    """Prefix sums of two counts per block: units that end in it, and code
    points that begin in it."""

    def __init__(self, units: np.ndarray, points: np.ndarray):
        n = len(units)
        self.n = n
        sums = np.zeros((2, n + 1), np.int64)
        np.cumsum(units, out=sums[0, 1:])
        np.cumsum(points, out=sums[1, 1:])
        at = np.arange(1, n + 1)
        low = at & -at
        self.tree = np.zeros((n + 1, 2), np.int64)
        self.tree[1:] = (sums[:, at] - sums[:, at - low]).T
        self.top = 1 << n.bit_length() >> 1 if n else 0

    def find(self, k: int) -> tuple[int, int, int]:
        """(block of the k-th unit's end, units and code points of all blocks
        before it), for k from 1 up to the number of units."""
        at, units, points, step = 0, 0, 0, self.top
        while step:
            to = at + step
            if to <= self.n and units + self.tree[to, 0] < k:
                at = to
                units += int(self.tree[to, 0])
                points += int(self.tree[to, 1])
            step >>= 1
        return at, units, points


class Blocks:
    """A text's bytes with the places where units end."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        blank = IS_BLANK[self.data]
        self.ends = np.empty(len(blank), bool)  # a unit ends with this byte
        if len(blank):
            self.ends[:-1] = ~blank[:-1] & blank[1:]
            self.ends[-1] = True
        starts = np.arange(0, len(blank), BLOCK)
        self.begins = (self.data & 0xC0) != 0x80  # a code point begins with this byte
        units, points = (np.add.reduceat(x, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
                         for x in (self.ends, self.begins))
        self.units = int(units.sum())
        self.tree = Fenwick(units, points)

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) at which the first k units end."""
        if k == 0:
            return 0, 0
        block, units, points = self.tree.find(k)
        a = block * BLOCK
        inside = int(np.flatnonzero(self.ends[a:a + BLOCK])[k - units - 1]) + 1
        return a + inside, points + int(self.begins[a:a + inside].sum())


def arrange(data: bytes, h: tuple[int, int, int, int], rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix and the middle, output) of one
    text by its four draws."""
    blocks = Blocks(data)
    n = blocks.units
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not data or any(m in data for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, data
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, a_points = blocks.cut(first)
    b, b_points = blocks.cut(second)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = marks
    form = "spm" if h[3] % 100 < spm else "psm"
    out = s + suffix + p + prefix + m + middle if form == "spm" else p + prefix + s + suffix + m + middle
    return n, form, a_points, b_points - a_points, out


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
              seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """(id, kept columns, n long, form, prefix_chars long, middle_chars long,
    output): every whole text in its form.  Of 100 texts about ``rate`` are
    cut, and of 100 cut ones about ``spm`` have the suffix first."""
    named = [F.col(id_col), *[F.col(c) for c in keep]]
    source = docs.select(*named, *draws(id_col, seed), F.coalesce(F.col(text_col), F.lit("")))
    width = len(named)
    source = source.toDF(*[f"c{i}" for i in range(width + 5)])  # names of their own: kept ones may be any
    fields = [docs.schema[c] for c in (id_col, *keep)]
    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)], T.StructField("n", T.LongType()),
                           T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
                           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def rows(batch: pa.RecordBatch, out: list[tuple], start: int) -> pa.RecordBatch:
        n, form, prefix, middle, text = zip(*out, strict=True)
        kept = [batch.column(i).slice(start, len(out)) for i in range(width)]
        texts = pa.array(text, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), texts],
            names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(width + 4).cast(pa.binary())
            h = np.stack([batch.column(width + i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1).tolist()
            out, start, size = [], 0, 0
            for i in range(batch.num_rows):
                data = texts[i].as_py()
                out.append(arrange(data, h[i], rate, spm))
                size += len(data)
                if size >= BATCH_BYTES:
                    yield rows(batch, out, start)
                    out, start, size = [], i + 1, 0
            if out:
                yield rows(batch, out, start)

    return source.mapInArrow(run, schema).toDF(id_col, *keep, *schema.names[width:])


def restore(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from.  Markers stand three characters
    before the part they name; the first of a kind is the one that was put
    there, as cut texts hold none."""
    out = F.col(output)
    p, s, m = (F.locate(x, out) for x in (PREFIX, SUFFIX, MIDDLE))
    part = lambda a, b: F.substring(out, a + 3, b - a - 3)
    last = F.substring(out, m + 3, F.char_length(out))
    return (F.when(F.col(form) == "psm", F.concat(part(p, s), last, part(s, m)))
            .when(F.col(form) == "spm", F.concat(part(p, m), last, part(s, p)))
            .otherwise(out))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return transform(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore().cast("binary"), 256).alias("restored_sha256"))


#: DuckDB: units are counted and cut by regular expressions on the whole text.
#: A cut after k units is where the k-th match ends.
OP12_SQL = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
u AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2,
         CAST('0x' || d[17:24] AS BIGINT) AS h3, CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM h),
c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p"""
