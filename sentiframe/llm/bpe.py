"""Byte-level BPE encoding and decoding on padded numpy matrices.

Each text is cut into pieces by the tokenizer's pattern; the distinct pieces
of a chunk of texts are encoded together.  Pieces are bucketed by length and
laid out as the rows of a matrix of token ids.  In every round each row
merges its leftmost pair of minimum rank; finished rows leave the matrix and
the rest moves left over the merged column.  Pair ranks come from an
open-addressing hash table held in two numpy arrays.

Defined results: a null or empty text has no token; white space, control
characters and any other code point are ordinary input (byte level); special
tokens do not exist.  Rows are independent, so repeated rows and null ids
are kept as they are, and only the id and text columns are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks

NONE = np.int32(2**31 - 1)
#: Rows longer than this merge all non-overlapping pairs of one rank per round.
LONG_ROW = 512
#: Parts of texts up to this many characters are remembered within a partition, so many
#: at most: below 40 MB, as a part has 24 characters and so many ids at most 4 bytes each a byte.
CACHED_CHARS, CACHED_PIECES = 24, 100_000
BLANK_AFTER_SPACE = re.compile(r" (?:\s|\Z)")
CHUNK_CHARS = 500_000
CELLS = 500_000  # of a matrix


class PairTable:
    """(left id, right id) -> merged id, by linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(4 * max(1, len(left))))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        keys = self._key(left, right)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            first = np.unique(slot[todo[free]], return_index=True)[1]
            won = todo[free][first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], merged[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    @staticmethod
    def _key(left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids of pairs of any shape; NONE where there is none.
        Negative ids are padding."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.shape, NONE, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = self._key(left[at], right[at])
        slot = self._slot(keys)
        while len(at):
            seen = self.keys[slot]
            hit = seen == keys
            out[at[hit]] = self.values[slot[hit]]
            go = ~hit & (seen >= 0)
            at, keys, slot = at[go], keys[go], (slot[go] + 1) & self.mask
        return out.reshape(shape)


class Decoder:
    """Token bytes by id: three arrays, under 1 MB for 50,000 tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = sorted(ranks.items(), key=lambda x: x[1])
        size = by_id[-1][1] + 1 if by_id else 0
        self.lengths = np.zeros(size, np.int64)
        self.lengths[[r for _, r in by_id]] = [len(t) for t, _ in by_id]
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.blob = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)

    def decode(self, codes: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(b"".join(codes), "<u4").astype(np.int64)
        lengths = self.lengths[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(self.starts[ids] - ends[:-1], lengths) + np.arange(ends[-1])
        data = self.blob[at].tobytes()
        bounds = ends[np.concatenate(([0], np.cumsum([len(c) // 4 for c in codes])))]
        return [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Vocabulary(Decoder):
    """A decoder with the tables that encoding needs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__(ranks)
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.byte_ids = np.full(256, -1, np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            if len(token) == 1:
                self.byte_ids[token[0]] = rank
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.pairs = PairTable(*(np.array(x, np.int32) for x in (left, right, merged)))
        self.byte_pairs = self.pairs.ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))
        self.cache: dict[str, bytes] = {}
        self._long: list[str] = []

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > LONG_ROW:
                out[i] = self._merge_long(p)
            elif p:
                width = len(p) if len(p) <= 16 else -(-len(p) // 8) * 8
                buckets.setdefault(width, []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                for i, ids in zip(part, self._merge_rows([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes], width: int) -> list[bytes]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(len(pieces), width)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        padding = np.arange(width) >= sizes[:, None]
        ids = np.where(padding, np.int32(-1), self.byte_ids[raw])
        ranks = self.byte_pairs[raw[:, :-1].astype(np.int32) * 256 + raw[:, 1:]]
        ranks[padding[:, 1:]] = NONE
        done: list[bytes] = [b""] * len(pieces)
        rows = np.arange(len(pieces))

        def finish(which):
            flat = ids[which]
            for r, row, n in zip(rows[which], flat.astype("<u4"), (flat >= 0).sum(axis=1), strict=True):
                done[r] = row[:n].tobytes()

        while len(rows):
            if ranks.shape[1] == 0:
                finish(np.arange(len(rows)))
                break
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            live = best < NONE
            if not live.all():
                finish(np.flatnonzero(~live))
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            ids[every, at] = best
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), axis=1)
            cols = cols[:-1]
            if not len(cols):
                finish(every)
                break
            ranks = np.take_along_axis(ranks, cols + (cols >= at[:, None]), axis=1)
            for shift in (-1, 0):  # the two pairs that hold the merged token
                j = at + shift
                ok = np.flatnonzero((j >= 0) & (j < len(cols)))
                ranks[ok, j[ok]] = self.pairs.ranks(ids[ok, j[ok]], ids[ok, j[ok] + 1])
        return done

    def _merge_long(self, piece: bytes) -> bytes:
        """One long row.  All non-overlapping pairs of the minimum rank merge
        in one round, leftmost first, unless a merge would give a pair of a
        lower rank; then only the leftmost one does, as the rule has it."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.ranks(ids[:-1], ids[1:])
        while len(ranks):
            best = ranks.min()
            if best == NONE:
                break
            at = np.flatnonzero(ranks == best)
            run = np.concatenate(([True], np.diff(at) > 1))
            first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            for take in (at, at[:1]):
                new = ids.copy()
                new[take] = best
                keep = np.ones(len(ids), bool)
                keep[take + 1] = False
                new = new[keep]
                new_ranks = ranks[np.flatnonzero(keep)[:-1]]
                at_new = take - np.arange(len(take))
                touched = np.unique(np.concatenate((at_new - 1, at_new)))
                touched = touched[(touched >= 0) & (touched < len(new_ranks))]
                new_ranks[touched] = self.pairs.ranks(new[touched], new[touched + 1])
                if len(take) == 1 or not (new_ranks[touched] < best).any():
                    break
            ids, ranks = new, new_ranks
        return ids.astype("<u4").tobytes()

    def _units(self, text: str | None) -> list[str]:
        """Parts of a text that are encoded on their own.  No piece of the
        pattern runs over a space that precedes a visible character, so a text
        is cut at its spaces, of which each part but the first gets its own
        back; a text with blanks after a space is cut into pieces at once."""
        if not text:
            return []
        if BLANK_AFTER_SPACE.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]

    def _fill(self, units: list[str]) -> None:
        """Encode units that the cache lacks."""
        cut = [self.pattern.findall(u) for u in units]
        cache = self.cache
        order = list({p for pieces in cut for p in pieces if p not in cache})
        cache.update(zip(order, self.encode_pieces([p.encode() for p in order]), strict=True))
        self._long += [u for u in (*units, *order) if len(u) > CACHED_CHARS]
        for u, pieces in zip(units, cut, strict=True):
            if len(pieces) > 1:
                cache[u] = b"".join(map(cache.__getitem__, pieces))

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cache = self.cache
        cut = [self._units(t) for t in texts]
        new: set[str] = set()
        for units in cut:
            new.update(filterfalse(cache.__contains__, units))
        self._fill(list(new))
        out = [b"".join(map(cache.__getitem__, units)) for units in cut]
        if len(cache) > CACHED_PIECES:
            cache.clear()
        else:
            for u in self._long:
                cache.pop(u, None)
        self._long.clear()
        return out


#: The last one of each class: a worker holds one vocabulary, and builds it once.
_HELD: dict[str, tuple] = {}


def _ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}


def _vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    key = (hash(lines), pattern)
    if _HELD.get("vocabulary", (None,))[0] != key:
        _HELD["vocabulary"] = key, Vocabulary(_ranks(lines), pattern)
    return _HELD["vocabulary"][1]


def _decoder(lines: bytes) -> Decoder:
    key = hash(lines)
    if _HELD.get("decoder", (None,))[0] != key:
        _HELD["decoder"] = key, Decoder(_ranks(lines))
    return _HELD["decoder"][1]


def read_ranks(path: str) -> bytes:
    """The rank file (under 1 MB), read where the job is submitted and
    broadcast; executors need no copy of their own."""
    with open(path, "rb") as f:
        return f.read()


def _encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, keep: tuple[str, ...], back: bool) -> DataFrame:
    """One pass over the texts; ``back`` adds the decoded bytes."""
    lines = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    width = 1 + len(keep)
    kept = [docs.schema[c] for c in (id_col, *keep)]
    source = docs.select(id_col, *keep, text_col).toDF(*[f"c{i}" for i in range(width + 1)])  # kept columns may have any name
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())] + [T.StructField("bytes", T.BinaryType())] * back
    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)], *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(lines.value, pattern)
        try:
            for batch in batches:
                lengths = pc.fill_null(pc.binary_length(batch.column(width)), 0).to_pylist()
                for a, b in chunks([range(n) for n in lengths], CHUNK_CHARS):
                    codes = vocabulary.encode_texts(batch.column(width).slice(a, b - a).to_pylist())
                    columns = [batch.column(i).slice(a, b - a) for i in range(width)]
                    columns += [pa.array([len(c) // 4 for c in codes], pa.int64()), pa.array(codes, pa.binary())]
                    if back:
                        columns.append(pa.array(vocabulary.decode(codes), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        finally:
            vocabulary.cache.clear()

    return source.mapInArrow(run, schema).toDF(id_col, *keep, *[f.name for f in made])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, n_tokens long, ids binary: little-endian unsigned
    32-bit token ids) of every whole text."""
    return _encoded(docs, ranks_path, pattern, id_col, text_col, keep, False)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``encode`` with the ``bytes`` (binary) that the ids decode to, by one
    worker in one pass."""
    return _encoded(docs, ranks_path, pattern, id_col, text_col, keep, True)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with its ``ids`` turned back into ``bytes`` (binary) in a
    new last column."""
    lines = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    schema = T.StructType([*encoded.schema.fields, T.StructField("bytes", T.BinaryType())])
    at = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(lines.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                decoded = decoder.decode(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Round trip of every document as digests."""
    return round_trip(docs, ranks_path, pattern).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def public_vocabulary() -> tuple[str, str]:
    """(path, pattern) of the public 50k byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, *public_vocabulary())
