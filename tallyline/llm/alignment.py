"""Alignment of two tokenizations of the same bytes by merge-path partitioning.

Both tokenizers cut the text (with a space before it) into tokens whose bytes join to the same string; each token is its end offset. The
merged sequence of A's and B's ends is divided into pieces of equal work: a binary search along each diagonal of the merge grid finds how
many ends of A and of B come before it, so every piece can be merged without the others. Between two neighbouring merged ends lies
exactly one token of A and one of B: each such stretch is a link, an overlapping pair of token occurrences. Offsets where both end close a
group. A piece gives its links, the groups that it closes, and the open fragments at its two sides; fragments of neighbouring pieces are
stitched into groups in the order of the pieces.

A document of one piece is done where it is encoded. The pieces of longer ones are dealt over the tasks with their token ids, and
stitched as a stream, of which only a digest is held.

Links are counted corpus-wide by id pair: in how many rows a pair is linked. Each row's distinct pairs stay in one array of a written
table; the counts, whose number is bounded by the vocabularies and not by the corpus, are joined to them by broadcasts of a summed-up
size, in as many slices as that takes. So no pair of a document is shuffled but for the partial sums.

Defined results: null and empty texts, and texts of which a tokenizer changes the bytes, have no tokens: zeros, and '' as digest. Texts of
any length are encoded whole. Rows are counted as they stand: repeated rows and rows that share an id, or have none, are documents of
their own. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tallyline.llm import tokens
from tallyline.llm.store import written

PIECE = 1 << 16
SLICE_BYTES = 64 << 20
#: Rows of an Arrow batch given back at once end at so many characters read.
_FLUSH = 1 << 20


def cuts(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Where the merge of two ascending arrays is cut into pieces of `size` steps: how many of a and b come before each cut.

    Equal values are merged a first and never cut apart.
    """
    out = [(0, 0)]
    for diagonal in range(size, len(a) + len(b), size):
        low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
        while low < high:
            middle = (low + high) // 2
            if a[middle] <= b[diagonal - 1 - middle]:
                low = middle + 1
            else:
                high = middle
        i, j = low, diagonal - low
        if i and j < len(b) and a[i - 1] == b[j]:
            j += 1
        if (i, j) != out[-1]:
            out.append((i, j))
    if out[-1] != (len(a), len(b)):
        out.append((len(a), len(b)))
    return out


class Piece:
    """One piece of the merge: tokens [0, n_a) of A and [0, n_b) of B end in it; a further token of each may reach into it."""

    def __init__(self, a_ids: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_ends: np.ndarray, n_a: int, n_b: int) -> None:
        self.a_ids, self.b_ids, self.n_a, self.n_b = a_ids, b_ids, n_a, n_b
        # two ascending runs: a stable sort merges them
        ends = np.sort(np.concatenate((a_ends[:n_a], b_ends[:n_b])), kind="stable")
        ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))] if len(ends) else ends
        a, b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        self.links = (a_ids[a] << 32) | b_ids[b]
        # a stretch ends a group where it ends a token of both, within the piece
        both = (a < n_a) & (b < n_b)
        both[both] &= a_ends[a[both]] == b_ends[b[both]]
        self.a_cuts, self.b_cuts = a[both] + 1, b[both] + 1

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs linked in this piece and how many links each has."""
        return np.unique(self.links, return_counts=True)

    def fragments(self) -> tuple[int, str, str, str, str, str]:
        """Groups closed here; the ids of A and B up to the first closing; the groups closed within; the ids after the last closing."""
        i, j = self.a_cuts.tolist(), self.b_cuts.tolist()
        if not i:
            return 0, _listed(self.a_ids[: self.n_a]), _listed(self.b_ids[: self.n_b]), "", "", ""
        inner = _spelled(self.a_ids[i[0] : i[-1]], self.b_ids[j[0] : j[-1]], self.a_cuts[1:] - i[0], self.b_cuts[1:] - j[0])
        tails = _listed(self.a_ids[i[-1] : self.n_a]), _listed(self.b_ids[j[-1] : self.n_b])
        return len(i), _listed(self.a_ids[: i[0]]), _listed(self.b_ids[: j[0]]), inner, *tails


def _listed(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


@functools.cache
def _words(size: int) -> np.ndarray:
    """Each id with a comma, a bar and a semicolon behind it."""
    return np.array([f"{k}{mark}".encode() for k in range(size) for mark in ",|;"])


def _spelled(a_ids: np.ndarray, b_ids: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> str:
    """`a,a|b;a|b,b` for the groups that end at the cuts: every id is put in its place with the mark that follows it."""
    if not len(a_cuts):
        return ""
    group_a, group_b = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (a_cuts, b_cuts))
    marked = np.empty(len(a_ids) + len(b_ids), np.int64)
    a, b = a_ids * 3, b_ids * 3
    a[a_cuts - 1] += 1
    b[b_cuts - 1] += 2
    marked[np.arange(len(a)) + np.concatenate(([0], b_cuts[:-1]))[group_a]] = a
    marked[np.arange(len(b)) + a_cuts[group_b]] = b
    size = 1 << int(max(a_ids.max(), b_ids.max())).bit_length()
    return _words(size)[marked].tobytes().translate(None, b"\0")[:-1].decode()


class Stitch:
    """Groups of consecutive pieces, digested as they close."""

    def __init__(self) -> None:
        self.groups, self._digest = 0, hashlib.sha256()
        self._a: list[str] = []
        self._b: list[str] = []

    def add(self, closed: int, head_a: str, head_b: str, body: str, tail_a: str, tail_b: str) -> None:
        self._a += [head_a] if head_a else []
        self._b += [head_b] if head_b else []
        if closed:
            text = f"{','.join(self._a)}|{','.join(self._b)}" + (";" + body if body else "")
            self._digest.update(((";" if self.groups else "") + text).encode())
            self.groups += closed
            self._a, self._b = [tail_a] if tail_a else [], [tail_b] if tail_b else []

    def done(self) -> tuple[int, str]:
        return self.groups, self._digest.hexdigest()


def encoded(text: str | None, folder: str = tokens.FOLDER) -> tuple[np.ndarray, ...] | None:
    """Ids and byte ends of A, and of B; None where there are no tokens."""
    if not text:
        return None
    a, b, whole = tokens.byte_level(folder), tokens.pieces(folder), f" {text}"
    b_ids = b.encode(text)
    if b.lengths[b_ids].sum() != len(data := whole.encode()) or b.joined(b_ids) != data:
        return None
    a_ids = a.encode(whole)
    return None if a.joined(a_ids) != data else (a_ids, a.ends(a_ids), b_ids, b.ends(b_ids))


_TOLD = "piece int, of int, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
_TOKENS = "a_ids binary, a_ends binary, b_ids binary, b_ends binary"
_MERGED = "piece int, n_a long, n_b long, closed long, head_a string, head_b string, body string, tail_a string, tail_b string, pairs array<long>, times array<int>"


def _schema(documents: DataFrame, ddl: str) -> T.StructType:
    key = [T.StructField("key", T.LongType()), T.StructField("doc_id", documents.schema["doc_id"].dataType)]
    return T.StructType(key + T.StructType.fromDDL(ddl).fields)


def _arrow(rows: list[tuple], schema: T.StructType, id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    types = [id_type if f.name == "doc_id" else kinds[f.dataType.simpleString()] for f in schema.fields]
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], schema.names)


def _encode(documents: DataFrame, folder: str, size: int) -> DataFrame:
    """One row for a document of one piece, finished; a row with its tokens for each piece of a longer one."""
    schema = _schema(documents, f"{_TOLD}, {_TOKENS}")
    nothing = (0, 1, 0, 0, 0, "", [], [], None, None, None, None)

    def one(text: str | None) -> Iterator[tuple]:
        found = encoded(text, folder)
        if found is None:
            yield nothing
            return
        a_ids, a_ends, b_ids, b_ends = found
        at = cuts(a_ends, b_ends, size)
        if len(at) == 2:
            piece = Piece(*found, len(a_ids), len(b_ids))
            stitch = Stitch()
            stitch.add(*piece.fragments())
            yield (0, 1, len(a_ids), len(b_ids), *stitch.done(), *piece.counted(), None, None, None, None)
            return
        for k, ((i, j), (p, q)) in enumerate(zip(at, at[1:], strict=False)):
            some = [x.tobytes() for x in (a_ids[i : p + 1], a_ends[i : p + 1], b_ids[j : q + 1], b_ends[j : q + 1])]
            yield (k, len(at) - 1, p - i, q - j, None, None, None, None, *some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            id_type, rows, seen = batch.schema.field("doc_id").type, [], 0
            for k in range(batch.num_rows):
                key, doc, text = (batch.column(c)[k].as_py() for c in range(3))
                rows += [(key, doc, *row) for row in one(text)]
                seen += len(text or "")
                if seen > _FLUSH:
                    yield _arrow(rows, schema, id_type)
                    rows, seen = [], 0
            yield _arrow(rows, schema, id_type)

    keyed = documents.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text")
    return written(keyed.mapInArrow(run, schema), "encoded")


def _merge(pieces: DataFrame) -> DataFrame:
    """Links and fragments of the pieces of long documents, wherever they were dealt."""
    schema = _schema(pieces, _MERGED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                key, doc, piece, n_a, n_b, *some = (batch.column(c)[k].as_py() for c in range(9))
                found = Piece(*[np.frombuffer(x, np.int64) for x in some], n_a, n_b)
                yield _arrow([(key, doc, piece, n_a, n_b, *found.fragments(), *found.counted())], schema, batch.schema.field("doc_id").type)

    names = ["key", "doc_id", "piece", "n_a", "n_b", "a_ids", "a_ends", "b_ids", "b_ends"]
    return written(pieces.select(*names).repartition("key", "piece").mapInArrow(run, schema), "merged")


def _stitch(merged: DataFrame) -> DataFrame:
    schema = _schema(merged, "n_a long, n_b long, n_groups long, groups_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n_a, n_b, stitch, id_type = None, 0, 0, Stitch(), pa.null()
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for k in range(batch.num_rows):
                key, doc, a, b, *fragments = (batch.column(c)[k].as_py() for c in range(10))
                if now is not None and now[0] != key:
                    yield _arrow([(*now, n_a, n_b, *stitch.done())], schema, id_type)
                    n_a, n_b, stitch = 0, 0, Stitch()
                now = (key, doc)
                n_a, n_b = n_a + a, n_b + b
                stitch.add(*fragments)
        if now is not None:
            yield _arrow([(*now, n_a, n_b, *stitch.done())], schema, id_type)

    names = ["key", "doc_id", "n_a", "n_b", "closed", "head_a", "head_b", "body", "tail_a", "tail_b"]
    ordered = merged.select(*names, "piece").repartition("key").sortWithinPartitions("key", "piece")
    return ordered.mapInArrow(run, schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, count, best): in how many rows of (key, pair, times) a pair stands, and whether that is the highest of its id of A."""
    counts = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
    highest = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return written(counts.select("pair", "count", (F.col("count") == highest).alias("best")), "pair-counts")


def scored(pairs: DataFrame, counts: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(key, n_links, n_best, count_sum) from (key, pair, times); counts are broadcast in slices of a bounded size."""
    slices = max(1, -(-counts.count() * 64 // slice_bytes))
    found = None
    for k in range(slices):
        mine = F.pmod(F.xxhash64("pair"), F.lit(slices)) == k
        part = pairs.where(mine).join(F.broadcast(counts.where(mine)), "pair")
        found = part if found is None else found.unionByName(part)
    sums = {"n_links": F.col("times"), "n_best": F.when(F.col("best"), F.col("times")).otherwise(0), "count_sum": F.col("times") * F.col("count")}
    return found.groupBy("key").agg(*[F.sum(v.cast("long")).alias(n) for n, v in sums.items()])


def align(documents: DataFrame, folder: str = tokens.FOLDER, piece: int = PIECE) -> DataFrame:
    """One row per document: its tokens, groups and links, and how its links stand in the whole corpus."""
    first = _encode(documents, folder, piece)
    merged = _merge(first.where("of > 1"))
    linked = F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times")))
    long = merged.select("key", linked).groupBy("key", "pair").agg(F.sum("times").cast("int").alias("times"))
    pairs = first.where("of = 1").select("key", linked).unionByName(long)
    names = ["key", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    rows = first.where("of = 1").select(*names).unionByName(_stitch(merged).select(*names))
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")]
    whole = rows.join(scored(pairs, pair_counts(pairs)), "key", "left")
    return whole.select("doc_id", "n_a", "n_b", "n_groups", *sums[:2], sums[2], "groups_sha256")
