"""Exact removal of repeated passages by suffix sorting of anchored suffixes.

A byte goes if a string of `length` bytes (100) that covers it also starts earlier: in a document of smaller id, or earlier in the same
one. Sorting every suffix of the corpus would move each byte a hundred times. Instead each string of 100 bytes is known by one anchor:
of its 61 grams of 40 bytes the one of the smallest hash (the first, if several). Equal strings have equal anchors at equal places, so
only anchors whose gram stands more than once are looked at, and only for these are suffixes made: the bytes after the anchor, and
those before it in reverse, as far as the strings known by this anchor reach.

The suffixes of one gram are sorted deep-shallow: a multikey quicksort with eight-byte characters partitions all groups of one depth
at once down to a shallow depth; what is still tied there shares a long prefix and is ordered by a blind trie. Common prefix lengths of
neighbours, on either side of the anchor, then tell for each of the 61 alignments which strings are equal, without hashing; in each
class all but the earliest are repeats.

Copies of a whole text are found by digest first and need no anchors. Anchors whose strings reach over the same bytes (by gram and a
second hash) are alike: only the first of them is sorted, the others lose all. A gram that stands among more than `hot` different
bytes is not sorted in one task: its strings go as rows to an aggregation, which finds the earliest of each with partial minima.

Defined results: null text is empty. Texts under 100 bytes lose nothing. Rows that share a doc_id are one document: strings at the same start of them are not earlier than each other. Rows without id come after all others, each a document of its own, in the order of
a hash of their text. Extra columns are kept by `with_runs`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tallyline.llm.store import small_or_not, written
from tallyline.llm.words import U64, Powers, mix

LENGTH, GRAM = 100, 40
HOT, CHUNK_ROWS = 50_000, 50_000
_NO_ID = 1 << 62
_BLOCK = 1 << 19
_POWERS = Powers(U64(0xD1342543DE82EF95))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from each place on."""
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=total[1:])
    return mix((total[size:] - total[:-size]) * down[: len(data) - size + 1])


def _block_anchors(data: np.ndarray, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes = gram_hashes(data, size)
    span = length - size + 1
    # the place is put into the low bits, so the least number is the first place of the least hash
    packed = (hashes & ~U64(_BLOCK * 2 - 1)) | np.arange(len(hashes), dtype=U64)
    least, width = packed, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & U64(_BLOCK * 2 - 1)).astype(np.int64)
    change = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change, [len(place)])) - 1
    place = place[first]
    return hashes[place], place, place - first, place - last


def anchors(data: np.ndarray, length: int = LENGTH, size: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, far, near) of the anchors of a text: it is the anchor of the strings that start `near` to `far` bytes before
    it. Long texts go through in blocks of string starts, so an anchor at a seam may come twice, with a part of its strings each."""
    starts = len(data) - length + 1
    if starts <= 0:
        return np.zeros(0, U64), *(np.zeros(0, np.int64),) * 3
    parts = []
    for at in range(0, starts, _BLOCK):
        gram, place, far, near = _block_anchors(data[at : min(at + _BLOCK, starts) + length - 1], length, size)
        parts.append((gram, place + at, far, near))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U64))


_ANCHOR = "gram long, span long, id long, version int, place long, far int, near int"


def _find_anchors(length: int, size: int):
    names = [c.split()[0] for c in _ANCHOR.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, version, text in zip(*(batch.column(c).to_pylist() for c in ("id", "version", "text")), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                gram, place, far, near = anchors(data, length, size)
                if len(gram):
                    span = _span_hashes(data, place - far, place - near + length)
                    owner = np.full(len(gram), key), np.full(len(gram), version, np.int32)
                    parts.append((gram.view(np.int64), span.view(np.int64), *owner, place, far.astype(np.int32), near.astype(np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names)

    return run


def _cut_spans(length: int):
    """The bytes around each anchor of a document, from the documents' texts and their lists of places."""

    def packed(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _SPAN_SCHEMA, strict=True)], schema=_SPAN_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = (batch.column(c).to_pylist() for c in ("id", "version"))
            out: list = []
            for key, version, text, places in zip(ids, versions, batch.column("text").to_pylist(), batch.column("places").to_pylist(), strict=True):
                data = text.encode()
                for p in places:
                    start, end = p["place"] - p["far"], p["place"] - p["near"] + length
                    out.append((p["gram"], p["variants"], key, version, p["place"], p["far"], p["near"], data[start:end]))
                if len(out) > 20_000:
                    yield packed(out)
                    out = []
            if out:
                yield packed(out)

    return run


_SPAN_SCHEMA = pa.schema(
    [
        ("gram", pa.int64()), ("variants", pa.int64()), ("id", pa.int64()), ("version", pa.int32()), ("place", pa.int64()), ("far", pa.int32()),
        ("near", pa.int32()), ("bytes", pa.binary()),
    ]
)
_SPAN = "gram long, variants long, id long, version int, place long, far int, near int, bytes binary"


class _Trie:
    """Blind trie of byte strings of equal length: inner nodes know only the depth at which their strings part."""

    def __init__(self, first: bytes) -> None:
        self.root: list | bytes = first

    @staticmethod
    def _common(a: bytes, b: bytes) -> int:
        apart = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
        return len(a) - (apart.bit_length() + 7) // 8

    def add(self, new: bytes) -> None:
        # first pass: down by the parting bytes alone to some leaf; its common prefix with the new string tells where that goes
        node = self.root
        while isinstance(node, list):
            node = node[1].get(new[node[0]]) or next(iter(node[1].values()))
        depth = self._common(node, new)
        above, at, node = None, -1, self.root
        while isinstance(node, list) and node[0] < depth:
            above, at = node, new[node[0]]
            node = node[1][at]
        if isinstance(node, list) and node[0] == depth:
            node[1][new[depth]] = new
            return
        leaf = node
        while isinstance(leaf, list):
            leaf = next(iter(leaf[1].values()))
        fresh = [depth, {leaf[depth]: node, new[depth]: new}]
        if above is None:
            self.root = fresh
        else:
            above[1][at] = fresh

    def ordered(self) -> Iterator[bytes]:
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if isinstance(node, list):
                waiting += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                yield node


SHALLOW = 3


def deep_shallow_order(group: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Order of equally long suffixes (rows of bytes, a multiple of eight wide) within their groups.

    Shallow part: multikey quicksort with characters of eight bytes, all groups of a depth partitioned by one stable sort; groups of
    one suffix drop out. Deep part: what is still tied after SHALLOW characters is ordered by one blind trie per group, over its
    distinct suffixes.
    """
    words = suffixes.view(">u8")
    order = np.argsort(group, kind="stable")
    group = group[order]
    for depth in range(min(SHALLOW, words.shape[1])):
        open_ = np.zeros(len(group), bool)
        tied = group[1:] == group[:-1]
        open_[1:] |= tied
        open_[:-1] |= tied
        at = np.flatnonzero(open_)
        if not len(at):
            return order
        char = words[order[at], depth]
        sort = np.lexsort((char, group[at]))
        order[at] = order[at][sort]
        char, old = char[sort], group[at]
        new = np.ones(len(at), bool)
        new[1:] = (old[1:] != old[:-1]) | (char[1:] != char[:-1])
        # group numbers stay ascending: a part is named by the place of its first row
        named = np.arange(len(group))
        named[at] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        group = named
    tied = np.flatnonzero(group[1:] == group[:-1])
    if len(tied):
        # rows equal to their neighbour need no trie
        same = (suffixes[order[tied]] == suffixes[order[tied + 1]]).all(axis=1)
        for name in np.unique(group[tied[~same]]):
            first, last = np.searchsorted(group, [name, name + 1])
            rows: dict[bytes, list[int]] = {}
            for r in order[first:last]:
                rows.setdefault(suffixes[r].tobytes(), []).append(r)
            distinct = iter(rows)
            trie = _Trie(next(distinct))
            for text in distinct:
                trie.add(text)
            order[first:last] = [r for text in trie.ordered() for r in rows[text]]
    return order


def _classes_by_depth(group: np.ndarray, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each suffix in the order, length of the prefix that each in order shares with the one before; -1 at a group's start)."""
    order = deep_shallow_order(group, suffixes)
    ranked, group = suffixes[order], group[order]
    shared = np.full(len(order), -1)
    if len(order) > 1:
        apart = ranked[1:] != ranked[:-1]
        common = np.where(apart.any(axis=1), apart.argmax(axis=1), suffixes.shape[1])
        shared[1:] = np.where(group[1:] == group[:-1], common, -1)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place, shared


def repeated_runs(gram: np.ndarray, ids: np.ndarray, place: np.ndarray, far: np.ndarray, near: np.ndarray, spans: list[bytes], length: int = LENGTH):
    """(row, start, end) of the bytes that rows of whole groups lose; rows come sorted by (gram, id, place)."""
    n, reach = len(gram), int(far.max(initial=0))
    width = -(-length // 8) * 8
    back = max(8, -(-reach // 8) * 8)
    right, left = np.zeros((n, width), np.uint8), np.zeros((n, back), np.uint8)
    for k, (text, f) in enumerate(zip(spans, far.tolist(), strict=True)):
        data = np.frombuffer(text, np.uint8)
        right[k, : len(data) - f] = data[f:]
        left[k, :f] = data[:f][::-1]
    group = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1])))
    after, after_shared = _classes_by_depth(group, right)
    before, before_shared = _classes_by_depth(group, left)
    # rows of one document and place are not earlier than each other
    time = np.cumsum(np.concatenate(([0], (gram[1:] != gram[:-1]) | (ids[1:] != ids[:-1]) | (place[1:] != place[:-1]))))
    low, high = np.full(n, -1), np.full(n, -1)
    for back_by in range(int(near.min(initial=0)), reach + 1):
        rows = np.flatnonzero((near <= back_by) & (back_by <= far))
        if not len(rows):
            continue
        right_class = np.cumsum(after_shared < length - back_by)[after[rows]]
        left_class = np.cumsum(before_shared < back_by)[before[rows]]
        key = right_class * (n + 1) + left_class
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        first = np.repeat(time[rows[order[start]]], np.diff(np.append(start, len(key))))
        lost = rows[order[time[rows[order]] > first]]
        low[lost] = np.where(low[lost] < 0, back_by, low[lost])
        high[lost] = back_by
    # all strings of one anchor overlap in it, so together they are one run
    row = np.flatnonzero(high >= 0)
    return row, place[row] - high[row], place[row] - low[row] + length


def _sort_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def resolve(table: pa.Table) -> pa.RecordBatch:
            gram, ids, version, place, far, near = (table.column(c).to_numpy() for c in ("gram", "id", "version", "place", "far", "near"))
            row, start, end = repeated_runs(gram, ids, place, far, near, table.column("bytes").to_pylist(), length)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[row], version[row], start, end)], ["id", "version", "start", "end"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK_ROWS:
                table = pa.Table.from_batches(held)
                gram = table.column("gram").to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))
                if cut:
                    yield resolve(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
        if held and (table := pa.Table.from_batches(held)).num_rows:
            yield resolve(table)

    return run


def _keyed(documents: DataFrame) -> DataFrame:
    """row (all columns of the input), text, digest, id, version (0, or a number that tells texts of one id apart), n_bytes."""
    text = F.coalesce("text", F.lit(""))
    stand_in = F.xxhash64(text).bitwiseAND(F.lit(_NO_ID - 1)) + F.lit(_NO_ID)
    rows = documents.select(F.struct("*").alias("row"), text.alias("text"), F.md5(text).alias("digest"), F.coalesce("doc_id", stand_in).alias("id"))
    by_id = W.partitionBy("id").orderBy("digest")
    other = rows.select("id", "digest").distinct().withColumn("version", F.row_number().over(by_id) - 1).where("version > 0")
    other = written(other, "versions")
    rows = rows.join(small_or_not(other), ["id", "digest"], "left")
    return rows.select("row", "text", "digest", "id", F.coalesce("version", F.lit(0)).alias("version"), F.octet_length("text").cast("long").alias("n_bytes"))


def _hot_runs(spans: DataFrame, length: int) -> DataFrame:
    """What strings of very frequent grams lose, by aggregation: no task holds a gram's rows."""
    back = F.explode(F.sequence("near", "far")).alias("back")
    strings = spans.select("id", "version", "place", "far", "bytes", back)
    key = F.sha2(F.substring("bytes", F.col("far") - F.col("back") + 1, F.lit(length)), 256)
    strings = strings.select("id", "version", (F.col("place") - F.col("back")).alias("start"), key.alias("string"))
    order = F.struct("id", "start")
    earliest = strings.groupBy("string").agg(F.min(order).alias("earliest"), F.count("*").alias("n")).where("n > 1").drop("n")
    lost = strings.join(earliest, "string").where(order > F.col("earliest"))
    return lost.select("id", "version", "start", (F.col("start") + length).alias("end"))


def _lost_runs(rows: DataFrame, copies: DataFrame, length: int, size: int, hot: int) -> DataFrame:
    """(id, version, start, end): runs that first copies lose, overlapping and in no order."""
    texts = rows.where(F.col("n_bytes") >= length).join(small_or_not(copies), "digest", "left").where("first is null or id <= first")
    texts = texts.select("id", "version", "text")
    found = texts.mapInArrow(_find_anchors(length, size), _ANCHOR)
    by_gram, by_span = W.partitionBy("gram"), W.partitionBy("gram", "span").orderBy("id", "place")
    found = found.withColumn("n", F.count("*").over(by_gram)).where("n > 1")
    found = found.withColumn("nth", F.row_number().over(by_span)).withColumn("earliest", F.first(F.struct("id", "place")).over(by_span))
    found = found.withColumn("variants", F.sum((F.col("nth") == 1).cast("long")).over(by_gram))
    sorts = (F.col("nth") == 1) & (F.col("variants") > 1)
    found = found.where(sorts | (F.struct("id", "place") > F.col("earliest")))
    found = found.select("id", "version", "place", "far", "near", F.when(sorts, F.col("gram")).alias("gram"), F.when(sorts, F.col("variants")).alias("variants"))
    found = written(found, "repeated")
    whole = found.where("gram is null").select("id", "version", (F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + length).alias("end"))
    sorted_ = found.where("gram is not null")
    places = sorted_.groupBy("id", "version").agg(F.collect_list(F.struct("gram", "variants", "place", "far", "near")).alias("places"))
    near = texts.join(small_or_not(sorted_.select("id").distinct()), "id", "left_semi")
    spans = near.join(places, ["id", "version"]).mapInArrow(_cut_spans(length), _SPAN)
    if (sorted_.agg(F.max("variants")).first()[0] or 0) > hot:
        spans = written(spans, "spans")
        whole = whole.union(_hot_runs(spans.where(F.col("variants") > hot), length))
        spans = spans.where(F.col("variants") <= hot)
    spans = spans.repartition("gram").sortWithinPartitions("gram", "id", "place")
    return whole.union(spans.mapInArrow(_sort_spans(length), "id long, version int, start long, end long"))


def with_runs(documents: DataFrame, length: int = LENGTH, size: int = GRAM, hot: int = HOT) -> DataFrame:
    """For each input row: row (its columns), text (null as empty), n_bytes and runs, the maximal runs [start, end) of bytes it loses."""
    rows = _keyed(documents)
    copies = rows.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    copies = written(copies.where("n > 1").drop("n"), "copies")
    lost = _lost_runs(rows, copies, length, size, hot)
    by_document = W.partitionBy("id", "version").orderBy("start", "end")
    reach = F.max("end").over(by_document.rowsBetween(W.unboundedPreceding, -1))
    lost = lost.distinct().withColumn("opens", (reach.isNull() | (F.col("start") > reach)).cast("long"))
    lost = lost.withColumn("run", F.sum("opens").over(by_document.rowsBetween(W.unboundedPreceding, 0)))
    lost = lost.groupBy("id", "version", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    lost = lost.groupBy("id", "version").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("found"))
    lost = written(lost, "runs")
    marked = rows.join(small_or_not(copies), "digest", "left").withColumn("copy", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    touched = small_or_not(lost.select("id").distinct())
    # texts that lose nothing, or all as copies, stay where they are
    hit = marked.where("not copy").join(touched, "id", "left_semi").join(lost, ["id", "version"], "left")
    rest = marked.where("not copy").join(touched, "id", "left_anti").unionByName(marked.where("copy")).withColumn("found", F.lit(None).cast(lost.schema["found"].dataType))
    nothing = F.array().cast(lost.schema["found"].dataType)
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    runs = F.when(F.col("copy"), everything).otherwise(F.coalesce("found", nothing)).alias("runs")
    return hit.select(*(columns := ["row", "text", "n_bytes", "copy", "found"])).union(rest.select(*columns)).select("row", "text", "n_bytes", runs)


def kept_bytes(text: str, runs: list[dict]) -> bytes:
    data, at, parts = text.encode(), 0, []
    for run in runs:
        parts.append(data[at : run["start"]])
        at = run["end"]
    return b"".join((*parts, data[at:]))


def removal_report(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and runs for every row."""
    marked = with_runs(documents, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs").to_pylist()
            digest = [hashlib.sha256(kept_bytes(t, r)).hexdigest() for t, r in zip(batch.column("text").to_pylist(), runs, strict=True)]
            columns = [batch.column(c) for c in ("doc_id", "n_bytes", "runs")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digest, pa.string())], ["doc_id", "n_bytes", "runs", "kept_sha256"])

    schema = "doc_id long, n_bytes long, runs array<struct<start: long, end: long>>, kept_sha256 string"
    told = marked.select(F.col("row.doc_id").alias("doc_id"), "text", "n_bytes", "runs").mapInArrow(run, schema)
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return told.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), "kept_sha256", "runs")


def without_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents, all columns, with `text` cut; bytes of a character that was cut in part go with it. A null text stays null."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([t if not len(r) else kept_bytes(t, r).decode("utf-8", "ignore") for t, r in zip(text, runs, strict=True)], dtype=object)

    marked = with_runs(documents, length)
    new = F.when(F.col("row.text").isNotNull(), F.when(F.size("runs") == 0, F.col("text")).otherwise(cut("text", "runs")))
    return marked.select(*[(new if c == "text" else F.col("row")[c]).alias(c) for c in documents.columns])
