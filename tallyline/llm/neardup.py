"""Near-duplicate documents by ProbMinHash signatures, banding and exact verification.

A document is the weighted set of its five-word shingles, the weight being how often a shingle stands in it. Each shingle is a
Poisson process whose rate is its weight; every arrival picks a register at random, and a register keeps the shingle that arrives
first. Two signatures then agree in a register with the probability Jaccard similarity of the two documents. A document stops
drawing arrivals as soon as they come later than all its registers. A document in which a shingle stands more than once has a second
signature, from the same processes at rate 1; two such signatures agree with the plain Jaccard similarity of the distinct shingles. A
document without repeated shingles has one signature for both.

Bands of registers of either signature give candidate pairs. Equal texts are one node from the start, so copies never pair. In a first pass each node
of a bucket is compared with the bucket's leader and with its neighbours in a random order, which needs a fixed number of pairs per
node and joins almost all of a large group. Only buckets that then still hold several groups are looked at again: there every pair
of nodes of different groups is a candidate (a pair within a group cannot change any class). Large buckets go through in blocks of
nodes, each pair of blocks a small task of its own. Only pairs whose counted or whose plain signatures agree in 0.66 of the registers
go on, which a pair of similarity 0.8 does with probability 0.9999, and in buckets of more than 64 nodes only those whose shingles, shortened to 32 bits,
are similar enough but for a hair and do not lie in one group through links found before. Candidates of both passes are verified on their whole texts: they are linked if
the probability Jaccard similarity, or the plain one of the distinct shingles, reaches the threshold. Classes are the connected
components of the links, found by star contraction on written tables.

Defined results: a document without words (also null text) is alone in its class. One of fewer than five words is one shingle. Rows
that share a doc_id are one document and share a class. Rows with a null doc_id are classed with their copies and near copies (they
go by a number above 2**62 made from their text); if no row of a class has an id, class_id is null. Extra columns are not read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyline.llm.store import small_or_not, written
from tallyline.llm.words import U64, counted_shingles, mix, shingle_hashes, word_hashes

SIZE, THRESHOLD = 5, 0.8
#: 25 bands of 5 registers: a pair of similarity 0.8 meets in some band with probability 0.99995, one of 0.85 with 0.999999.
BANDS, ROWS = 25, 5
#: Share of agreeing registers below which a pair of the second pass is not verified; four standard deviations below 0.8.
AGREE = 0.66
#: Nodes of a block of a bucket, and neighbours that a node is compared with in the first pass.
BLOCK, NEIGHBOURS = 1000, 2
#: Nodes of a bucket from which its pairs are compared by short shingles before they leave their task, and the hair.
LARGE, HAIR = 64, 0.005
_FLUSH = 200_000
#: Characters of texts whose shingles a verifying task keeps at hand.
_KEEP = 8_000_000
_NO_ID = 1 << 62


def rows_of(batches: Iterable[pa.RecordBatch | pd.DataFrame]) -> Iterator[tuple]:
    """The rows of Arrow batches (or pandas frames) one by one: only one text at a time becomes a Python string."""
    for batch in batches:
        if isinstance(batch, pd.DataFrame):
            batch = pa.RecordBatch.from_pandas(batch, preserve_index=False)
        for k in range(batch.num_rows):
            yield tuple(c[k].as_py() for c in batch.columns)


def signatures(docs: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash signatures of several weighted sets at once: documents x registers, each cell a shingle's hash."""
    items = np.concatenate([d[0] for d in docs])
    rate = np.concatenate([d[1] for d in docs]).astype(float)
    row = np.repeat(np.arange(len(docs)), [len(d[0]) for d in docs])
    first = np.full(len(docs) * registers, np.inf)
    owner = np.zeros(len(docs) * registers, U64)
    time = np.zeros(len(items))
    step = 0
    while len(items):
        step += 1
        drawn = mix(items + U64(step * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log(((drawn >> U64(11)).astype(float) + 0.5) * 2.0**-53) / rate
        last = first.reshape(len(docs), registers).max(axis=1)
        live = time < last[row]
        items, rate, row, time, drawn = (x[live] for x in (items, rate, row, time, drawn))
        cell = row * registers + (mix(drawn ^ U64(0xA5A5A5A5A5A5A5A5)) % U64(registers)).astype(np.int64)
        np.minimum.at(first, cell, time)
        won = time == first[cell]
        owner[cell[won]] = items[won]
    return owner.reshape(len(docs), registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Probability Jaccard and plain Jaccard similarity of two counted sets (distinct ascending hashes, counts)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    plain = len(common) / (len(a[0]) + len(b[0]) - len(common))
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    ratio = y / x
    # shared shingle i adds 1 / sum over all shingles of max(x_j / x_i, y_j / y_i); the maximum is the first term where y_j / x_j is no larger
    upto = np.searchsorted(ratio, ratio, side="right")
    below = np.concatenate(([0.0], np.cumsum(x)))[upto] + (a[1].sum() - x.sum())
    above = y.sum() - np.concatenate(([0.0], np.cumsum(y)))[upto] + (b[1].sum() - y.sum())
    return float((1.0 / (below / x + above / y)).sum()), plain


def _sketch(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            repeats = [k for k, (_, (_, n)) in enumerate(held) if n.max() > 1]
            plain = [(held[k][1][0], np.ones(len(held[k][1][0]))) for k in repeats]
            flat = signatures([s for _, s in held] + plain, bands * rows)
            sig, low = flat.reshape(len(flat), bands, rows), flat.astype(np.uint16)
            key = np.zeros(sig.shape[:2], U64)
            for k in range(rows):
                key = mix(key * U64(0xD6E8FEB86659FD93) + sig[:, :, k])
            key = mix(key + np.arange(bands, dtype=U64)).view(np.int64)
            keys, sigs = list(key[: len(held)]), [x.tobytes() for x in low[: len(held)]]
            for at, k in enumerate(repeats, len(held)):
                keys[k], sigs[k] = np.concatenate((keys[k], key[at])), sigs[k] + low[at].tobytes()
            columns = [i for (i, _), _ in held], [d for (_, d), _ in held], keys, sigs
            types = pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["id", "digest", "keys", "sig"])

        held: list = []
        weight = 0
        for row in rows_of(batches):
            counted = counted_shingles(row[2].encode(), size)
            if len(counted[0]):
                held.append((row[:2], counted))
                weight += len(counted[0])
            if weight > _FLUSH:
                yield flush()
                held, weight = [], 0
        if held:
            yield flush()

    return run


def _verify(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # texts of a large group come again and again: keep the sets of the latest ones
        known: OrderedDict = OrderedDict()
        held = 0

        def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            if text in known:
                known.move_to_end(text)
            else:
                known[text] = counted_shingles(text.encode(), size)
                held += len(text)
                while held > _KEEP and len(known) > 2:
                    held -= len(known.popitem(last=False)[0])
            return known[text]

        for batch in batches:
            out = []
            for a, b, left, right in rows_of([batch]):
                prob, plain = similarity(counted(left), counted(right))
                if max(prob, plain) >= threshold:
                    out.append((a, b, prob, plain))
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = pa.int64(), pa.int64(), pa.float64(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["a", "b", "prob_jaccard", "jaccard"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    both = right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    return both.select("a", "b", "left", "right").mapInArrow(
        _verify(size, threshold), "a long, b long, prob_jaccard double, jaccard double"
    )


def _shorten(size: int):
    """Shingles of each text shortened to 32 bits, sorted, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            short = [np.sort((shingle_hashes(word_hashes(t.encode())[0], size) >> U64(32)).astype(np.uint32)).tobytes() for _, t in rows_of([batch])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(short, pa.binary())], ["node", "short"])

    return run


def _nearness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of both similarities; without repeats both are the plain one."""
    if a[1].max() == b[1].max() == 1:
        common = len(a[0]) + len(b[0]) - len(np.union1d(a[0], b[0]))
        return common / (len(a[0]) + len(b[0]) - common)
    return max(similarity(a, b))


def _across(bands: int, rows: int, agree: float, threshold: float):
    """Pairs of nodes of different groups within one bucket's pair of blocks, from rows sorted by (key, i, j)."""

    def pairs(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node")
        node, root, block = (group[c].to_numpy().copy() for c in ("node", "root", "block"))
        # counted and plain signature; a document with one has it for both
        whole = 4 * bands * rows
        known = group["sig"].notna().to_numpy()
        sigs = [s if len(s) == whole else s * 2 for s in group["sig"].where(known, bytes(whole))]
        sig = np.frombuffer(b"".join(sigs), np.uint16).reshape(len(node), 2, bands * rows)
        i, j, band = (group[c].iat[0] for c in ("i", "j", "band"))
        short = group["short"].tolist()
        sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def counted(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in sets:
                sets[k] = np.unique(np.frombuffer(short[k], np.uint32), return_counts=True)
            return sets[k]

        found = []
        for x in np.flatnonzero(block == i):
            other = root != root[x]
            other &= (block == j) if i != j else (np.arange(len(node)) > x)
            y = np.flatnonzero(other)
            same = sig[y] == sig[x]
            # an id with several texts has no one signature: its pairs all go on
            sure = known[x] & known[y]
            y, same, sure = (z[(same.mean(axis=2).max(axis=1) >= agree) | ~sure] for z in (y, same, sure))
            if not len(y):
                continue
            # a pair is told in the first band that it shares by either signature
            met = same.reshape(len(y), 2, bands, rows).all(axis=3).any(axis=1)
            for k in y[(met.argmax(axis=1) == band) | ~sure]:
                if short[x] is not None and short[k] is not None:
                    if root[k] == root[x] or (near := _nearness(counted(x), counted(k))) < threshold - HAIR:
                        continue
                    if near >= threshold + HAIR:
                        root[root == root[k]] = root[x]
                found.append((min(node[x], node[k]), max(node[x], node[k])))
        return pd.DataFrame(found, columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            name = held[["key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((name[1:] != name[:-1]).any(axis=1)) + 1
            if len(cuts):
                for start, end in zip(np.concatenate(([0], cuts[:-1])), cuts, strict=True):
                    yield pairs(held.iloc[start:end])
                held = held.iloc[cuts[-1] :].reset_index(drop=True)
        if held is not None and len(held):
            yield pairs(held)

    return run


def _are_stars(edges: DataFrame) -> bool:
    """Whether in distinct edges (a, b) each a has one edge and none is a b too: then every b is the root of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(edges.select("b", F.lit(0)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return (ends.agg(F.max(F.when(F.col("up") > 0, F.col("n")))).first()[0] or 0) <= 1


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of a link list (a, b): alternate large-star and small-star steps until only stars are left.

    Each round joins the edges with one minimum per node, pre-aggregated before its shuffle; a node with a third of all edges is a
    skewed side of that join, which adaptive execution splits. An edge gives one row to either step, so repeated rows go only at the
    end of a round. Rounds grow with the logarithm of the largest component; none is run to see that nothing changes any more.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        other = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(other.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        if _are_stars(edges):
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())


def _own_id() -> Column:
    """doc_id, or for rows without one a number above all ids that depends on the text alone."""
    stand_in = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(_NO_ID - 1)) + F.lit(_NO_ID)
    return F.coalesce("doc_id", stand_in)


def near_duplicates(
    documents: DataFrame, threshold: float = THRESHOLD, size: int = SIZE, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """(classes, links). Classes: for each input row its doc_id, class_id (smallest doc_id of the class) and n_links (verified links
    of its text to other texts, as far as they were looked at); further id, its doc_id or what stands for it, root, the smallest such
    of its class, and stays, whether they are equal. Links: pairs of nodes a < b with both similarities; a node is the smallest id of
    a text."""
    text = F.coalesce("text", F.lit(""))
    docs = documents.select("doc_id", _own_id().alias("id"), F.md5(text).alias("digest"), text.alias("text"))
    sketch = docs.select("id", "digest", "text").mapInArrow(
        _sketch(bands, rows, size), "id long, digest string, keys array<long>, sig binary"
    )
    sketch = written(sketch, "sketches")
    node = sketch.groupBy("digest").agg(F.min("id").alias("node"), F.any_value("keys").alias("keys"))
    bucket = node.select("node", F.posexplode("keys").alias("band", "key")).withColumn("band", F.col("band") % bands).distinct()
    count = bucket.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("most"), F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK)
    shared = bucket.join(count.where("lead <> most").drop("most"), "key")
    shared = shared.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    shared = written(shared, "buckets")
    wanted = shared.select(F.col("node").alias("id")).distinct()
    texts = written(docs.select("id", "text").join(small_or_not(wanted), "id", "left_semi").distinct(), "texts")

    order = W.partitionBy("key", "block").orderBy(F.xxhash64("node", "key"), "node")
    others = F.array("lead", *[F.lag("node", k).over(order) for k in range(1, NEIGHBOURS + 1)])
    near = shared.withColumn("others", others).select("node", F.explode("others").alias("other")).where("node <> other")
    near = written(near.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "neighbours")
    links = written(_verified(near, texts, size, threshold), "links")

    root = components(links)
    grouped = shared.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = grouped.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    # written before it is counted and joined: else each of these makes it again, with the roots and all
    grouped = written(grouped.join(mixed.select("key"), "key"), "mixed")
    large = small_or_not(grouped.where(F.col("n") > LARGE).select(F.col("node").alias("id")).distinct())
    one = F.min("digest") == F.max("digest")
    grouped = grouped.join(sketch.groupBy(F.col("id").alias("node")).agg(F.when(one, F.any_value("sig")).alias("sig")), "node")
    short = texts.join(large, "id", "left_semi").select("id", "text").mapInArrow(_shorten(size), "node long, short binary")
    # an id with several texts has no one set of shingles: its pairs all go on
    short = short.groupBy("node").agg(F.any_value("short").alias("short"), F.count("*").alias("texts")).where("texts = 1").drop("texts")
    grouped = grouped.join(short, "node", "left").withColumn("short", F.when(F.col("n") > LARGE, F.col("short")))
    # every pair of blocks i <= j of a bucket gets the nodes of both
    span = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda x: F.struct(F.least(x, "block").alias("i"), F.greatest(x, "block").alias("j")),
    )
    tasks = grouped.select("key", "band", "node", "root", "block", "sig", "short", F.inline(span)).repartition("key", "i", "j")
    across = tasks.sortWithinPartitions("key", "i", "j", "node").mapInPandas(_across(bands, rows, AGREE, threshold), "a long, b long")
    # a band that a pair shares by both signatures may be two buckets
    rest = written(across.distinct().join(near, ["a", "b"], "left_anti"), "pairs")
    new = written(_verified(rest, texts, size, threshold), "links")
    links = links.union(new).distinct()

    # the first pass's stars stand for all its links
    root = components(root.select(F.col("node").alias("a"), F.col("root").alias("b")).union(new.select("a", "b")))
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    degree = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    known = node.select("digest", "node").join(root, "node", "left").join(degree, "node", "left")
    out = docs.select("doc_id", "id", "digest").join(known, "digest", "left")
    root_id = F.coalesce("root", "node", "id")
    classes = out.select(
        "doc_id", F.when(root_id < _NO_ID, root_id).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        root_id.alias("root"), (F.col("id") == root_id).alias("stays"), "id",
    )
    return classes, links


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents, all columns, one of each class: the row of the smallest doc_id. Of rows that share that id (rows without id and of
    equal text count as sharing one), the first by its columns stays."""
    classes = near_duplicates(documents)[0]
    stays = written(classes.where("stays").groupBy("id").agg(F.count("*").alias("n")), "stays")
    rows = documents.select(F.struct("*").alias("row"), _own_id().alias("own"))
    once = rows.join(small_or_not(stays.where("n = 1").select("id")), F.col("own") == F.col("id"), "left_semi")
    often = rows.join(small_or_not(stays.where("n > 1").select("id")), F.col("own") == F.col("id"), "left_semi")
    place = F.row_number().over(W.partitionBy("own").orderBy(F.md5(F.to_json("row"))))
    kept = once.union(often.withColumn("place", place).where("place = 1").drop("place"))
    return kept.select(*[F.col("row")[c].alias(c) for c in documents.columns])
