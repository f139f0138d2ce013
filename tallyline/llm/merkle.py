"""Merkle manifest of a dataset: a persistent tree whose versions copy only the path above a tampered leaf.

Every row is a leaf: the SHA-256 of its columns. The rows of one source, by id, are the leaves of a tree in which each run of ARITY
consecutive nodes has the hash of their digests above it; the roots of the sources, by source, are the leaves of a last tree, whose root
stands for the dataset. Trees are cut into aligned blocks of ARITY ** HEIGHT nodes. A block is hashed in one task; the blocks' roots are
the nodes of the next tier, again in blocks, until every tree is one node. A tier has 2187 times fewer nodes than the one below.

A tampered leaf starts a version of its tree. The version shares all nodes of the stored tree except the ancestors of the leaf: within
the leaf's block these are copied from the block's levels, and from the block's root upwards the version goes on along the block's
upper path. Upper paths (per level the digests left and right of the node) come down the tiers once per block, not once per row, so
that rows of a source which holds most of the table meet nothing larger than their own block.

The place of a row in its source is found by a range sort: places within a range plus the rows of the ranges before it. Only ids and
digests are shuffled; texts are hashed where they are read.

Defined results: null columns count as null, not as empty. A null source is the first one. Rows without an id come first in their
source and are not tampered with by the query; rows that share an id stand in the order of their digests, repeated rows in any order
(their results are equal up to their places). An empty table has no rows and no root. Texts of any length are hashed whole. Extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyline.llm.store import bounded_side, written

ARITY, HEIGHT = 3, 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values: dict[str, Column]) -> Column:
    """SHA-256 (binary) over the columns: `-` for null, else the length in bytes, a colon and the value."""

    def told(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[told(values[c]) for c in COLUMNS]), 256))


class Block:
    """The nodes of an aligned block and the levels above them; a tree that fits into one block ends with its root."""

    def __init__(self, nodes: Sequence[str], whole: bool, height: int = HEIGHT) -> None:
        self.levels = [list(nodes)]
        while len(self.levels[-1]) > 1 if whole else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([digest("".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> Iterator[tuple[str, str]]:
        """Per level, from below: the digests left and right of the node's ancestor in its run."""
        for level in self.levels[:-1]:
            run = at - at % ARITY
            yield "".join(level[run:at]), "".join(level[at + 1 : run + ARITY])
            at //= ARITY


def version(node: str, path: Sequence[tuple[str, str]]) -> list[str]:
    """A new node and the ancestors copied for it; every other node is shared with the stored tree."""
    copied = [node]
    for left, right in path:
        copied.append(digest(left + copied[-1] + right))
    return copied


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with `pos`, the place within their `tree` in the given order, and `size`, the number of rows of the tree."""
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = written(ranged.select("*", F.spark_partition_id().alias("part"), nth.alias("nth")), "ranged")
    counts = ranged.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = written(counts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size")), "ranges")
    pos = (F.col("nth") + F.col("shift")).alias("pos")
    return ranged.join(bounded_side(counts), ["tree", "part"]).select(*rows.columns, pos, "size")


def _in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**height}"))


def _block(table: pa.Table, height: int) -> tuple[pa.Table, Block]:
    table = table.sort_by("pos")
    whole = table.column("size")[0].as_py() <= ARITY**height
    return table, Block([d.hex() for d in table.column("digest").to_pylist()], whole, height)


NODES = "tree string, pos long, size long, digest binary"


def _next_tier(nodes: DataFrame, height: int) -> DataFrame:
    def root(table: pa.Table) -> pa.Table:
        table, block = _block(table, height)
        size = -(-table.column("size")[0].as_py() // ARITY**height)
        row = {"tree": table.column("tree")[0].as_py(), "pos": table.column("block")[0].as_py(), "size": size, "digest": bytes.fromhex(block.root)}
        return pa.Table.from_pylist([row], pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("size", pa.int64()), ("digest", pa.binary())]))

    asked = _in_blocks(nodes.select("tree", "pos", "size", "digest"), height)
    return written(asked.groupBy("tree", "block").applyInArrow(root, NODES), "tier")


def tiers(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The given nodes (tree, pos, size, digest), then the roots of their blocks, and so on, until each tree is one node."""
    found = [nodes]
    while len(found) == 1 or not found[-1].where("size > 1").isEmpty():
        found.append(_next_tier(found[-1], height))
    return found


PATH = "tree string, pos long, left array<string>, right array<string>, subroot string, root string"
_STRINGS = pa.list_(pa.string())
_PATH = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("left", _STRINGS), ("right", _STRINGS), ("subroot", pa.string()), ("root", pa.string())])


def _path_row(tree: str, pos: int, path: list[tuple[str, str]], subroot: str, root: str) -> dict:
    return {"tree": tree, "pos": pos, "left": [a for a, _ in path], "right": [b for _, b in path], "subroot": subroot, "root": root}


def _paths(nodes: DataFrame, above: DataFrame, give: Callable[..., pa.Table], schema: T.StructType | str, height: int) -> DataFrame:
    """Meet every block of nodes with the path of the block's root: give(table, block, path, subroot, root) makes the rows."""

    def meet(table: pa.Table, upper: pa.Table) -> pa.Table:
        if not table.num_rows:
            return give(table, None, [], "", "")
        table, block = _block(table, height)
        row = upper.to_pylist()[0]
        return give(table, block, list(zip(row["left"], row["right"], strict=True)), row["subroot"], row["root"])

    lower = _in_blocks(nodes, height).groupBy("tree", "block")
    return lower.cogroup(above.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInArrow(meet, schema)


def _down(found: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """Bring the path above each tree's root (`top`) down the tiers to the roots of the first tier's blocks."""

    def give(table: pa.Table, block: Block | None, path: list[tuple[str, str]], subroot: str, root: str) -> pa.Table:
        at = zip(table.column("tree").to_pylist(), table.column("pos").to_pylist(), strict=True)
        return pa.Table.from_pylist([_path_row(tree, pos, [*block.siblings(k), *path], subroot, root) for k, (tree, pos) in enumerate(at)], _PATH)

    for nodes in reversed(found[1:-1]):
        top = written(_paths(nodes, top, give, PATH, height), "paths")
    return top


@dataclass
class Manifest:
    """leaves: the placed rows; tiers: of the sources' trees; above: (tree, pos, left, right, subroot, root) of each leaf block's root."""

    leaves: DataFrame
    tiers: list[DataFrame]
    above: DataFrame
    height: int


def build(documents: DataFrame, tampered: dict[str, Column] | None = None, height: int = HEIGHT) -> Manifest:
    """Hash all rows and build the trees; `tampered` gives the columns with which some rows are later held against the manifest."""
    own = {c: F.col(c) for c in COLUMNS}
    new = leaf(own | tampered) if tampered else F.lit(None).cast("binary")
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))
    rows = documents.select("doc_id", tree.alias("tree"), leaf(own).alias("digest"), new.alias("changed"))
    rows = rows.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed")))
    leaves = written(placed(written(rows, "leaves"), ["doc_id", "digest", "changed"]), "placed")
    found = tiers(leaves, height)
    subroots = found[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    last = written(placed(subroots, ["source"]), "subroots")
    upper = tiers(last, height)
    empty = F.array().cast("array<string>")
    root = F.lower(F.hex("digest"))
    top = upper[-1].select("tree", "pos", empty.alias("left"), empty.alias("right"), root.alias("subroot"), root.alias("root"))
    top = _down(upper, top, height)

    def give(table: pa.Table, block: Block | None, path: list[tuple[str, str]], _: str, root: str) -> pa.Table:
        of = zip(table.column("source").to_pylist(), table.column("digest").to_pylist(), strict=True)
        return pa.Table.from_pylist([_path_row(tree, 0, [*block.siblings(k), *path], subroot.hex(), root) for k, (tree, subroot) in enumerate(of)], _PATH)

    of_sources = written(_paths(last, top, give, PATH, height), "paths")
    return Manifest(leaves, found, _down(found, of_sources, height), height)


def verify(manifest: Manifest, copies: bool = False) -> DataFrame:
    """One row per document: its leaf and proof, and the root that its present content folds to.

    With `copies`, also `copied`: the nodes of the version that a tampered leaf starts, from the leaf to the new root (null elsewhere).
    """
    kind = manifest.leaves.schema["doc_id"].dataType
    text = [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    schema = T.StructType([T.StructField("doc_id", kind), *text, T.StructField("verified", T.BooleanType()), T.StructField("copied", T.ArrayType(T.StringType()))][: None if copies else -1])

    def give(table: pa.Table, block: Block | None, path: list[tuple[str, str]], subroot: str, root: str) -> pa.Table:
        rows = []
        for k, changed in enumerate(table.column("changed").to_pylist()):
            whole = [*block.siblings(k), *path]
            nodes = version(block.levels[0][k] if changed is None else changed.hex(), whole)
            proof = digest("".join(left + right for left, right in whole))
            rows.append((block.levels[0][k], subroot, root, proof, nodes[-1], nodes[-1] == root, nodes if changed is not None else None))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = [pa.string()] * 5 + [pa.bool_(), pa.list_(pa.string())]
        arrays = [table.column("doc_id").combine_chunks(), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]]
        return pa.table(arrays[: len(schema)], names=schema.names)

    return _paths(manifest.leaves, manifest.above, give, schema, manifest.height)


def without_line_ends(chosen: Column) -> dict[str, Column]:
    """Tampering that deletes the line feeds of the chosen rows' texts."""
    return {"text": F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def chosen() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))


def oracle() -> str:
    """The same trees as lists, level by level; each document's path is folded with list_reduce, its checksum computed bit by bit."""
    told = ", ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in COLUMNS)
    bits = "flatten([[(ascii(c) >> b) & 1 for b in range(8)] for c in string_split(doc_id::VARCHAR, '')])"
    even = f"list_reduce(list_concat([4294967295], {bits}), lambda x, y: xor(x >> 1, 3988292384 * (xor(x, y) & 1))) & 1 = 1"
    run = f"[sha256(array_to_string(nodes[{ARITY} * i + 1:{ARITY} * i + {ARITY}], '')) for i in range((len(nodes) + {ARITY - 1}) // {ARITY})]"

    def levels(name: str, first: str) -> str:
        return f"{name} AS ({first} UNION ALL SELECT source, level + 1, {run} FROM {name} WHERE len(nodes) > 1)"

    def path(node: str, tree: str) -> str:
        at = f"({node}.pos // power({ARITY}, {tree}.level)::BIGINT)"
        first, nodes = f"({at} // {ARITY} * {ARITY})", f"{tree}.nodes"
        sides = f"array_to_string({nodes}[{first} + 1:{at}], '') || '|' || array_to_string({nodes}[{at} + 2:{first} + {ARITY}], '')"
        return f"coalesce(list({sides} ORDER BY {tree}.level) FILTER (len({nodes}) > 1), []) AS path"

    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256(concat({told})) AS leaf,
         sha256(concat({told.replace("text::VARCHAR", "cut")})) AS present
  FROM (SELECT *, CASE WHEN {even} THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, present) - 1 AS pos FROM d),
{levels("up", "SELECT source, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM ordered GROUP BY source")},
sub AS (SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM up WHERE len(nodes) = 1),
{levels("top", "SELECT NULL::VARCHAR AS source, 0 AS level, list(subroot ORDER BY pos) AS nodes FROM sub")},
upper AS (SELECT s.source, s.subroot, {path("s", "t")} FROM sub s CROSS JOIN top t GROUP BY s.source, s.subroot),
lower AS (
  SELECT o.doc_id, o.source, o.leaf, o.present, o.pos, {path("o", "u")}
  FROM ordered o JOIN up u ON u.source IS NOT DISTINCT FROM o.source GROUP BY o.doc_id, o.source, o.leaf, o.present, o.pos),
whole AS (
  SELECT l.doc_id, l.leaf, l.present, u.subroot, list_concat(l.path, u.path) AS path,
         (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root
  FROM lower l JOIN upper u ON u.source IS NOT DISTINCT FROM l.source),
folded AS (
  SELECT *, list_reduce(list_concat([present], path), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
  FROM whole)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded"""
