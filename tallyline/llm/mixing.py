"""Mixing sources to target weights: hash-random order, distributed prefix sums, an exact cut at each source's budget.

Sources in code point order, null last, take the weights in turn. Together they share all words; a source's target stops at
`most_epochs` times its own size, and what it cannot take is shared among the others by weight, until none is above its limit. That
fixed point is min(limit, level * weight) for the one level at which the targets add up to the total.

Every document draws a key from its id. Within a source documents stand in the order of their keys; the key's first digits make
range buckets, so a source with a third of all rows is 4,096 sorts, not one. Prefix sums are the sums of earlier buckets plus the
running sum within the bucket. A source takes all its documents once for each whole epoch of its target, then those in key order
until the rest of the budget is used up; the document at the cut is taken in part, so the words taken equal the target rounded down.

Defined results: null or empty text has size 0 and is taken 0 words. A source without words has target 0. Rows with equal doc_id
draw the same key and follow each other in the order of their text; wholly equal rows are interchangeable. Null doc_ids draw their
key from the text. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tallyline.llm.store import small_or_not

SIZE_PATTERN = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
#: Hexadecimal digits of the key that name its range bucket.
BUCKET_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from rows (source, size): one row per source, so the windows here are as small as that list."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(order) - 1) % len(weights)
    table = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1))
    table = table.withColumn("limit", F.col("source_size") * F.lit(float(most_epochs)))
    # sources reach their limits in the order of limit / weight; before the level that fits, all earlier ones stand at their limits
    filled = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    everywhere = W.partitionBy()
    table = (
        table.withColumn("total", F.sum("source_size").over(everywhere).cast("double"))
        .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("open_weight"))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("limit"))
    )
    level = F.min(F.when(F.col("fits"), F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level")))).over(everywhere)
    target = F.least(F.col("limit"), F.coalesce(level["level"] * F.col("weight"), F.col("limit")))
    return table.select("source", "source_size", target.alias("target"))


def mix_sources(
    documents: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS, seed: str = "", keep: Sequence[str] = ()
) -> DataFrame:
    """Every input row's doc_id, `keep` columns, size, source_size, target and taken (words of it in the mix, repeats counted)."""
    text = F.coalesce("text", F.lit(""))
    drawn = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), text)))
    docs = documents.select(
        "doc_id", "source", F.regexp_count(text, F.lit(SIZE_PATTERN)).cast("long").alias("size"), drawn.alias("key"), F.md5(text).alias("tie"),
        F.struct(*keep).alias("kept") if keep else F.lit(None).cast("int").alias("kept"),
    ).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    before = sums.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before")
    )
    target = source_targets(sums.select("source", "size"), weights, most_epochs).withColumnRenamed("source", "of")
    plan = small_or_not(before.join(target, F.col("s").eqNullSafe(F.col("of"))).drop("of"))
    within = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "tie").rowsBetween(W.unboundedPreceding, -1)
    placed = docs.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor("target") - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before") - F.col("within")))
    kept = [F.col("kept")[c].alias(c) for c in keep if c != "doc_id"]
    return placed.select("doc_id", *kept, "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def oracle(weights: Sequence[float] = WEIGHTS, most_epochs: float = MOST_EPOCHS) -> str:
    """The same in SQL: fills the level source by source instead of by windows over the limits, and sums over whole sources."""
    listed = ", ".join(f"{float(w)}" for w in weights)
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, coalesce(text, ''))) AS key, md5(coalesce(text, '')) AS tie
  FROM documents),
s AS (
  SELECT source, sum(size)::DOUBLE AS source_size, {float(most_epochs)} * sum(size) AS cap,
         [{listed}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}] AS w
  FROM d GROUP BY source),
fill AS (
  SELECT 0 AS step, (SELECT sum(source_size) / sum(w) FROM s) AS level
  UNION ALL
  SELECT step + 1, coalesce((SELECT ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) FILTER (cap < level * w), 0))
                   / nullif(sum(w) FILTER (cap >= level * w), 0) FROM s), level)
  FROM fill WHERE step < 2 + (SELECT count(*) FROM s)),
t AS (SELECT source, source_size, least(cap, w * (SELECT max_by(level, step) FROM fill)) AS target FROM s),
p AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(floor(t.target) / t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(0, least(size, floor(target) - epochs * source_size - before)))::BIGINT AS taken
FROM p"""
