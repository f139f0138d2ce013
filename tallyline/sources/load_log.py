"""The log of all loads: one row per stored period, appended when the period is in place.

It serves as audit (rows before and after, rows set aside, by whose request) and as ledger: a load that was ended goes on from it,
because a period counts as done only by its row here. Rows are appended and never changed; of a period the row with the highest `seq`
holds. Loads that write to one log run one after the other.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyline.sources.sinks import exists

SCHEMA = (
    "seq bigint, load string, run string, request_id bigint, period string, state string, rows_before bigint, rows_after bigint, "
    "rows_rejected bigint, digest decimal(38,0)"
)
DONE = "done"


@dataclass
class Entry:
    """What one load did to one period."""

    load: str
    run: str
    request_id: int | None
    period: str | None
    state: str
    rows_before: int
    rows_after: int
    rows_rejected: int
    digest: object


def append(spark: SparkSession, folder: str, entries: Iterable[Entry]) -> None:
    first = 1 + (load_log(spark, folder).agg(F.max("seq")).head()[0] or 0)
    rows = [(first + k, *astuple(e)) for k, e in enumerate(entries)]
    if rows:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def load_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], SCHEMA)


def done(spark: SparkSession, folder: str, load: str, run: str) -> set[str | None]:
    """Periods that a run has finished; they bound the result, a row each."""
    rows = load_log(spark, folder).filter((F.col("load") == load) & (F.col("run") == run) & (F.col("state") == DONE))
    return {r["period"] for r in rows.select("period").distinct().collect()}


def row_digest(columns: Iterable[str]) -> Column:
    """Aggregate: a number that depends on all rows, repeats included, and not on their order."""
    return F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)"))


def audit(spark: SparkSession, folder: str, load: str, stored: DataFrame, period: str) -> DataFrame:
    """Each period's latest entry beside what is stored now: `agrees` is false where rows or digest differ."""
    entries = load_log(spark, folder).filter(F.col("load") == load)
    nth = F.row_number().over(Window.partitionBy("period").orderBy(F.desc("seq")))
    latest = entries.withColumn("_nth", nth).filter("_nth = 1")
    columns = [c for c in stored.columns if c != period]
    found = stored.groupBy(F.col(period).cast("string").alias("_period")).agg(
        F.count(F.lit(1)).alias("rows_stored"), row_digest(columns).alias("_digest")
    )
    both = latest.join(found, F.col("period").eqNullSafe(F.col("_period")), "left")
    rows = F.coalesce("rows_stored", F.lit(0))
    agrees = (F.col("rows_after") == rows) & F.coalesce("digest", F.lit(0)).eqNullSafe(F.coalesce("_digest", F.lit(0)))
    return both.select("period", "run", "state", "rows_before", "rows_after", "rows_rejected", rows.alias("rows_stored"), agrees.alias("agrees"))
