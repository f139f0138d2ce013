"""Filter bounds that come from a table and still reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType


def scan_bounds(df: DataFrame, first: Column, after: Column, kind: DataType) -> tuple[Column, Column]:
    """Smallest ``first`` and largest ``after`` of a frame, as scalar subqueries of a column's type.

    A bound reaches the scan only as a bare scalar subquery: hence the cast inside, and hence a
    minimum and a top-1 instead of two aggregates, which the optimizer would merge into one.
    """
    low = df.agg(F.min(first.cast(kind)).alias("bound")).scalar()
    high = df.select(after.cast(kind).alias("bound")).orderBy(F.desc("bound")).limit(1).scalar()
    return low, high
