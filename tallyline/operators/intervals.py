"""Joins of moments with the intervals they lie in, as equi joins on bins of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BIN_DAYS = 32


def _bin(moment: Column, days: int) -> Column:
    return F.floor(F.unix_date(moment.cast("date")) / F.lit(days))


def interval_join(
    facts: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, first: str, after: str, *, bin_days: int = BIN_DAYS
) -> DataFrame:
    """Each fact with each interval of its keys that it lies in: ``first <= at < after``.

    An interval stands in every bin it touches, a fact in one, so a pair meets once; the exact
    bounds, dates or timestamps, are the rest condition. Bins are wide: an interval that is left
    open by a closing date in a far year is thousands of rows, not millions. Intervals without
    one of their bounds, or that end before they start, have no facts.
    """
    bins = F.sequence(_bin(F.col(first), bin_days), _bin(F.col(after), bin_days))
    binned = intervals.filter(F.col(after) > F.col(first)).withColumn("_bin", F.explode(bins))
    met = facts.withColumn("_bin", _bin(F.col(at), bin_days)).join(binned, [*keys, "_bin"])
    return met.filter((F.col(at) >= F.col(first)) & (F.col(at) < F.col(after))).drop("_bin")
