"""Lookups: active codes, single-value lookups with a cardinality check, parents by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.operators.joins import spread_join


def active_lookup(lookups: DataFrame, lookup_type: str) -> DataFrame:
    """Codes of one type that are enabled and have no end date."""
    return lookups.filter(
        (F.col("lookup_type") == lookup_type)
        & (F.col("enabled_flag") == "Y")
        & F.col("end_date_active").isNull()
    ).select("lookup_code", "meaning", "description", "tag")


def decode_column(
    df: DataFrame, lookups: DataFrame, lookup_type: str, code: str, out: str, value: str = "meaning"
) -> DataFrame:
    """Add the meaning of a code column (left join; unknown codes give NULL)."""
    codes = active_lookup(lookups, lookup_type).select(
        F.col("lookup_code").alias(code), F.col(value).alias(out)
    )
    return df.join(codes, code, "left")


def several_values(value: Column, among: Column | None = None) -> Column:
    """Aggregate test: more than one distinct value (NULL counts as one) among the chosen rows."""
    chosen = F.lit(True) if among is None else among
    shown = F.when(chosen, value)
    mixed_null = (F.count(shown) > 0) & (F.count(shown) < F.count(F.when(chosen, 1)))
    return F.coalesce(F.min(shown) != F.max(shown), F.lit(False)) | mixed_null


def one_row_per_key(
    inner: DataFrame, keys: Sequence[str], values: Sequence[str], distinct: bool = False
) -> DataFrame:
    """Collapse the inner side of a lookup to one row per key, noting whether it was ambiguous.

    ``_ambiguous``: more than one row or, with ``distinct``, more than one distinct value. The
    aggregate combines map-side, so a key with many rows stays cheap.
    """
    if distinct:
        ambiguous = F.lit(False)
        for v in values:
            ambiguous = ambiguous | several_values(F.col(v))
    else:
        ambiguous = F.count(F.lit(1)) > 1
    return inner.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values], ambiguous.alias("_ambiguous"))


def checked(value: Column, ambiguous: Column, what: str, keys: Sequence[str]) -> Column:
    """The looked-up value; fails the job when a row asked for an ambiguous key."""
    key_text = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit(f"lookup of {what} returns more than one row for "), key_text)
    return F.when(ambiguous, F.raise_error(message)).otherwise(value)


def scalar_lookup(
    left: DataFrame,
    inner: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    spread_by: Sequence[str],
    distinct: bool = False,
    hot: Sequence[object] = (),
) -> DataFrame:
    """Left join that fetches at most one row per key and fails when a *matched* key has more.

    An ambiguous key that no left row asks for is harmless.
    """
    found = spread_join(
        left, one_row_per_key(inner, keys, values, distinct), keys, spread_by, hot=hot
    )
    return found.withColumns(
        {v: checked(F.col(v), F.col("_ambiguous"), v, keys) for v in values}
    ).drop("_ambiguous")
