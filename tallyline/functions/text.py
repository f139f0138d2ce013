"""Text helpers with Oracle's NULL rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def join_text(*parts: Column | str) -> Column:
    """Concatenate, treating NULL as empty text (plain strings are literals)."""
    return F.concat(
        *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    )


def prefix_before(text: Column, separator: str) -> Column:
    """Text before the first separator; NULL when there is none or nothing precedes it."""
    head = F.substring_index(text, separator, 1)
    return F.when(F.contains(text, F.lit(separator)) & (head != ""), head)


def order_from_job(job_name: Column, default: str) -> Column:
    """Order number carried at the front of a job name, e.g. ``12345-3-X``."""
    return F.coalesce(prefix_before(job_name, "-"), F.lit(default))


def numeric_key(text: Column) -> Column:
    """Text column used as a numeric key; text that is no number matches nothing."""
    return text.try_cast("bigint")


def value_map(value: Column, mapping: dict[str, str], otherwise: Column | None = None) -> Column:
    """Null-safe value map; without ``otherwise`` an unmapped value gives NULL."""
    out = None
    for old, new in mapping.items():
        hit = value.eqNullSafe(F.lit(old))
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return out if otherwise is None else out.otherwise(otherwise)
