"""Row tests shared by the jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def active_on(end_date: Column, as_of: dt.date, *, inclusive: bool = True) -> Column:
    """No end date, or an end date not before (``inclusive``) / after the day."""
    day = F.lit(as_of)
    still = end_date >= day if inclusive else end_date > day
    return F.coalesce(still, F.lit(True))


def not_deleted(flag: Column) -> Column:
    """Soft-delete flag is N or missing."""
    return F.coalesce(flag, F.lit("N")) == "N"


def strictly_not_deleted(flag: Column) -> Column:
    """Soft-delete flag is N; a missing flag does not pass."""
    return flag == "N"
