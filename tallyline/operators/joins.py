"""Joins that hold up when one key carries a large share of the rows.

Two dangers are known before a job runs and are handled here: NULL keys of an outer join
(all of them hash to one partition although none can match) and default keys such as the
order number given to jobs without one. Hot keys nobody knows in advance are split at run
time by adaptive execution, which works for the inner and left joins used throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

SPREAD = 64


def _no_salt(key: str) -> Column:
    # 0, but no constant: the optimizer would drop a constant salt from the join's keys
    return F.pmod(F.xxhash64(key), F.lit(1).cast("bigint"))


def unsalted(right: DataFrame, on: str) -> DataFrame:
    """Rows with the salt ``_salt`` that `spread_join` gives its right side: what is grouped or joined by the key and it lies ready."""
    return right.withColumn("_salt", _no_salt(on))


def laid_for_join(right: DataFrame, on: str) -> DataFrame:
    """Rows shuffled by a key the way `spread_join` wants its right side, with the salt ``_salt``.

    What is grouped by the key, the salt and more is then neither shuffled for that nor for the join.
    """
    return unsalted(right, on).repartition(on, "_salt")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    hot: Sequence[object] = (),
    spread: int = SPREAD,
    then: Sequence[DataFrame] = (),
) -> DataFrame:
    """Equi-join on same-named columns, with NULL and known hot keys spread over partitions.

    Left rows whose first key is NULL match nothing: their salt is a whole hash of
    ``spread_by``, so they go to as many tasks as there are. Those whose key is in ``hot`` get
    one of ``spread`` salts, and right rows with such a key are copied once per salt; all
    others keep salt 0. Same rows as a plain join: a left row meets at most one copy.
    ``then``: frames that are left joined by the same columns afterwards, without shuffling the rows
    again; not with ``hot`` keys. A right side that has a ``_salt`` (see `unsalted`) keeps it; not with ``hot`` keys.
    """
    if hot and (then or "_salt" in right.columns):
        raise ValueError("rows with hot keys meet one frame without a salt")
    key = F.col(on[0])
    whole = F.xxhash64(*spread_by)
    none = F.lit(0).cast("bigint")
    zero = _no_salt(on[0])
    salt = F.when(key.isNull(), whole)
    if hot:
        is_hot = key.isin(list(hot))
        salt = salt.when(is_hot, F.pmod(whole, F.lit(spread).cast("bigint")))
        copies = F.when(is_hot, F.sequence(none, F.lit(spread - 1).cast("bigint"))).otherwise(F.array(none))
        salted_right = right.withColumn("_salt", F.explode(copies))
    else:
        salted_right = right if "_salt" in right.columns else unsalted(right, on[0])
    salted_left = left.withColumn("_salt", salt.otherwise(none))
    joined = salted_left.join(salted_right, [*on, "_salt"], how)
    # left joins by the same key: the rows lie where the first join left them
    for other in then:
        joined = joined.join(other.withColumn("_salt", zero), [*on, "_salt"], "left")
    return joined.drop("_salt")


NEW = "_new_"


def renamed(df: DataFrame) -> DataFrame:
    """Prefix every column, so that a join with a frame of the same origin stays unambiguous."""
    return df.select(*[F.col(c).alias(NEW + c) for c in df.columns])


def same_key(keys: Sequence[str], null_safe: bool = True) -> Column:
    """Join condition between plain and prefixed key columns; NULL keys match if ``null_safe``."""
    tests = [
        F.col(k).eqNullSafe(F.col(NEW + k)) if null_safe else F.col(k) == F.col(NEW + k) for k in keys
    ]
    return reduce(and_, tests)
