"""Named input tables.

Jobs ask a ``Tables`` object for the relations they read, by table name. Where they come
from (a catalog database, a directory of parquet files, test adapters) is the caller's
choice, and nothing is read until a job's result is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Table name → DataFrame; each name is resolved once."""

    def __init__(self, resolve: Callable[[str], DataFrame]):
        self._resolve = resolve
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._resolve(name)
        return self._known[name]

    def with_tables(self, **replaced: DataFrame) -> Tables:
        """Same tables, some replaced."""
        return Tables(lambda name: replaced[name] if name in replaced else self[name])

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Tables:
        return cls(lambda name: spark.read.parquet(f"{root}/{name}"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, prefix: str = "") -> Tables:
        """Tables of a catalog database, e.g. a lakehouse layer with prefixed names."""
        return cls(lambda name: spark.table(f"{database}.{prefix}{name}"))
