"""Written intermediate tables: lineage is cut in the folder that all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

KEY = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is set only where none is named (local tests)."""
    named = spark.conf.get(KEY, None)
    if not named:
        application = spark.sparkContext.applicationId
        named = _own.setdefault(application, "") or tempfile.mkdtemp(prefix="tallyline-shared-")
        _own[application] = named
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: later jobs neither recompute it nor need the executors that made it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_not(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """A narrow join side, broadcast if it is counted and found small; otherwise left to a shuffle join, with the same result."""
    return F.broadcast(df) if df.count() <= most_rows else df


def bounded_side(df: DataFrame, most_bytes: int = 64 << 20) -> DataFrame:
    """A written join side, broadcast if its rows and strings are summed up and stay below `most_bytes`; otherwise left to a shuffle
    join, with the same result."""
    wide = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    row = sum(wide, F.lit(16 * (1 + len(df.columns))))
    return F.broadcast(df) if (df.agg(F.sum(row.cast("long"))).head()[0] or 0) <= most_bytes else df


def give_back() -> None:
    """Return memory that this process has freed to the system: Python workers are kept for later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def package_for_workers(spark: SparkSession) -> None:
    """Python workers import this package from where the driver has it, unless it is installed there anyway."""
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, root) if x)
