"""Writing results: whole tables, single periods, views.

In a folder, a period is replaced by Spark's dynamic partition overwrite: the new rows are
written to a staging folder beside the table and take the old ones' place when the job
commits, so a job that fails, or reads the table it writes, leaves the old period in place
until then. On stores without atomic renames the commit itself is not atomic.

In a catalog, tables and periods are replaced by metadata: the new rows are written to a
folder of their own, and then the table's or the partition's location is set to it. Until
that one change readers see all old rows, after it all new ones, and a write that fails
leaves everything as it was.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# fixed value: characters that are escaped in the names of partition folders
ESCAPED = "\"#%'*/:=?\\\x7f{[]^"
#: Spark setting: a query that has ended gives its shuffle files up, without waiting for a garbage collection of the driver.
GIVE_UP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def publish_view(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Register a result under a name, with its column contract."""
    out = df.select(*columns)
    out.createOrReplaceTempView(name)
    return out


def replace_table(df: DataFrame, table: str, provider: str = "delta") -> None:
    """Create or replace a table; ``parquet`` where the delta provider is not installed."""
    if provider == "delta":
        df.writeTo(table).using("delta").createOrReplace()
    else:
        df.write.format(provider).mode("overwrite").saveAsTable(table)


def append_rows(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Append with an explicit column list: order and names are the table's contract."""
    df.select(*columns).write.insertInto(table)


def write_history(df: DataFrame, path: str, period: str) -> None:
    """First load: every period in one write, one directory per period.

    The rebalance step groups rows by period and splits a period that is too large for one
    task, so neither many small files nor one giant writer results.
    """
    df.hint("rebalance", period).write.partitionBy(period).mode("overwrite").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_at_end(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


def new_folder(root: str) -> str:
    """A folder name nobody else uses."""
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster shares; a temporary one only where none is named, as in tests."""
    return new_folder(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tallyline-"))


@contextlib.contextmanager
def shuffles_given_up(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files; the setting is then what it was."""
    before = spark.conf.get(GIVE_UP_SHUFFLES, None)
    spark.conf.set(GIVE_UP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(GIVE_UP_SHUFFLES)
        else:
            spark.conf.set(GIVE_UP_SHUFFLES, before)


class Stages:
    """Steps of a job that are written one by one, so that the disk never holds the shuffles of all.

    Called with a table, it is written below the folder that the cluster shares, and read again. ``made_of`` is a table
    kept before that nothing else needs: it goes once the new one is there. The others go when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._kept: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, made_of: DataFrame | None = None) -> DataFrame:
        path = shared_folder(self._spark)
        with shuffles_given_up(self._spark):
            df.write.option("compression", "zstd").parquet(path)
        remove_at_end(self._spark, path)
        for frame, old in self._kept:
            if frame is made_of:
                remove(self._spark, old)
        written = self._spark.read.schema(df.schema).parquet(path)
        self._kept = [pair for pair in self._kept if pair[0] is not made_of] + [(written, path)]
        return written


def swap_table(df: DataFrame, table: str, root: str, provider: str = "parquet") -> str:
    """Replace all rows of a catalog table: write beside the old ones, then set the table's location.

    Returns the folder that holds the rows now. The old one stays until ``drop_unused``, for
    readers that are still on it. The columns must be those of the table.
    """
    spark, folder = df.sparkSession, new_folder(root)
    if spark.catalog.tableExists(table):
        df = df.select(*spark.table(table).columns)
    df.write.format(provider).save(folder)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {provider} LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return folder


def _partition(period: str, value: object) -> str:
    return f"(`{period}` = NULL)" if value is None else f"(`{period}` = '{value}')"


def swap_partitions(df: DataFrame, table: str, period: str, values: Sequence[object], root: str) -> None:
    """Replace periods of a catalog table by metadata; the other periods are not touched.

    All periods are written in one job, to a folder of their own. A period without new rows is
    dropped from the catalog. Each period is wholly old or wholly new at any moment.
    """
    spark, folder = df.sparkSession, new_folder(root)
    wanted = df.filter(F.col(period).isin([v for v in values if v is not None]) | (F.col(period).isNull() & F.lit(None in values)))
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{period}`) LOCATION '{root.rstrip('/')}/table'")
    rest = [c for c in spark.table(table).columns if c != period]
    wanted.select(*rest, period).hint("rebalance", period).write.partitionBy(period).parquet(folder)
    for value in values:
        where, at = _partition(period, value), partition_folder(folder, period, value)
        if not exists(spark, at):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION {where}")
            continue
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION {where} LOCATION '{at}'")
        spark.sql(f"ALTER TABLE {table} PARTITION {where} SET LOCATION '{at}'")
    spark.catalog.refreshTable(table)


def partition_folder(path: str, period: str, value: object) -> str:
    """Folder of one partition value, named the way Hive and Spark name it."""
    if value is None or value == "":
        return f"{path}/{period}=__HIVE_DEFAULT_PARTITION__"
    text = "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in str(value))
    return f"{path}/{period}={text}"


def clear_period(df: DataFrame, path: str, period: str, value: object) -> None:
    """Leave a period of a partitioned parquet folder without rows; ``df`` gives the columns."""
    nothing = df.sparkSession.createDataFrame([], df.drop(period).schema)
    nothing.write.mode("overwrite").parquet(partition_folder(path, period, value))


def replace_periods(df: DataFrame, path: str, period: str, rows_of: Mapping[object, int]) -> None:
    """Swap periods of a partitioned parquet folder in one job; no other period is touched.

    ``rows_of`` tells how many rows each period gets: a dynamic overwrite reaches only periods
    that get rows, so those without are cleared one by one, if they are there.
    """
    spark = df.sparkSession
    if any(rows_of.values()):
        spread = df.hint("rebalance", period)
        spread.write.partitionBy(period).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for value, n in rows_of.items():
        if not n and exists(spark, partition_folder(path, period, value)):
            clear_period(df, path, period, value)


def replace_period(df: DataFrame, path: str, period: str, value: object) -> None:
    """Swap one period of a partitioned parquet table; an empty result clears the period, no other period is touched."""
    rows = df.drop(period)
    written = Observation()
    stamped = rows.withColumn(period, F.lit(value) if value is not None else F.lit(None).cast("string"))
    observed = stamped.observe(written, F.count(F.lit(1)).alias("n"))
    observed.write.partitionBy(period).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    if not written.get["n"]:
        # a dynamic overwrite touches only periods that get rows
        clear_period(df, path, period, value)


def reliable_checkpoint(df: DataFrame, spark: SparkSession, fallback: str | None = None) -> DataFrame:
    """Cut lineage in the shared folder the cluster names; executors may come and go.

    ``fallback`` is used only where ``spark.checkpoint.dir`` is unset, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if fallback is None:
            raise ValueError("spark.checkpoint.dir is not set")
        folder = fallback
    spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
