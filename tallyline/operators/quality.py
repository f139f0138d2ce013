"""Load checks: quarantine of bad rows and row-count audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T


def flag_errors(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``load_error``: the names of the rules a row breaks, NULL for a good row.

    A rule is the condition for being *good*; an unknown outcome breaks it.
    """
    broken = [
        F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in rules.items()
    ]
    text = F.concat_ws(", ", *broken)
    return df.withColumn("load_error", F.when(text != "", text))


def declared(schema: T.StructType, required: Iterable[str] = (), lengths: Mapping[str, int] | None = None) -> T.StructType:
    """A schema with NOT NULL columns and text lengths declared on top of its types."""
    needed, limits = set(required), lengths or {}
    fields = [
        T.StructField(f.name, T.VarcharType(limits[f.name]) if f.name in limits else f.dataType, f.name not in needed)
        for f in schema
    ]
    return T.StructType(fields)


def misfit(field: T.StructField) -> tuple[Column, Column]:
    """(the column's value in its declared type, why it does not fit or NULL)."""
    value, kind = F.col(field.name), field.dataType
    if isinstance(kind, (T.VarcharType, T.CharType)):
        stored = value.cast("string")
        size = F.length(stored)
        text = F.concat(F.lit(f"{field.name} has "), size.cast("string"), F.lit(f" of {kind.length} characters"))
        cause = F.when(size > kind.length, text)
    else:
        stored = value.try_cast(kind)
        cause = F.when(value.isNotNull() & stored.isNull(), F.lit(f"{field.name} is no {kind.simpleString()}"))
    if not field.nullable:
        cause = F.coalesce(F.when(value.isNull(), F.lit(f"{field.name} is missing")), cause)
    return stored.alias(field.name), cause


def flag_misfits(df: DataFrame, schema: T.StructType, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows in a declared schema, with ``load_error`` and ``load_row``.

    ``load_error`` tells everything that keeps a row out, NULL for a good row: each column whose
    value is missing, too long, out of range or of another kind, and each broken rule (a rule is
    the condition for being good). ``load_row`` has the bad row as it came, as JSON, since its
    values may not fit the schema. Extra columns are not kept. One pass, no row stops the load.
    """
    told = [misfit(f) for f in schema]
    broken = [F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in (rules or {}).items()]
    error = F.concat_ws(", ", *[cause for _, cause in told], *broken)
    flagged = df.withColumn("load_error", F.when(error != "", error))
    row = F.when(F.col("load_error").isNotNull(), F.to_json(F.struct(*[F.col(f.name) for f in schema]), {"ignoreNullFields": "false"}))
    return flagged.select(*[value for value, _ in told], "load_error", row.alias("load_row"))


def row_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their errors); one bad row does not stop a load."""
    flagged = flag_errors(df, rules)
    good = flagged.filter(F.col("load_error").isNull()).drop("load_error")
    return good, flagged.filter(F.col("load_error").isNotNull())


def observed_load(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """Flagged rows plus counts taken while they are written.

    ``observation.get`` gives ``loaded`` and ``rejected`` after the write; the return code of
    a load is 2 when ``rejected`` is not 0.
    """
    seen = Observation()
    flagged = flag_errors(df, rules)
    rejected = F.count("load_error")
    return flagged.observe(
        seen, (F.count(F.lit(1)) - rejected).alias("loaded"), rejected.alias("rejected")
    ), seen


def load_audit(before: DataFrame, after: DataFrame, period: Column) -> DataFrame:
    """Row counts per period before and after a load."""
    one, none = F.lit(1), F.lit(0)
    sides = before.select(period.alias("period"), one.alias("b"), none.alias("a")).unionByName(
        after.select(period.alias("period"), none.alias("b"), one.alias("a"))
    )
    return sides.groupBy("period").agg(
        F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after")
    )
