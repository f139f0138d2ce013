"""Transaction cost with a fallback line type, whole and per cost element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.money import from_units, to_units

COST_COLUMNS = ("om_cogs", *fixed.COST_ELEMENTS)


def cost_by_transaction(accounts: DataFrame) -> DataFrame:
    """One row per transaction: total and element costs; see `cost_units_by_transaction`."""
    units = cost_units_by_transaction(accounts)
    return units.select("transaction_id", *[from_units(F.col(c)).alias(c) for c in COST_COLUMNS])


def cost_units_by_transaction(accounts: DataFrame) -> DataFrame:
    """One row per transaction: total and element costs in whole ten-thousandths.

    Each figure is the sum over the primary accounting line type or, if there is none, over
    the fallback type. All twelve sums come from one pass with map-side combine, and are added
    up in whole ten-thousandths: exact like the decimal, but in registers instead of objects.
    """
    primary, fallback = fixed.PRIMARY_COST_LINE_TYPE, fixed.FALLBACK_COST_LINE_TYPE
    values = accounts.filter(F.col("accounting_line_type").isin(primary, fallback)).select(
        "transaction_id",
        (F.col("accounting_line_type") == primary).alias("primary"),
        F.col("cost_element_id").alias("element"),
        to_units(F.col("base_transaction_value")).alias("units"),
    )

    def figure(line_type: Column, element: int | None) -> Column:
        chosen = line_type if element is None else line_type & (F.col("element") == element)
        return F.sum(F.when(chosen, F.col("units")))

    first, second = F.col("primary"), ~F.col("primary")
    figures = [
        F.coalesce(figure(first, number), figure(second, number)).alias(name)
        for name, number in {"om_cogs": None, **fixed.COST_ELEMENTS}.items()
    ]
    return values.groupBy("transaction_id").agg(*figures)
