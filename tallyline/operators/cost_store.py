"""Transaction costs as a stored state that increments are added to.

A row of the state has, per transaction, the sums and the numbers of its account rows: of the primary
and of the fallback line type, whole and per cost element, in whole ten-thousandths. Adding and
taking away account rows adds and subtracts, so increments may come in any order and in any
number of parts; a changed account row is taken away as it was and added as it is. The costs
themselves, with the fallback rule, follow from the state whenever they are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.money import from_units, to_units

FIGURES: dict[str, int | None] = {"om_cogs": None, **fixed.COST_ELEMENTS}
SIDES = {"primary": fixed.PRIMARY_COST_LINE_TYPE, "fallback": fixed.FALLBACK_COST_LINE_TYPE}
STATE = [f"{kind}_{side}_{figure}" for figure in FIGURES for side in SIDES for kind in ("sum", "n")]


def increment(accounts: DataFrame, month: str, sign: str | None = None) -> DataFrame:
    """State rows of some account rows: month, transaction_id and the state's columns.

    ``month`` names the column with the transaction's month. ``sign`` names a column with 1 for an
    account row that is added and -1 for one that is taken away; without it all are added. One
    pass, combined before the shuffle.
    """
    times = F.lit(1) if sign is None else F.col(sign)
    rows = accounts.filter(F.col("accounting_line_type").isin(*SIDES.values())).select(
        F.col(month).alias("month"), "transaction_id", F.col("accounting_line_type").alias("side"), F.col("cost_element_id").alias("element"),
        (to_units(F.col("base_transaction_value")) * times).alias("units"), times.cast("bigint").alias("times"),
    )

    def chosen(figure: str, side: str) -> Column:
        own = F.col("side") == SIDES[side]
        return own if FIGURES[figure] is None else own & (F.col("element") == FIGURES[figure])

    out = []
    for figure in FIGURES:
        for side in SIDES:
            mine = chosen(figure, side) & F.col("units").isNotNull()
            out.append(F.sum(F.when(mine, F.col("units")).otherwise(0)).alias(f"sum_{side}_{figure}"))
            out.append(F.sum(F.when(mine, F.col("times")).otherwise(0)).alias(f"n_{side}_{figure}"))
    return rows.groupBy("month", "transaction_id").agg(*out)


def added(state: DataFrame, more: DataFrame) -> DataFrame:
    """The state after an increment; transactions that no account row is left of go."""
    both = state.select("month", "transaction_id", *STATE).unionByName(more.select("month", "transaction_id", *STATE))
    sums = both.groupBy("month", "transaction_id").agg(*[F.sum(c).alias(c) for c in STATE])
    left = F.greatest(*[F.abs(c) for c in STATE if c.startswith("n_")])
    return sums.filter(left > 0)


def costs(state: DataFrame) -> DataFrame:
    """What `cost_by_transaction` gives for the account rows that the state stands for, of transactions with a value."""

    def figure(name: str) -> Column:
        parts = [F.when(F.col(f"n_{side}_{name}") != 0, F.col(f"sum_{side}_{name}")) for side in SIDES]
        return from_units(F.coalesce(*parts)).alias(name)

    return state.select("transaction_id", *[figure(name) for name in FIGURES])
