"""Exact money and quantity arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"
WIDE = "decimal(28,4)"


def to_units(amount: Column) -> Column:
    """Money as whole ten-thousandths; too large an amount fails, it does not wrap (ANSI)."""
    return (amount.cast(MONEY) * 10000).cast("bigint")


def from_units(units: Column) -> Column:
    return (units.cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast(WIDE)


def cents(total: Column) -> Column:
    """Round to cents, half away from zero, in decimal."""
    return F.round(total, 2).cast(MONEY)


def gross_profit(revenue: Column, cost: Column) -> Column:
    return (revenue - cost).cast(MONEY)


def gross_profit_percent(revenue: Column, cost: Column) -> Column:
    """Margin in percent; 0 when revenue is 0 or missing, NULL when only the cost is."""
    return (
        F.when(revenue != 0, F.round((revenue - cost) / revenue * 100, 2))
        .otherwise(F.lit(0))
        .cast("decimal(18,2)")
    )


def split_share(amount: Column, percent: Column) -> Column:
    """A customer's share of an amount, given as a percentage."""
    return (
        amount.cast(MONEY) * percent.cast("decimal(9,4)") * F.lit("0.01").cast("decimal(3,2)")
    ).cast("decimal(28,10)")
