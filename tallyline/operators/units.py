"""Unit-of-measure rates from a conversion table.

The table (``inventory_item_id, from_uom, to_uom, rate``) replaces a per-row database
function. Precedence: the item's own rate, the general rate (no item), 1 for equal units,
else NULL. `with_converted_rate` goes on where that gives nothing: the reciprocal of a rate
the other way round, then two steps through a base unit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyline.operators.joins import NEW, renamed, same_key, spread_join

RATE = "decimal(10,5)"
#: Reciprocals and products of rates, before they are rounded to a rate.
STEP = "decimal(28,14)"


def general_rates(rates: DataFrame) -> DataFrame:
    """Rates that hold for every item: at most one row per pair of units.

    Few keys, each of them hot on the fact side: joins broadcast them. Planned otherwise, the facts would first be
    shuffled by a handful of keys, as the estimated size is that of the whole table of rates.
    """
    return (
        rates.filter(F.col("inventory_item_id").isNull())
        .groupBy("from_uom", "to_uom")
        .agg(F.max("rate").alias("general_rate"))
    )


def with_unit_rate(
    df: DataFrame,
    rates: DataFrame,
    out: str,
    *,
    item: str,
    from_uom: str,
    to_uom: str | None = None,
    to_literal: str | None = None,
    spread_by: Sequence[str] = (),
    kind: str = RATE,
) -> DataFrame:
    """Add the rate from one unit to another (a column, or one fixed unit).

    ``spread_by`` names what rows without an item are spread by.
    """
    target = F.lit(to_literal) if to_uom is None else F.col(to_uom)
    if to_uom is None:
        rates = rates.filter(F.col("to_uom") == to_literal)
    own = rates.filter(F.col("inventory_item_id").isNotNull()).select(
        F.col("inventory_item_id").alias("_item"),
        F.col("from_uom").alias("_from"),
        F.col("to_uom").alias("_to"),
        F.col("rate").alias("own_rate"),
    )
    general = F.broadcast(general_rates(rates).withColumnsRenamed({"from_uom": "_from", "to_uom": "_to"}))
    keyed = df.withColumns({"_item": F.col(item), "_from": F.col(from_uom), "_to": target})
    same = F.when(F.col("_from") == F.col("_to"), F.lit(1).cast(kind))
    key = ["_item", "_from", "_to"]
    with_own = spread_join(keyed, own, key, spread_by) if spread_by else keyed.join(own, key, "left")
    return (
        with_own.join(general, ["_from", "_to"], "left")
        .withColumn(out, F.coalesce("own_rate", "general_rate", same).cast(kind))
        .drop("_item", "_from", "_to", "own_rate", "general_rate")
    )


def with_rates_list(items: DataFrame, rates: DataFrame, out: str, *, item: str) -> DataFrame:
    """Add all own rates of an item, as a list of (from, to, rate): one join for all units; see `with_rate_of_item`."""
    own = (
        rates.filter(F.col("inventory_item_id").isNotNull())
        .groupBy(F.col("inventory_item_id").alias("_item"))
        .agg(F.collect_list(F.struct("from_uom", "to_uom", "rate")).alias(out))
    )
    return items.withColumn("_item", F.col(item)).join(own, "_item", "left").drop("_item")


def with_own_rates(items: DataFrame, rates: DataFrame, out: str, *, item: str, to_uom: str) -> DataFrame:
    """Add the own rates of an item to one of its units, as a list; see `with_rate_of_item`."""
    listed = with_rates_list(items, rates, out, item=item)
    return listed.withColumn(out, F.filter(out, lambda r: r["to_uom"] == F.col(to_uom)))


def with_rate_of_item(
    df: DataFrame, rates: DataFrame, out: str, *, own: str, from_uom: str, to_uom: str | None = None,
    to_literal: str | None = None, kind: str = RATE,
) -> DataFrame:
    """`with_unit_rate` for rows that already met their item and its ``own`` rates: they are not joined by item again.

    A rate that is stated more than once gives a row each, as a join does. The list stays.
    """
    general = F.broadcast(general_rates(rates).withColumnsRenamed({"from_uom": "_from", "to_uom": "_to"}))
    target = F.lit(to_literal) if to_uom is None else F.col(to_uom)
    stated = F.filter(own, lambda r: (r["from_uom"] == F.col(from_uom)) & (r["to_uom"] == target))
    keyed = df.withColumns({"_from": F.col(from_uom), "_to": target, "_own": F.explode_outer(stated)})
    same = F.when(F.col("_from") == F.col("_to"), F.lit(1).cast(kind))
    return (
        keyed.join(general, ["_from", "_to"], "left")
        .withColumn(out, F.coalesce("_own.rate", "general_rate", same).cast(kind))
        .drop("_from", "_to", "_own", "general_rate")
    )


def both_ways(rates: DataFrame) -> DataFrame:
    """The rates and their reciprocals; a rate that is stated holds, whatever its counterpart says. A rate of 0 has no reciprocal."""
    keys = ["inventory_item_id", "from_uom", "to_uom"]
    stated = rates.select(*keys, F.col("rate").cast(STEP).alias("rate"))
    one = F.lit(1).cast("decimal(10,0)")
    turned = stated.filter("rate <> 0").select(
        "inventory_item_id", F.col("to_uom").alias("from_uom"), F.col("from_uom").alias("to_uom"), (one / F.col("rate")).cast(STEP).alias("rate")
    )
    known = renamed(stated.select(*keys).distinct())
    missing = turned.groupBy(*keys).agg(F.max("rate").alias("rate")).join(known, same_key(keys), "left_anti")
    return stated.unionByName(missing)


def with_converted_rate(
    df: DataFrame, rates: DataFrame, out: str, *, item: str, from_uom: str, to_uom: str, base: str, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Add the rate between two units, if need be by a reciprocal or through the base unit.

    What `with_unit_rate` finds is kept. Else: the item's or the general rate turned round; else from
    the unit to the base unit and on, each step the item's own if there is one. There are two steps
    at most, so a cycle of rates is never walked; `rate_conflicts` tells cycles that do not lead
    back to 1.
    """
    edges = both_ways(rates)
    named = {"item": item, "spread_by": spread_by}
    found = with_unit_rate(df, rates, "_stated", from_uom=from_uom, to_uom=to_uom, **named)
    found = with_unit_rate(found, edges, "_one", from_uom=from_uom, to_uom=to_uom, kind=STEP, **named)
    ends = {"_start": F.col(from_uom), "_middle": F.lit(base), "_end": F.col(to_uom)}
    found = found.withColumns({k: F.when(F.col("_one").isNull(), v) for k, v in ends.items()})
    found = with_unit_rate(found, edges, "_up", from_uom="_start", to_uom="_middle", kind=STEP, **named)
    found = with_unit_rate(found, edges, "_down", from_uom="_middle", to_uom="_end", kind=STEP, **named)
    steps = (F.col("_up").cast("double") * F.col("_down").cast("double")).cast(RATE)
    rate = F.coalesce("_stated", F.col("_one").cast(RATE), steps)
    return found.withColumn(out, rate).select(*df.columns, out)


def rate_conflicts(rates: DataFrame, base: str, tolerance: float = 0.001) -> DataFrame:
    """Stated rates that another way between the same units contradicts: cycles of two or three rates whose product is not 1.

    (inventory_item_id, from_uom, to_uom, rate, other_rate, way); the other way is a rate turned round, or goes through the base unit.
    """
    keys = ["inventory_item_id", "from_uom", "to_uom"]
    stated = rates.select(*keys, F.col("rate").cast("double").alias("rate"))
    edges = both_ways(rates).withColumn("rate", F.col("rate").cast("double"))

    def meet(rows: DataFrame, other: DataFrame, on: Sequence[str], rate: str) -> DataFrame:
        side = renamed(other.select(*on, F.col("rate").alias("rate")))
        return rows.join(side, same_key(on)).select(*rows.columns, F.col(NEW + "rate").alias(rate))

    back = stated.filter("rate <> 0").select("inventory_item_id", F.col("to_uom").alias("from_uom"), F.col("from_uom").alias("to_uom"), "rate")
    turned = meet(stated, back, keys, "_rate").withColumns({"other_rate": 1 / F.col("_rate"), "way": F.lit("turned round")})
    inner = stated.filter((F.col("from_uom") != base) & (F.col("to_uom") != base))
    up = meet(inner, edges.filter(F.col("to_uom") == base), ["inventory_item_id", "from_uom"], "_up")
    both = meet(up, edges.filter(F.col("from_uom") == base), ["inventory_item_id", "to_uom"], "_down")
    through = both.withColumns({"other_rate": F.col("_up") * F.col("_down"), "way": F.lit("through the base unit")})
    names = [*keys, "rate", "other_rate", "way"]
    told = turned.select(*names).unionByName(through.select(*names))
    return told.filter(F.abs(F.col("rate") - F.col("other_rate")) > tolerance * F.greatest(F.abs("rate"), F.abs("other_rate")))
