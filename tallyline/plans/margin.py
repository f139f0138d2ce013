"""Order-margin detail: revenue, freight, credits, replacements and cost per invoice line.

The feed has six kinds of rows:

=====  ==========================================================================
Part1  lines whose order line was issued from stock
Part2  lines of a configured assembly: the cost of all its component order lines
Part3  returned order lines
Part4  freight lines
Part5  revenue lines without an item
Part6  item lines with neither an issue nor a return (their order line may be absent)
=====  ==========================================================================

All six are built in one pass. Each fact table is read once and brought to one row per
(invoice line, account, date, amount) or one row per order line *before* the two sides
meet, so neither many distributions nor many shipments of one line multiply rows:

* equal distribution rows of a line collapse to one row with a count. Amounts are keys of
  the detail, not sums; costs add up once per collapsed row (``times``), except in Part2,
  where the distributions already collapse within each transaction;
* costs are summed per transaction, then per order line (Part2: per model line);
* dimensions are joined last and by their primary keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.dates import in_months, instant, month_start
from tallyline.functions.money import (
    MONEY, WIDE, cents, from_units, gross_profit, gross_profit_percent,
)
from tallyline.functions.text import join_text, numeric_key
from tallyline.operators.costs import COST_COLUMNS, cost_units_by_transaction
from tallyline.operators.joins import laid_for_join, spread_join, unsalted
from tallyline.operators.lookups import checked, one_row_per_key
from tallyline.operators.units import with_rate_of_item, with_rates_list
from tallyline.sources.tables import Tables

PARTS = ("Part1", "Part2", "Part3", "Part4", "Part5", "Part6")
WITHOUT_ORDER_LINE = {"Part4", "Part5"}
Months = Sequence[dt.date] | None
#: What becomes of an intermediate table: left to the plan, or written so that its shuffles can go (`sinks.Stages`).
#: The second argument is a kept table that it is made of and nothing else needs.
Keep = Callable[[DataFrame, DataFrame | None], DataFrame]


class Attached(NamedTuple):
    """What else a detail row takes along: columns by invoice line and by order line, one row per key.

    They meet where the rows lie by that key anyhow, which spares the finished, wide detail two shuffles.
    """

    by_line: DataFrame
    by_order: DataFrame

    @property
    def line_columns(self) -> list[str]:
        return [c for c in self.by_line.columns if c != "customer_trx_line_id"]

    @property
    def order_columns(self) -> list[str]:
        return [c for c in self.by_order.columns if c != "order_line_id"]


def _distributions(t: Tables, accounts: Sequence[str], months: Months) -> DataFrame:
    """Ledger distributions of the accounts and months, with their two segments."""
    segments = t["gl_code_combinations"].filter(F.col("segment5").isin(*accounts)).select(
        "code_combination_id",
        F.col("segment2").alias("line_of_business"),
        F.col("segment5").alias("rev_gl_account"),
    )
    return (
        t["ra_cust_trx_line_gl_dist_all"]
        .filter(in_months(F.col("gl_date"), months))
        .join(segments, "code_combination_id")
    )


def collapsed_distributions(t: Tables, months: Months) -> DataFrame:
    """One row per line, account, date and amount; ``times`` says how many rows it stands for."""
    return (
        _distributions(t, fixed.ORDER_REVENUE_ACCOUNTS, months)
        .groupBy(
            "customer_trx_line_id", "customer_trx_id", "line_of_business", "rev_gl_account",
            "gl_date", F.col("acctd_amount").alias("om_rev"),
        )
        .agg(F.count(F.lit(1)).cast("decimal(9,0)").alias("times"))
    )


def freight_amount() -> Column:
    return F.when(F.col("rev_gl_account") == fixed.FREIGHT_ACCOUNT, F.col("om_rev")).otherwise(
        F.lit(0).cast(MONEY)
    )


def credit_amount() -> Column:
    """A negative amount on a positive invoiced quantity, freight excepted."""
    credited = (
        (F.col("om_rev") < 0)
        & (F.col("quantity_invoiced") > 0)
        & (F.col("rev_gl_account") != fixed.FREIGHT_ACCOUNT)
    )
    return F.when(credited, F.col("om_rev")).otherwise(F.lit(0).cast(MONEY))


def completed_invoices(t: Tables) -> DataFrame:
    return t["ra_customer_trx_all"].filter(F.col("complete_flag") == "Y").select(
        "customer_trx_id",
        F.col("trx_date").alias("invoice_date"),
        F.col("trx_number").alias("invoice_number"),
        "cust_trx_type_id",
        F.col("org_id").alias("trx_org_id"),
        # an invoice without a sold-to customer belongs to its bill-to customer
        F.coalesce("sold_to_customer_id", "bill_to_customer_id").alias("cust_account_id"),
        "bill_to_site_use_id",
        F.col("primary_salesrep_id").alias("salesrep_id"),
    )


def charged_lines(t: Tables, booked: DataFrame) -> DataFrame:
    """Collapsed distributions, and what they have met already, with their invoice line.

    ``order_key`` is the order line the invoice line points at: text in the source, NULL when
    it is no number, and NULL for lines that are never matched with an order line.
    """
    has_item = (F.col("line_type") == "LINE") & F.col("inventory_item_id").isNotNull()
    lines = t["ra_customer_trx_lines_all"].select(
        "customer_trx_line_id",
        "customer_trx_id",
        F.col("org_id").alias("line_org_id"),
        F.col("line_number").alias("invoice_line"),
        F.col("line_type").alias("inv_line_type"),
        F.col("description").alias("line_desc"),
        "inventory_item_id",
        "warehouse_id",
        F.col("interface_line_attribute1").alias("order_number"),
        F.when(has_item, numeric_key(F.col("interface_line_attribute6"))).alias("order_key"),
        "quantity_invoiced",
        F.coalesce("quantity_invoiced", "quantity_credited").alias("quantity"),
        "uom_code",
        "unit_standard_price",
        "unit_selling_price",
        "extended_amount",
    )
    # both sides meet by the line alone, by which the lines may lie already; as bounds, the invoice is no second key
    booked = booked.withColumnRenamed("customer_trx_id", "_booked_trx")
    same_invoice = (F.col("_booked_trx") >= F.col("customer_trx_id")) & (F.col("_booked_trx") <= F.col("customer_trx_id"))
    return (
        booked.join(lines, "customer_trx_line_id")
        .filter(same_invoice)
        .drop("_booked_trx")
        .withColumns({"om_freight": freight_amount(), "om_credits": credit_amount()})
    )


def invoice_lines(t: Tables, months: Months) -> DataFrame:
    """Distributions with their completed invoice and invoice line."""
    return charged_lines(t, collapsed_distributions(t, months)).join(completed_invoices(t), "customer_trx_id")


def asked_order_lines(t: Tables, months: Months) -> DataFrame:
    """Order lines that invoice lines of the given months point at, or whose model they point at.

    A refresh of a few months then joins only their order lines with transactions, and only
    those transactions with costs, instead of shuffling the whole history of both.
    """
    lines = t["ra_customer_trx_lines_all"].filter(F.col("inventory_item_id").isNotNull())
    recent = _distributions(t, fixed.ORDER_REVENUE_ACCOUNTS, months).select("customer_trx_line_id")
    keys = (
        lines.join(recent, "customer_trx_line_id", "left_semi")
        .select(numeric_key(F.col("interface_line_attribute6")).alias("_key"))
        .distinct()
    )
    orders = t["oe_order_lines_all"]
    # each line under its own number and its model's: one join finds both kinds
    under = orders.select("line_id", F.explode(F.array("line_id", "top_model_line_id")).alias("_key"))
    found = under.join(keys, "_key", "left_semi").select("line_id").distinct()
    return orders.join(found, "line_id", "left_semi")


def order_line_transactions(t: Tables, only: DataFrame | None = None) -> DataFrame:
    """One row per order line, item and plant: costs of its issues and of its returns, in whole ten-thousandths.

    ``issued`` / ``returned`` count transactions; a transaction without accounting rows counts
    but has no cost. ``only`` limits the work to some order lines.
    """
    kind = F.col("transaction_type_id")
    issue, back = kind == fixed.ORDER_ISSUE_TYPE, kind == fixed.ORDER_RETURN_TYPE
    moves = (
        t["mtl_material_transactions"]
        .filter(
            kind.isin(fixed.ORDER_ISSUE_TYPE, fixed.ORDER_RETURN_TYPE)
            & F.col("transaction_action_id").isin(*fixed.ORDER_ACTIONS)
        )
        .select(
            "transaction_id",
            F.when(issue, F.col("source_line_id")).otherwise(F.col("trx_source_line_id")).alias("line_id"),
            "inventory_item_id",
            F.col("organization_id").alias("ship_from_org_id"),
            kind,
            "new_cost",
        )
        .filter(F.col("line_id").isNotNull())
    )
    accounts = t["mtl_transaction_accounts"]
    if only is not None:
        moves = moves.join(only.select("line_id"), "line_id", "left_semi")
        accounts = accounts.join(moves.select("transaction_id"), "transaction_id", "left_semi")
    replaced = F.when(F.col("new_cost") != 0, F.col("om_cogs")).otherwise(F.lit(0).cast("bigint"))

    def costs(test: Column, prefix: str) -> list[Column]:
        figures = {**{c: F.col(c) for c in COST_COLUMNS}, "om_replacements": replaced}
        return [
            F.sum(F.when(test, value)).alias(prefix + name) for name, value in figures.items()
        ]

    return (
        moves.join(cost_units_by_transaction(accounts), "transaction_id", "left")
        .groupBy("line_id", "inventory_item_id", "ship_from_org_id")
        .agg(
            F.count(F.when(issue, 1)).alias("issued"),
            F.count(F.when(back, 1)).alias("returned"),
            *costs(issue, "issue_"),
            *costs(back, "return_"),
        )
    )


def order_sides(t: Tables, parts: Sequence[str], only: DataFrame | None = None) -> DataFrame:
    """What an order line contributes, by the key an invoice line finds it with.

    One order line may give several rows: its own issue (Part1), its share of a model's cost
    (Part2), its return (Part3), or an untouched line (Part6). A line that gives none of its
    own still gives one row without a part, so that it is told apart from an absent line.
    """
    figures = [*COST_COLUMNS, "om_replacements"]
    source = t["oe_order_lines_all"] if only is None else only
    lines = source.select(
        "line_id",
        "top_model_line_id",
        "ship_from_org_id",
        "inventory_item_id",
        "line_type_id",
        join_text(F.col("line_number"), ".", F.col("shipment_number")).alias("order_line"),
    )
    # an order line without plant or item matches no transaction and is kept
    joined = lines.join(
        order_line_transactions(t, only), ["line_id", "inventory_item_id", "ship_from_org_id"], "left"
    )
    issued = F.coalesce(F.col("issued") > 0, F.lit(False))
    returned = F.coalesce(F.col("returned") > 0, F.lit(False))
    untouched = ~issued & ~returned
    own_model = F.coalesce("line_id", F.lit(0)) == F.coalesce("top_model_line_id", F.lit(-1))

    def row(part: str | None, key: Column, source: str | None) -> Column:
        return F.struct(F.lit(part).cast("string").alias("part"), key.alias("order_key"), F.lit(source).cast("string").alias("_source"))

    rows = []
    if "Part1" in parts:
        rows.append(F.when(issued, row("Part1", F.col("line_id"), "issue")))
    if "Part2" in parts:
        assembled = issued & F.col("top_model_line_id").isNotNull()
        rows.append(F.when(assembled, row("Part2", F.col("top_model_line_id"), "issue")))
    if "Part3" in parts:
        rows.append(F.when(returned, row("Part3", F.col("line_id"), "return")))
    if "Part6" in parts:
        own_row = F.lit(False)
        if "Part1" in parts:
            own_row = own_row | issued
        if "Part3" in parts:
            own_row = own_row | returned
        rows.append(
            F.when(untouched & ~own_model, row("Part6", F.col("line_id"), None))
            .when(~own_row, row(None, F.col("line_id"), None))
        )
    # a type named in several languages repeats a row once per name
    kinds = (
        t["oe_transaction_types_tl"]
        .groupBy(F.col("transaction_type_id").alias("line_type_id"), F.col("name").alias("order_line_type"))
        .agg(F.count(F.lit(1)).alias("type_times"))
    )
    names = F.coalesce("type_times", F.lit(1).cast("bigint"))
    once = F.when(F.col("part") == "Part2", F.lit(1).cast("bigint")).otherwise(names)
    # only what a row is goes through the explode; its figures, whole numbers, are chosen afterwards
    source, none = F.col("_source"), F.lit(0).cast("bigint")
    chosen = {
        f: F.when(source == "issue", F.col(f"issue_{f}")).when(source == "return", F.col(f"return_{f}")).when(F.col("part").isNotNull(), none)
        for f in figures
    }
    sides = (
        joined.withColumn("side", F.explode(F.array_compact(F.array(*rows))))
        .select("*", "side.*")
        .select(
            F.col("ship_from_org_id").alias("plant"), "order_line", "line_type_id", "part", "order_key",
            *[value.alias(f) for f, value in chosen.items()],
        )
        .join(kinds, "line_type_id", "left")
    )
    # shuffled once, by the key the invoice lines come with
    sides = (
        laid_for_join(sides, "order_key")
        # a model's components that share line text, plant and type are one row
        .groupBy("order_key", "_salt", "part", "plant", "order_line", "order_line_type")
        .agg(*[F.sum(F.col(c) * once).alias(c) for c in COST_COLUMNS], F.sum(F.col("om_replacements") * names).alias("om_replacements"))
        .withColumn("has_order_line", F.lit(True))
    )
    if not {"Part2", "Part6"} <= set(parts):
        return sides
    return _with_absent_models(sides)


def _with_absent_models(sides: DataFrame) -> DataFrame:
    """Add a row without anything for each model that is known by its components alone.

    Every order line has a row of its own under its number (Part6 is asked for), so such a model has nothing but
    Part2. The rows lie by their key, and stay there.
    """
    of_key = Window.partitionBy("order_key", "_salt")
    own = F.coalesce(F.col("part") != "Part2", F.lit(True))
    absent = ~F.max(own).over(of_key) & (F.row_number().over(of_key.orderBy("part")) == 1)
    both = F.when(F.col("_absent"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    kept = [c for c in sides.columns if c not in ("order_key", "_salt")]
    return sides.withColumn("_absent", absent).withColumn("_present", F.explode(both)).select(
        "order_key", "_salt", *[F.when(F.col("_present"), F.col(c)).alias(c) for c in kept]
    )


def _with_names(t: Tables, rows: DataFrame) -> DataFrame:
    """Attach customer, territory, rep and type: all that an invoice is named by.

    ``rows`` are invoices or their lines; rows without one of the names go.
    """
    sites = t["hz_cust_site_uses_all"].select(
        F.col("site_use_id").alias("bill_to_site_use_id"), "cust_acct_site_id"
    ).join(t["hz_cust_acct_sites_all"].select("cust_acct_site_id", "territory"), "cust_acct_site_id")
    customers = t["hz_cust_accounts"].select("cust_account_id", "party_id", "account_number").join(
        t["hz_parties"].select("party_id", F.col("party_name").alias("customer")), "party_id"
    )
    reps = t["jtf_rs_salesreps"].select(
        "salesrep_id", F.col("org_id").alias("trx_org_id"), F.col("name").alias("sales_person")
    )
    types = t["ra_cust_trx_types_all"].select(
        "cust_trx_type_id", F.col("org_id").alias("trx_org_id"), F.col("description").alias("invoice_type")
    )
    return (
        rows.join(types, ["cust_trx_type_id", "trx_org_id"])
        .join(reps, ["salesrep_id", "trx_org_id"])
        .join(customers, "cust_account_id")
        .join(sites.drop("cust_acct_site_id"), "bill_to_site_use_id")
        # known by their names from here on
        .drop("cust_trx_type_id", "trx_org_id", "salesrep_id", "party_id", "bill_to_site_use_id")
    )


def _with_items(t: Tables, rows: DataFrame) -> DataFrame:
    """Attach item, category and the item's rates to pounds and to its primary unit; lines without an item are spread.

    All of it meets the item at item grain, so the lines are joined once; an item in several categories is
    noted in ``_ambiguous``.
    """
    named_sets = t["mtl_category_sets"].filter(
        F.col("category_set_name") == fixed.INVENTORY_CATEGORY_SET_NAME
    )
    item_category = t["mtl_item_categories"].join(
        named_sets.select("category_set_id"), "category_set_id", "left_semi"
    ).select(
        "inventory_item_id", F.col("organization_id").alias("warehouse_id"), "category_id"
    )
    items = t["mtl_system_items_b"].select(
        "inventory_item_id",
        F.col("organization_id").alias("warehouse_id"),
        F.col("segment1").alias("item_number"),
        "primary_uom_code",
        "weight_uom_code",
        "unit_weight",
        F.lit(True).alias("has_item"),
    )
    item_keys = ["inventory_item_id", "warehouse_id"]
    # all own rates of an item in one join
    items = with_rates_list(items, t["uom_rates"], "_rates", item="inventory_item_id")
    items = with_rate_of_item(items, t["uom_rates"], "to_pounds", own="_rates", from_uom="weight_uom_code", to_literal="LB")
    items = items.withColumn("own_rates", F.filter("_rates", lambda r: r["to_uom"] == F.col("primary_uom_code"))).drop("_rates")
    # both sides with the salt of the join that follows, which then finds them where they lie
    salted = [*item_keys, "_salt"]
    category = one_row_per_key(unsalted(item_category, "inventory_item_id"), salted, ["category_id"])
    # Spark takes copies made by an explode for no larger than their source: without the hint it may broadcast them
    items = unsalted(items, "inventory_item_id").join(category.hint("merge"), salted, "left")
    return spread_join(rows, items, item_keys, spread_by=["customer_trx_line_id"])


def _with_category(t: Tables, rows: DataFrame) -> DataFrame:
    """Attach plant and category; order rows without item, category or plant go. An ambiguous category fails the job."""
    categories = t["mtl_categories"].select(
        "category_id", *[F.col(f"segment{i}").alias(f"inventory_category{i}") for i in (1, 2, 3, 4)]
    )
    plants = t["mtl_parameters"].select(
        F.col("organization_id").alias("plant"), F.col("organization_code").alias("warehouse")
    )
    item_keys = ["inventory_item_id", "warehouse_id"]
    category = checked(F.col("category_id"), F.coalesce("_ambiguous", F.lit(False)), "category_id", item_keys)
    with_category = rows.join(plants, "plant", "left").withColumn("category_id", category).drop("_ambiguous")
    found = F.col("has_item").isNotNull()
    return with_category.join(categories, "category_id", "left").filter(
        F.col("query_identifier").isin(*WITHOUT_ORDER_LINE)
        | (found & F.col("category_id").isNotNull() & F.col("warehouse").isNotNull())
    )


def margin_rows(
    t: Tables, months: Months = None, parts: Sequence[str] = PARTS, *, refresh: bool | None = None, attach: Attached | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """Rows of the requested parts with all names attached; costs are already summed.

    ``refresh``: reduce the order side to what the months ask for first (default: when months
    are given). The rows are the same either way.
    ``keep`` is asked after each of the large joins: what it writes needs its shuffles no more, so the disk holds those of
    one step, not of all.
    """
    refresh = months is not None if refresh is None else refresh
    units = t["hr_all_organization_units"].select(
        F.col("organization_id").alias("line_org_id"), F.col("name").alias("operating_unit")
    )
    keep = keep or (lambda rows, made_of: rows)
    # the narrow distributions meet their invoices first, so no wide row is shuffled for that;
    # names meet the invoices, of which there are fewer than lines, unless few lines are asked for
    invoices = completed_invoices(t)
    booked = collapsed_distributions(t, months)
    if refresh:
        booked = _with_names(t, booked.join(invoices, "customer_trx_id"))
    else:
        booked = booked.join(_with_names(t, invoices), "customer_trx_id")
    booked = keep(booked, None)
    lines = charged_lines(t, booked)
    if attach:
        lines = lines.join(attach.by_line, "customer_trx_line_id", "left")
    lines = lines.join(units, "line_org_id")
    # a line without an item of its kind is known by its type: freight has no item here
    has_no_item = F.coalesce(F.col("inv_line_type") == "FREIGHT", F.lit(False))
    lines = lines.withColumn("inventory_item_id", F.when(~has_no_item, F.col("inventory_item_id")))
    lines = keep(lines.drop("line_org_id", "customer_trx_id", "quantity_invoiced"), booked)
    lines = keep(_with_items(t, lines).drop("weight_uom_code"), lines)
    figures = [*COST_COLUMNS, "om_replacements"]
    zero = F.lit(0).cast(WIDE)
    freight = F.col("inv_line_type") == "FREIGHT"
    plain = F.col("inv_line_type") == "LINE"
    no_item = F.col("inventory_item_id").isNull()
    charged = F.col("om_rev") != 0

    with_order = [p for p in parts if p not in WITHOUT_ORDER_LINE]
    if with_order:
        asked = asked_order_lines(t, months) if refresh else None
        more = [attach.by_order.withColumnRenamed("order_line_id", "order_key")] if attach else []
        sides = keep(order_sides(t, with_order, asked), None)
        joined = spread_join(lines, sides, ["order_key"], spread_by=["customer_trx_line_id"], then=more)
        matched = F.col("has_order_line").isNotNull()
    else:
        texts = ("part", "order_line", "order_line_type")
        empty = {
            **{f: F.lit(None).cast("bigint") for f in figures},
            **{c: F.lit(None).cast("string") for c in texts},
            "plant": F.lit(None).cast("int"),
            **{c: F.lit(None).cast(attach.by_order.schema[c].dataType) for c in (attach.order_columns if attach else [])},
        }
        joined = lines.withColumns(empty)
        matched = F.lit(False)
    identifier = (
        F.when(matched, F.col("part"))
        .when(freight, "Part4")
        .when(plain & no_item, "Part5")
        .when(plain, "Part6")
    )
    tagged = joined.withColumn("query_identifier", identifier).filter(
        F.col("query_identifier").isin(*parts)
        & (charged | F.col("query_identifier").isin("Part1", "Part2", "Part3"))
    )

    part = F.col("query_identifier")
    ordered = ~part.isin(*WITHOUT_ORDER_LINE)
    once = F.when(part == "Part2", F.lit(1).cast("decimal(9,0)")).otherwise(F.col("times"))
    costed = part.isin("Part1", "Part2", "Part3")
    columns = {c: cents(F.when(costed, from_units(F.col(c)) * once).otherwise(zero)) for c in COST_COLUMNS}
    columns["om_replacements"] = cents(
        F.when(costed & (F.col("om_rev") == 0), from_units(F.col("om_replacements")) * F.col("times")).otherwise(zero)
    )
    columns["order_line_id"] = F.when(ordered, F.when(matched, F.col("order_key")))
    columns |= {c: F.when(ordered & matched, F.col(c)) for c in (attach.order_columns if attach else [])}
    # Part6 without an order line has a line text of just the separator
    columns["order_line"] = F.when(ordered, F.coalesce("order_line", F.lit(".")))
    columns["plant"] = F.when(ordered, F.coalesce("plant", F.when(part == "Part6", F.col("warehouse_id"))))
    columns["inventory_item_id"] = F.when(ordered, F.col("inventory_item_id"))
    return _with_category(t, tagged.withColumns(columns))


def market_quantity(t: Tables, rows: DataFrame) -> DataFrame:
    """Add the quantity in pounds; 0 when a unit cannot be converted. ``to_pounds`` and ``own_rates`` came with the item."""
    in_primary = with_rate_of_item(
        rows, t["uom_rates"], "to_primary", own="own_rates", from_uom="uom_code", to_uom="primary_uom_code"
    ).drop("own_rates")
    each = (F.col("unit_weight") * F.col("to_pounds")).cast("decimal(18,9)")
    converted = (F.col("quantity") * F.col("to_primary")).cast("decimal(20,9)") * each
    value = F.when(F.col("uom_code") == "LB", F.col("quantity")).otherwise(converted)
    return in_primary.withColumn(
        "market_quantity", F.coalesce(value, F.lit(0)).cast("decimal(24,6)")
    ).drop("to_primary", "to_pounds")


def with_margin(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "om_gross_profit": gross_profit(F.col("om_rev"), F.col("om_cogs")),
            "om_gross_profit_percent": gross_profit_percent(F.col("om_rev"), F.col("om_cogs")),
        }
    )


def om_detail(
    t: Tables,
    months: Months = None,
    *,
    as_of: dt.datetime,
    request_id: int | None = None,
    parts: Sequence[str] = PARTS,
    refresh: bool | None = None,
    attach: Attached | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """The 49-column margin detail of the given months (``None``: all of them, in one pass); ``attach`` adds its columns.

    ``keep`` may write what large joins give (see `margin_rows`); without it the detail is one plan.
    """
    full = with_margin(market_quantity(t, margin_rows(t, months, parts, refresh=refresh, attach=attach, keep=keep)))
    more = [*attach.line_columns, *attach.order_columns] if attach else []
    return full.withColumns(
        {
            "summary_date": month_start(F.col("gl_date")),
            "creation_date": instant(as_of),
            "request_id": F.lit(request_id).cast("bigint"),
            "market_uom": F.lit("LB"),
            **{c: F.coalesce(c, F.lit(0)).cast(MONEY) for c in fixed.COST_ELEMENTS},
        }
    ).select(*fixed.MARGIN_DETAIL_COLUMNS, *more)


def om_month_summary(detail: DataFrame, months: Months = None) -> DataFrame:
    """Customer × line of business × month totals of the stored detail."""
    return (
        detail.filter(in_months(F.col("gl_date"), months))
        .groupBy("cust_account_id", "line_of_business", month_start(F.col("gl_date")).alias("summary_date"))
        .agg(
            F.sum("om_freight").cast(MONEY).alias("om_freight"),
            F.sum("om_credits").cast(MONEY).alias("om_credits"),
            cents(F.sum("om_replacements")).alias("om_replacements"),
            F.sum("om_rev").cast(MONEY).alias("om_revenue"),
            cents(F.sum("om_cogs")).alias("om_cogs"),
        )
    )


def project_billing(
    t: Tables, months: Months = None, freight_item: int = fixed.PROJECT_FREIGHT_ITEM
) -> DataFrame:
    """Project invoices and freight by customer, line of business of the project, and month.

    Amounts are summed per invoice line before the line meets its invoice and project. The
    order line, its type, plant and item are not read: they are looked up by unique keys and
    neither filter nor multiply rows.
    """
    month = month_start(F.col("gl_date")).alias("summary_date")
    amounts = (
        _distributions(t, fixed.PROJECT_BILLING_ACCOUNTS, months)
        .groupBy("customer_trx_line_id", "customer_trx_id", month)
        .agg(F.sum("acctd_amount").cast(WIDE).alias("amount"))
    )
    kind = F.col("project_type")
    lob = F.lit(fixed.OTHER_PROJECT_LOB)
    for name, code in fixed.LOB_BY_PROJECT_TYPE.items():
        lob = F.when(kind == name, F.lit(code)).otherwise(lob)
    projects = t["pa_projects_all"].filter(kind != fixed.SHARED_PROJECT_TYPE).select(
        F.col("segment1").alias("interface_line_attribute1"), lob.alias("line_of_business")
    )
    units = t["hr_all_organization_units"].select(F.col("organization_id").alias("org_id"))
    lines = t["ra_customer_trx_lines_all"].select(
        "customer_trx_line_id", "customer_trx_id", "org_id", "inventory_item_id", "interface_line_attribute1"
    ).join(units, "org_id", "left_semi").drop("org_id")
    invoices = (
        t["ra_customer_trx_all"]
        .filter(F.col("complete_flag") == "Y")
        .join(t["ra_cust_trx_types_all"].select("cust_trx_type_id", "org_id"), ["cust_trx_type_id", "org_id"], "left_semi")
        .select("customer_trx_id", F.coalesce("sold_to_customer_id", "bill_to_customer_id").alias("cust_account_id"))
        .join(t["hz_cust_accounts"].select("cust_account_id"), "cust_account_id", "left_semi")
    )
    freight = F.when(F.col("inventory_item_id") == freight_item, F.col("amount")).otherwise(F.lit(0))
    return (
        amounts.join(lines, ["customer_trx_line_id", "customer_trx_id"])
        .join(projects, "interface_line_attribute1")
        .join(invoices, "customer_trx_id")
        .groupBy("cust_account_id", "line_of_business", "summary_date")
        .agg(
            F.sum(freight).cast(MONEY).alias("pa_freight"),
            F.sum("amount").cast(MONEY).alias("pa_invoice"),
        )
    )
