"""Tonnage by plant: made, outsourced and shipped.

Pounds are linear in the quantity, so each branch first sums quantities per plant, item and
unit (with map-side combine) and only then meets the item, category and rate tables: the
joins see one row per item and unit, whatever the number of transactions of a hot item. Items
and what they are filed under grow with the input; the merge hint keeps them off the driver, as
a size estimated from compressed files and their copies per plant is far too small.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.dates import day_range
from tallyline.operators.units import with_unit_rate
from tallyline.plans.product_lines import ITEM, item_product_lines, items_in_category_set
from tallyline.sources.tables import Tables

QUANTITY = "decimal(18,4)"
POUNDS = "decimal(24,6)"
CategoryFilter = tuple[int, int]  # structure, category set


def pounds(rate: Column, quantity: Column, unit_weight: Column) -> Column:
    """Rate × quantity × unit weight; a missing weight counts as 1.

    The rate is that of the transaction unit while the quantity is in the primary unit.
    """
    weight = F.coalesce(unit_weight, F.lit(1)).cast("decimal(9,4)")
    return (rate * quantity.cast(QUANTITY)).cast("decimal(24,9)") * weight


def product_line_sums(amount: Column, prefix: str = "") -> list[Column]:
    """One column per product line, 0 where a row belongs to another line."""
    line = F.col("product_line")

    def over(test: Column, name: str) -> Column:
        return F.sum(F.when(test, amount).otherwise(F.lit(0))).cast(POUNDS).alias(prefix + name)

    others = (fixed.HI_TENSILE, fixed.TRIM, fixed.SHEETING)
    return [
        over(line == fixed.FRAME, "frame"),
        over(line == fixed.HI_TENSILE, "hi_tensile"),
        over(line == fixed.TRIM, "trim"),
        over(line == fixed.SHEETING, "sheeting"),
        over(line.isin(*others), "non_frame"),
    ]


def _transaction_pounds(
    t: Tables,
    start: dt.date,
    end: dt.date,
    types: Sequence[int],
    source_types: Sequence[int],
    actions: Sequence[int],
    category_filter: CategoryFilter | None,
) -> DataFrame:
    """Pounds per plant and product line of the chosen transactions."""
    quantities = (
        t["mtl_material_transactions"]
        .filter(
            F.col("transaction_type_id").isin(*types)
            & F.col("transaction_source_type_id").isin(*source_types)
            & F.col("transaction_action_id").isin(*actions)
            & day_range(F.col("transaction_date"), start, end)
        )
        .groupBy(*ITEM, "transaction_uom")
        .agg(F.sum("primary_quantity").alias("quantity"))
    )
    weighed = quantities.join(t["mtl_system_items"].select(*ITEM, "unit_weight").hint("merge"), ITEM).join(
        item_product_lines(t, structure=fixed.PRODUCT_LINE_STRUCTURE).hint("merge"), ITEM
    )
    if category_filter is not None:
        weighed = weighed.join(items_in_category_set(t, *category_filter).hint("merge"), ITEM, "left_semi")
    rated = with_unit_rate(
        weighed, t["uom_rates"], "rate",
        item="inventory_item_id", from_uom="transaction_uom", to_literal="LB",
    )
    weight = pounds(F.col("rate"), F.col("quantity"), F.col("unit_weight"))
    return _with_plant(t, rated).select(
        "org", "product_line", (weight.cast("decimal(28,9)") * F.col("times")).alias("pounds")
    )


def _with_plant(t: Tables, df: DataFrame) -> DataFrame:
    plants = t["mtl_parameters"].select("organization_id", F.col("organization_code").alias("org"))
    return df.join(plants, "organization_id")


def tonnage_made(
    t: Tables, start: dt.date, end: dt.date, category_filter: CategoryFilter | None = None
) -> DataFrame:
    """Completed production in pounds, by plant and product line."""
    made = _transaction_pounds(
        t, start, end, [fixed.COMPLETION_TYPE], [fixed.COMPLETION_SOURCE_TYPE],
        [fixed.COMPLETION_ACTION], category_filter,
    )
    return made.groupBy("org").agg(*product_line_sums(F.col("pounds")))


def tonnage_shipped(
    t: Tables, start: dt.date, end: dt.date, category_filter: CategoryFilter | None = None
) -> DataFrame:
    """Shipped pounds by plant (issues are negative)."""
    shipped = _transaction_pounds(
        t, start, end, fixed.SHIPMENT_TYPES, fixed.SHIPMENT_SOURCE_TYPES,
        fixed.SHIPMENT_ACTIONS, category_filter,
    )
    return shipped.groupBy("org").agg(F.sum("pounds").cast(POUNDS).alias("ship_confirmed"))


def open_outsourced_lines(t: Tables) -> DataFrame:
    """Open purchase shipments: one row per line location with its open quantity.

    A document is open by its own status only for two types; blanket documents have no
    header status that could be open, so none of their lines passes.
    """
    opened, no = F.lit("OPEN"), F.lit("N")
    kind = F.col("type_lookup_code")
    by_status = kind.isin(*fixed.PO_TYPES_WITH_HEADER_STATUS)

    headers = t["po_headers_all"].filter(
        kind.isin(*fixed.PO_TYPES)
        & (F.when(by_status, F.coalesce("closed_code", opened)) == "OPEN")
        & (F.coalesce("cancel_flag", no) == "N")
    ).join(t["po_vendors"].select("vendor_id"), "vendor_id", "left_semi").select("po_header_id", kind)

    lines = t["po_lines_all"].filter(F.coalesce("cancel_flag", no) == "N").join(
        t["po_line_types"].select("line_type_id"), "line_type_id", "left_semi"
    ).select("po_line_id", "po_header_id", F.col("closed_code").alias("line_closed_code"))

    ordered = (F.coalesce("quantity", F.lit(0)) - F.coalesce("quantity_cancelled", F.lit(0))).cast(QUANTITY)
    locations = t["po_line_locations_all"].filter(
        F.col("shipment_type").isin(*fixed.PO_SHIPMENT_TYPES)
        & (F.coalesce("approved_flag", no) == "Y")
        & (F.coalesce("cancel_flag", no) == "N")
        & F.coalesce("closed_code", opened).isin(*fixed.PO_OPEN_SHIPMENT_STATUSES)
        & (ordered > F.coalesce("quantity_received", F.lit(0)))
    ).select("line_location_id", "po_line_id", ordered.alias("open_quantity"))

    line_open = (
        F.when(by_status, F.coalesce("line_closed_code", opened))
        .when(kind == fixed.PO_TYPE_WITHOUT_STATUS, opened)
    )
    return (
        locations.join(lines, "po_line_id")
        .join(headers, "po_header_id")
        .filter(line_open == "OPEN")
        .select("line_location_id", "po_line_id", "po_header_id", kind, "open_quantity")
    )


def tonnage_outsourced(t: Tables, category_filter: CategoryFilter | None = None) -> DataFrame:
    """Open outsourced quantities on released jobs, by plant and product line (not weight)."""
    jobs = (
        t["wip_discrete_jobs"]
        .filter(F.col("status_type") == fixed.RELEASED_JOB_STATUS)
        .join(t["wip_entities"].select("wip_entity_id"), "wip_entity_id", "left_semi")
        .select("wip_entity_id", "organization_id", F.col("primary_item_id").alias("inventory_item_id"))
    )
    resources = t["bom_resources"].filter(F.col("attribute6") == "Y").select(
        F.col("resource_id").alias("bom_resource_id")
    )
    quantities = (
        t["po_distributions_all"]
        .select("line_location_id", "wip_entity_id", "bom_resource_id")
        .join(resources, "bom_resource_id", "left_semi")
        .join(open_outsourced_lines(t), "line_location_id")
        .join(jobs, "wip_entity_id")
        .groupBy(*ITEM)
        .agg(F.sum("open_quantity").cast(QUANTITY).alias("quantity"))
        .join(t["mtl_system_items"].select(*ITEM).hint("merge"), ITEM, "left_semi")
        .join(item_product_lines(t, category_set=fixed.PURCHASING_CATEGORY_SET).hint("merge"), ITEM)
    )
    if category_filter is not None:
        quantities = quantities.join(items_in_category_set(t, *category_filter).hint("merge"), ITEM, "left_semi")
    amount = F.col("quantity") * F.col("times")
    return _with_plant(t, quantities).groupBy("org").agg(*product_line_sums(amount, "osp_"))


def tonnage_by_org(
    t: Tables, start: dt.date, end: dt.date, category_filter: CategoryFilter | None = None
) -> DataFrame:
    """The combined report: twelve columns per plant."""
    columns = [c for c in fixed.TONNAGE_REPORT_COLUMNS if c != "org"]
    branches = [
        tonnage_made(t, start, end, category_filter),
        tonnage_outsourced(t, category_filter),
        tonnage_shipped(t, start, end, category_filter),
    ]
    filled = [
        b.select("org", *[F.col(c) if c in b.columns else F.lit(0).cast(POUNDS).alias(c) for c in columns])
        for b in branches
    ]
    rows = filled[0].unionByName(filled[1]).unionByName(filled[2])
    totals = [
        (F.abs(F.sum(c)) if c == "ship_confirmed" else F.sum(c)).cast(POUNDS).alias(c) for c in columns
    ]
    return rows.groupBy("org").agg(*totals).select(*fixed.TONNAGE_REPORT_COLUMNS)
