"""Items with their product line, shared by the tonnage jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.sources.tables import Tables

ITEM = ["organization_id", "inventory_item_id"]


def product_line_values(t: Tables) -> DataFrame:
    """Category code → product line, from the product-line value set."""
    value_set = t["fnd_flex_value_sets"].filter(
        F.col("flex_value_set_name") == fixed.PRODUCT_LINE_VALUE_SET
    )
    return t["fnd_flex_values"].join(value_set, "flex_value_set_id").select(
        F.col("flex_value").alias("segment1"), F.col("attribute2").alias("product_line")
    )


def item_product_lines(
    t: Tables, *, structure: int | None = None, category_set: int | None = None
) -> DataFrame:
    """(organisation, item, product line, times): an item in two category sets counts twice.

    All joins are between dimensions; ``times`` keeps the multiplicity without repeating rows.
    """
    links, categories = t["mtl_item_categories"], t["mtl_categories"]
    if category_set is not None:
        links = links.filter(F.col("category_set_id") == category_set)
    if structure is not None:
        categories = categories.filter(F.col("structure_id") == structure)
    return (
        # categories are few, the links to them as many as items: their estimated sizes can be the other way round
        links.join(F.broadcast(categories.select("category_id", "segment1")), "category_id")
        .join(product_line_values(t), "segment1")
        .groupBy(*ITEM, "product_line")
        .agg(F.count(F.lit(1)).cast("decimal(9,0)").alias("times"))
    )


def items_in_category_set(t: Tables, structure: int, category_set: int) -> DataFrame:
    """Items of one category set of one structure: the report's optional filter."""
    sets = t["mtl_category_sets"].filter(
        (F.col("structure_id") == structure) & (F.col("category_set_id") == category_set)
    )
    return (
        t["mtl_item_categories"]
        .join(sets.select("category_set_id"), "category_set_id", "left_semi")
        .join(t["mtl_categories"].select("category_id"), "category_id", "left_semi")
        .select(*ITEM)
    )
