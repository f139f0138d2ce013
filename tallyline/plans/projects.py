"""Project revenue and cost, split over a project's customers.

Amounts are summed per project before the customers come in (the split is linear), so a
large project is one row per account group and month when it meets its customers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.dates import in_months, month_start, on_last_day
from tallyline.functions.money import WIDE, split_share
from tallyline.plans.margin import Months
from tallyline.sources.tables import Tables

SHARE = "decimal(28,10)"


def _accounts(t: Tables, accounts: Sequence[str]) -> DataFrame:
    return t["gl_code_combinations"].filter(F.col("segment5").isin(*accounts)).select(
        "code_combination_id", F.col("segment2").alias("line_of_business")
    )


def project_events(t: Tables, accounts: Sequence[str], months: Months, few: bool = False) -> DataFrame:
    """Event amounts booked on a month's last day: project × line of business × month.

    ``few``: the drafts are those of some months only. Then events of other drafts are dropped
    before anything is summed; in a full run that would be a join for nothing.
    """
    drafts = t["pa_draft_revenues_all"].filter(
        in_months(F.col("gl_date"), months) & on_last_day(F.col("gl_date"))
    ).select("project_id", "draft_revenue_num", month_start(F.col("gl_date")).alias("summary_date"))
    key = ["project_id", "draft_revenue_num"]
    items = t["pa_draft_revenue_items"].select(*key, F.col("line_num").alias("draft_revenue_item_line_num"))
    events = t["pa_cust_event_rdl_all"]
    if few or months is not None:
        events = events.join(drafts.select(*key), key, "left_semi")
    return (
        events.join(_accounts(t, accounts), "code_combination_id")
        .groupBy(*key, "draft_revenue_item_line_num", "line_of_business")
        .agg(F.sum("amount").cast(WIDE).alias("amount"))
        .join(drafts, key)
        .join(items, [*key, "draft_revenue_item_line_num"])
        .groupBy("project_id", "line_of_business", "summary_date")
        .agg(F.sum("amount").cast(WIDE).alias("amount"))
    )


def project_burden(t: Tables, months: Months) -> DataFrame:
    """Burdened cost of the whole month: project × line of business × month."""
    accounts = _accounts(t, fixed.PROJECT_COST_ACCOUNTS).withColumnRenamed(
        "code_combination_id", "dr_code_combination_id"
    )
    lines = (
        t["pa_cost_distribution_lines_all"]
        .filter(in_months(F.col("gl_date"), months))
        .join(accounts, "dr_code_combination_id")
        .groupBy(
            "project_id", "expenditure_item_id", "line_of_business",
            month_start(F.col("gl_date")).alias("summary_date"),
        )
        .agg(F.count(F.lit(1)).cast("decimal(9,0)").alias("times"))
    )
    items = t["pa_expenditure_items_all"].select("project_id", "expenditure_item_id", "burden_cost")
    return (
        lines.join(items, ["project_id", "expenditure_item_id"])
        .groupBy("project_id", "line_of_business", "summary_date")
        .agg(F.sum(F.col("burden_cost") * F.col("times")).cast(WIDE).alias("amount"))
    )


def _by_customer(t: Tables, amounts: DataFrame, name: str) -> DataFrame:
    projects = t["pa_projects_all"].filter(F.col("project_type") != fixed.SHARED_PROJECT_TYPE)
    customers = t["pa_project_customers"].select(
        "project_id", F.col("customer_id").alias("cust_account_id"), "customer_bill_split"
    )
    return (
        amounts.join(projects.select("project_id"), "project_id", "left_semi")
        .join(customers, "project_id")
        .groupBy("cust_account_id", "line_of_business", "summary_date")
        .agg(F.sum(split_share(F.col("amount"), F.col("customer_bill_split"))).cast(SHARE).alias(name))
    )


def project_revenue(t: Tables, months: Months = None, few: bool = False) -> DataFrame:
    return _by_customer(t, project_events(t, fixed.PROJECT_REVENUE_ACCOUNTS, months, few), "pa_revenue")


def project_cost(t: Tables, months: Months = None, few: bool = False) -> DataFrame:
    """Sign-flipped events of the last day plus burdened cost of the whole month."""
    events = project_events(t, fixed.PROJECT_COST_ACCOUNTS, months, few).withColumn(
        "amount", (-F.col("amount")).cast(WIDE)
    )
    return _by_customer(t, events.unionByName(project_burden(t, months)), "pa_cost")

