"""The monthly account plan: which months to run, and the refreshed summary table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.dates import period_month
from tallyline.operators.bounds import scan_bounds
from tallyline.operators.joins import NEW, renamed, same_key
from tallyline.operators.state import backfill_null, upsert_measures
from tallyline.sources.tables import Tables

KEYS = ["customer_account_id", "line_of_business", "summary_date"]
MEASURES = [*fixed.ORDER_MEASURES, *fixed.BILLING_MEASURES, *fixed.PROJECT_MEASURES]


def open_periods(
    t: Tables, as_of: dt.date, lookback_days: int = fixed.CLOSED_PERIOD_LOOKBACK_DAYS
) -> DataFrame:
    """Months to process: open periods, and closed ones changed within the last days.

    Period names that are no month (adjustment periods) are skipped.
    """
    changed_after = as_of - dt.timedelta(days=lookback_days)
    wanted = (F.col("closing_status") == "O") | (
        (F.col("closing_status") == "C") & (F.col("last_update_date") > F.lit(changed_after))
    )
    applications = t["fnd_application"].filter(
        F.col("application_short_name").isin(*fixed.PERIOD_APPLICATIONS)
    )
    month = period_month(F.col("period_name"))
    return (
        t["gl_period_statuses"]
        .filter(wanted)
        .join(applications.select("application_id"), "application_id", "left_semi")
        .select("period_name", month.alias("summary_date"))
        .filter(F.col("summary_date").isNotNull())
        .distinct()
    )


def rows_of_open_periods(df: DataFrame, column: str, periods: DataFrame) -> DataFrame:
    """Rows whose date lies in one of the months of ``periods``, without reading them first.

    The outer bounds are scalar subqueries of the column's own type, which reach the scan as
    pushed filters; the exact months are a semi join with the short list.
    """
    month = F.col("summary_date")
    first, after = scan_bounds(periods, month, F.add_months(month, 1), df.schema[column].dataType)
    months = periods.select(F.col("summary_date").alias("_month")).distinct()
    inside = df.filter((F.col(column) >= first) & (F.col(column) < after))
    return inside.join(months, F.trunc(F.col(column).cast("date"), "MM") == F.col("_month"), "left_semi")


def limited_to_periods(t: Tables, periods: DataFrame) -> Tables:
    """The same tables, with the dated ledger inputs limited to the months of ``periods``."""
    dated = ("ra_cust_trx_line_gl_dist_all", "pa_draft_revenues_all", "pa_cost_distribution_lines_all")
    return t.with_tables(**{name: rows_of_open_periods(t[name], "gl_date", periods) for name in dated})


def _keyed(summary: DataFrame) -> DataFrame:
    return summary.withColumnRenamed("cust_account_id", "customer_account_id")


def combined_batch(orders: DataFrame, billing: DataFrame, revenue: DataFrame, cost: DataFrame) -> DataFrame:
    """The four summaries side by side: one row per key, one flag per loader that touched it."""
    feeds = {
        "orders": (_keyed(orders).withColumnRenamed("om_cogs", "om_cost"), fixed.ORDER_MEASURES),
        "billing": (_keyed(billing), fixed.BILLING_MEASURES),
        "revenue": (_keyed(revenue), ("pa_revenue",)),
        "cost": (_keyed(cost), ("pa_cost",)),
    }
    rows: DataFrame | None = None
    for name, (feed, measures) in feeds.items():
        columns = [F.col(m).cast("decimal(28,10)").alias(m) if m in measures
                   else F.lit(None).cast("decimal(28,10)").alias(m) for m in MEASURES]
        one = feed.select(*KEYS, F.lit(name).alias("feed"), *columns)
        rows = one if rows is None else rows.unionByName(one)
    flags = [F.max(F.when(F.col("feed") == f, True)).alias(f"_{f}") for f in feeds]
    return rows.groupBy(*KEYS).agg(*[F.max(m).alias(m) for m in MEASURES], *flags)


def refreshed_interface(
    target: DataFrame, batch: DataFrame, in_period: Column, *, null_safe: bool = True, strict: bool = False
) -> DataFrame:
    """New state of the summary table after the order, billing and project loaders, in that order.

    Each loader updates or inserts its own measures, then zeroes them in the period's rows it did
    not touch, including rows an earlier loader has just inserted; rows a later loader inserts
    keep NULL there. Project revenue and cost are zeroed together: a row only one of them touches
    keeps the other's old value, unless ``strict``.
    """
    old = target.withColumns({"_old": F.lit(True), "_period": in_period})
    joined = old.join(renamed(batch), same_key(KEYS, null_safe), "full")
    touched = {f: F.col(f"{NEW}_{f}").isNotNull() for f in ("orders", "billing", "revenue", "cost")}
    existed = F.col("_old").isNotNull()
    in_run = F.coalesce("_period", F.lit(True))

    def value(name: str, mine: Column, present: Column, kept: Column) -> Column:
        """``present``: the row existed when this loader reset its measures."""
        kind = target.schema[name].dataType
        untouched = F.when(in_run & present, kept).otherwise(F.col(name))
        return F.when(mine, F.col(NEW + name).cast(kind)).otherwise(untouched.cast(kind)).alias(name)

    zero = F.lit(0)
    had_orders = existed | touched["orders"]
    had_billing = had_orders | touched["billing"]
    columns = {k: F.when(existed, F.col(k)).otherwise(F.col(NEW + k)).alias(k) for k in KEYS}
    for m in fixed.ORDER_MEASURES:
        columns[m] = value(m, touched["orders"], existed, zero)
    for m in fixed.BILLING_MEASURES:
        columns[m] = value(m, touched["billing"], had_orders, zero)
    for m, other in (("pa_revenue", "cost"), ("pa_cost", "revenue")):
        # a row the other loader inserts gets 0; one it updates keeps what it had
        kept = zero if strict else F.when(touched[other] & had_billing, F.col(m)).otherwise(zero)
        columns[m] = value(m, touched[m.removeprefix("pa_")], F.lit(True), kept)
    return joined.select(*[columns.get(c, F.col(c)) for c in target.columns])


def account_plan(
    t: Tables,
    target: DataFrame,
    periods: DataFrame,
    orders: DataFrame,
    billing: DataFrame,
    revenue: DataFrame,
    cost: DataFrame,
    *,
    null_safe: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Refresh the months of ``periods``; then fill missing account numbers."""
    months = periods.select(F.col("summary_date").alias("_month")).distinct()
    old = target.join(months, F.col("summary_date") == F.col("_month"), "left").withColumn(
        "_in_run", F.col("_month").isNotNull()
    )
    batch = combined_batch(orders, billing, revenue, cost)
    new = refreshed_interface(
        old.drop("_month"), batch, F.col("_in_run"), null_safe=null_safe, strict=strict
    ).select(*target.columns)
    return backfill_null(
        new, t["hz_cust_accounts_all"], "customer_account_id", "cust_account_id", "account_number"
    )


def account_plan_by_steps(target: DataFrame, orders: DataFrame, billing: DataFrame, in_period: Column) -> DataFrame:
    """The order and billing loaders one after the other, for callers that run them separately."""
    first = upsert_measures(
        target, _keyed(orders).withColumnRenamed("om_cogs", "om_cost"), KEYS,
        fixed.ORDER_MEASURES, reset=in_period,
    )
    return upsert_measures(first, _keyed(billing), KEYS, fixed.BILLING_MEASURES, reset=in_period)
