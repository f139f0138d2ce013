"""Every job as a named query over a directory of the supplied tables.

Parameters that are arguments of the jobs are fixed here (dates, the project freight item),
because the supplied data lies in 1995-2001. All queries read whole tables; where a job is
about one month by nature (a refresh), the rest of its table is part of the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline import fixed_values as fixed, loads
from tallyline.functions.dates import month_name, period_month
from tallyline.functions.text import numeric_key, order_from_job
from tallyline.operators import lookups, quality, state, units
from tallyline.operators.costs import cost_by_transaction
from tallyline.plans import (
    account_plan as plan, invoice_stage as stage, margin, projects, sales_org, tonnage_load as fact,
    tonnage_report as report,
)
from tallyline.sources import load_log
from tallyline.sources.adapters import adapted_tables
from tallyline.sources.sinks import Stages, remove, shared_folder, write_history
from tallyline.sources.tables import Tables

AS_OF = dt.date(1998, 6, 15)
MOMENT = dt.datetime(1998, 6, 15)
FIRST_DAY, LAST_DAY = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
MONTH = [dt.date(1998, 6, 1)]
YEARS = range(1995, 2002)
FIRST_PERIOD, LAST_PERIOD = "JAN-95", "NOV-01"
FREIGHT_ITEM = 7
FILTER = (101, 2)

Job = Callable[[Tables], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Plain types for comparing engines: exact decimals as double, dates as text."""
    columns = []
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind == "decimal":
            columns.append(F.col(field.name).cast("double").alias(field.name))
        elif kind == "date":
            columns.append(F.col(field.name).cast("string").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def detail(t: Tables, *parts: str, refresh: bool = False, attach: margin.Attached | None = None) -> DataFrame:
    return margin.om_detail(t, as_of=MOMENT, request_id=1, parts=parts or margin.PARTS, refresh=refresh, attach=attach)


def staged_detail(t: Tables, *parts: str, attach: margin.Attached | None = None) -> DataFrame:
    """`detail` with all its columns: its large joins are written one by one, so the disk holds the shuffles of one of them."""
    keep = Stages(t["ra_customer_trx_all"].sparkSession)
    return margin.om_detail(t, as_of=MOMENT, request_id=1, parts=parts or margin.PARTS, refresh=False, attach=attach, keep=keep)


def staged_month(t: Tables, request_id: int, attach: margin.Attached | None = None) -> DataFrame:
    """The detail of one month, written: it is small, while its shuffles are those of the order lines it looks for."""
    fresh = margin.om_detail(t, MONTH, as_of=MOMENT, request_id=request_id, attach=attach)
    return Stages(fresh.sparkSession)(fresh)


# ---- small operators -------------------------------------------------------------

def uom_rate(t: Tables) -> DataFrame:
    moves = t["mtl_material_transactions"].select("inventory_item_id", "transaction_uom").distinct()
    return units.with_unit_rate(
        moves, t["uom_rates"], "rate", item="inventory_item_id", from_uom="transaction_uom", to_literal="LB"
    )


def job_orders(t: Tables) -> DataFrame:
    number = order_from_job(F.col("wip_entity_name"), fixed.NO_ORDER)
    return t["wip_entities"].select("wip_entity_id", number.alias("order_number"))


def period_range_join(t: Tables) -> DataFrame:
    calendar = fact.period_bounds(t, F.lit(FIRST_DAY), F.lit(LAST_DAY), fixed.TONNAGE_ORGANIZATIONS)
    return fact.completions_in_periods(t, calendar, fixed.TONNAGE_ORGANIZATIONS).select(
        "transaction_id", "organization_id", "period_name"
    )


def order_attribute(name: str) -> Job:
    def job(t: Tables) -> DataFrame:
        orders = fact.with_order_attributes(t, fact.produced_orders(t), ["organization_id"])
        return orders.select("order_number", "organization_id", name)

    return job


def period_months(t: Tables) -> DataFrame:
    month = period_month(F.col("period_name"))
    return t["gl_period_statuses"].select("period_name").distinct().select(
        "period_name", month.alias("month_start"), month_name(month).alias("month_name")
    )


def scalar_lookup(t: Tables) -> DataFrame:
    cost, names = stage.ledger_segments(t["margin_cogs_segments"], "order_line_id", "rev")
    lines = t["oe_order_lines_all"].select(F.col("line_id").alias("order_line_id"), "header_id")
    return lookups.scalar_lookup(lines, cost, ["order_line_id"], names, spread_by=["header_id"])


def row_quarantine(t: Tables) -> DataFrame:
    rules = {
        "no item": F.col("inventory_item_id").isNotNull(),
        "order line is no number": numeric_key(F.col("interface_line_attribute6")).isNotNull(),
        "quantity not positive": F.coalesce("quantity_invoiced", "quantity_credited") > 0,
    }
    _, rejected = quality.row_quarantine(t["ra_customer_trx_lines_all"], rules)
    return rejected.select("customer_trx_line_id", "line_type", "load_error")


# ---- tonnage fact ----------------------------------------------------------------

def tonnage_load(t: Tables) -> DataFrame:
    return fact.tonnage_backfill(t, LAST_PERIOD, FIRST_PERIOD).select(*fixed.TONNAGE_FACT_COLUMNS)


def tonnage_refresh(t: Tables) -> DataFrame:
    stored = fact.tonnage_backfill(t, LAST_PERIOD, FIRST_PERIOD)
    stale = stored.withColumn("qty", (F.col("qty") + 1).cast(fact.TONS))
    return fact.tonnage_refresh(t, stale, "JUN-98", AS_OF, first_load=False).select(*fixed.TONNAGE_FACT_COLUMNS)


# ---- margin ------------------------------------------------------------------------

def freight_credits(t: Tables) -> DataFrame:
    return margin.invoice_lines(t, None).select(
        "customer_trx_line_id", "line_of_business", "rev_gl_account", "gl_date", "om_rev",
        "om_freight", "om_credits", "times",
    )


def detail_columns(*names: str, parts: tuple[str, ...] = ()) -> Job:
    keys = (
        "query_identifier", "customer_trx_line_id", "order_line_id", "order_line", "line_of_business",
        "rev_gl_account", "gl_date", "om_rev",
    )
    return lambda t: detail(t, *parts).select(*keys, *names)


def month_summary(t: Tables) -> DataFrame:
    return margin.om_month_summary(detail(t))


# ---- stored state --------------------------------------------------------------------

def _interface(t: Tables) -> DataFrame:
    return t["account_plan_interface"]


def _billing(t: Tables) -> DataFrame:
    return margin.project_billing(t, MONTH, FREIGHT_ITEM).withColumnRenamed("cust_account_id", "customer_account_id")


def account_plan(t: Tables) -> DataFrame:
    periods = plan.open_periods(t, AS_OF)
    recent = plan.limited_to_periods(t, periods)
    return plan.account_plan(
        t, _interface(t), periods,
        orders=margin.om_month_summary(detail(recent, refresh=True)),
        billing=margin.project_billing(recent, None, FREIGHT_ITEM),
        revenue=projects.project_revenue(recent, few=True),
        cost=projects.project_cost(recent, few=True),
    )


def stored_account_plan(t: Tables) -> DataFrame:
    """The plan as a stored table: what is there at first, refreshed by a load, and read again."""
    target = _interface(t)
    spark, schema = target.sparkSession, target.schema
    path = shared_folder(spark)
    write_history(target, path, "summary_date")
    loads.load_account_plan(t, path, schema, as_of=MOMENT, request_id=1, freight_item=FREIGHT_ITEM)
    return loads.stored_plan(spark, path, schema)


def load_ledger(t: Tables) -> DataFrame:
    """The log of a month summary's history, stored in two steps, beside what is stored."""
    summary = margin.om_month_summary(detail(t))
    spark, columns = summary.sparkSession, summary.columns
    # computed once: both steps take their months from it
    path, whole = shared_folder(spark), shared_folder(spark)
    write_history(summary, whole, "summary_date")
    computed = spark.read.schema(summary.schema).parquet(whole).select(*columns)
    months = [dt.date(y, m, 1) for y in YEARS for m in range(1, 13)]
    steps = {"first": months[:42], "second": months[42:]}
    store = loads.Store(path, "month summary", 1, "history")
    loads.load_history(store, steps, lambda some: computed.filter(F.col("summary_date").isin(list(some))), "summary_date")
    remove(spark, whole)
    stored = spark.read.parquet(path).select(*columns)
    return load_log.audit(spark, store.log, store.load, stored, "summary_date")


def period_replace(t: Tables) -> DataFrame:
    """One month of the stored margin detail, reloaded by a later request."""
    fresh = staged_month(t, 2)
    return state.period_replace(staged_detail(t), fresh, "summary_date", MONTH[0])


def upsert_measures(t: Tables) -> DataFrame:
    return state.upsert_measures(_interface(t), _billing(t), plan.KEYS, fixed.BILLING_MEASURES)


def reset_stale(t: Tables) -> DataFrame:
    this_month = F.col("summary_date") == F.lit(MONTH[0])
    return state.reset_stale(_interface(t), _billing(t), plan.KEYS, fixed.BILLING_MEASURES, this_month)


def backfill_null(t: Tables) -> DataFrame:
    return state.backfill_null(
        _interface(t), t["hz_cust_accounts_all"], "customer_account_id", "cust_account_id", "account_number"
    )


def load_audit(t: Tables) -> DataFrame:
    return quality.load_audit(_interface(t), upsert_measures(t), F.col("summary_date"))


# ---- invoice staging -------------------------------------------------------------------

def invoice_stage(t: Tables) -> DataFrame:
    return stage.invoice_stage(t, staged_detail(t, attach=stage.attached_columns(t)), as_of=MOMENT, user="loader")


def history_backfill(t: Tables) -> DataFrame:
    return stage.history_backfill(t, staged_detail(t, attach=stage.attached_columns(t)), YEARS, as_of=MOMENT, user="loader")


def incremental_refresh(t: Tables) -> DataFrame:
    more = stage.attached_columns(t)
    month = staged_month(t, 1, attach=more)
    old = stage.history_backfill(t, staged_detail(t, attach=more), YEARS, as_of=MOMENT, user="first load")
    return stage.incremental_refresh(t, old, month, as_of=MOMENT, user="refresh", first_load=False)


JOBS: dict[str, Job] = {
    "tonnage_made": lambda t: report.tonnage_made(t, FIRST_DAY, LAST_DAY),
    "tonnage_osp": report.tonnage_outsourced,
    "tonnage_shipped": lambda t: report.tonnage_shipped(t, FIRST_DAY, LAST_DAY),
    "tonnage_by_org": lambda t: report.tonnage_by_org(t, FIRST_DAY, LAST_DAY),
    "tonnage_category_filter": lambda t: report.tonnage_by_org(t, FIRST_DAY, LAST_DAY, FILTER),
    "osp_open_po": report.open_outsourced_lines,
    "uom_rate": uom_rate,
    "order_from_job": job_orders,
    "period_range_join": period_range_join,
    "internal_order_path": fact.internal_order_path,
    "order_team": order_attribute("team_desc"),
    "order_lob": order_attribute("lobo"),
    "order_salesrep": order_attribute("salesrep_name"),
    "tonnage_load": tonnage_load,
    "tonnage_refresh": tonnage_refresh,
    "cost_elements": lambda t: cost_by_transaction(t["mtl_transaction_accounts"]),
    "om_freight_credits": freight_credits,
    "om_replacements": detail_columns("om_replacements", parts=("Part1", "Part2", "Part3")),
    "om_part1_sales": lambda t: staged_detail(t, "Part1"),
    "om_part2_config": lambda t: staged_detail(t, "Part2"),
    "om_part3_returns": lambda t: staged_detail(t, "Part3"),
    "om_part4_freight": lambda t: detail(t, "Part4"),
    "om_part5_no_item": lambda t: detail(t, "Part5"),
    "om_part6_no_txn": lambda t: staged_detail(t, "Part6"),
    "om_detail": staged_detail,
    "gross_profit": detail_columns("om_cogs", "om_gross_profit", "om_gross_profit_percent"),
    "market_quantity": detail_columns("quantity", "uom_code", "market_quantity", "market_uom"),
    "om_month_summary": month_summary,
    "pa_invoice": lambda t: margin.project_billing(t, None, FREIGHT_ITEM),
    "pa_revenue": projects.project_revenue,
    "pa_cost": projects.project_cost,
    "account_plan": account_plan,
    "period_replace": period_replace,
    "upsert_measures": upsert_measures,
    "reset_stale": reset_stale,
    "backfill_null": backfill_null,
    "stored_account_plan": stored_account_plan,
    "load_ledger": load_ledger,
    "open_periods": lambda t: plan.open_periods(t, AS_OF),
    "period_month": period_months,
    "row_quarantine": row_quarantine,
    "load_audit": load_audit,
    "history_backfill": history_backfill,
    "incremental_refresh": incremental_refresh,
    "lookup_active": lambda t: lookups.active_lookup(t["fnd_lookup_values"], fixed.LOOKUP_TITLES),
    "active_rows": lambda t: sales_org.active_rep_territories(t, AS_OF),
    "rep_base": sales_org.rep_base,
    "group_roles": sales_org.group_roles,
    "team_members": sales_org.team_members,
    "team_rollup": sales_org.team_rollup,
    "team_manager": lambda t: sales_org.team_manager(t, AS_OF),
    "sales_territory": lambda t: sales_org.sales_territory(t, AS_OF),
    "rep_list": sales_org.rep_list,
    "dim_sales_rep": sales_org.sales_rep_dimension,
    "scalar_lookup": scalar_lookup,
    "plant_list": lambda t: stage.plant_list(t["internal_shipments"]),
    "invoice_stage": invoice_stage,
}


def query(job: Job) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(job(adapted_tables(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: query(job) for key, job in JOBS.items()}
