"""The tonnage fact: production by transaction with order, team, line of business and rep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.dates import month_name, period_month
from tallyline.functions.text import numeric_key, order_from_job, value_map
from tallyline.operators.bounds import scan_bounds
from tallyline.operators.intervals import interval_join
from tallyline.operators.joins import spread_join
from tallyline.operators.lookups import checked, several_values
from tallyline.operators.units import with_unit_rate
from tallyline.plans.product_lines import ITEM, item_product_lines
from tallyline.plans.sales_org import rep_team
from tallyline.plans.tonnage_report import pounds
from tallyline.sources.tables import Tables

ANY_TEAM = "*"
#: The fact's columns, and the accounting period by which the stored table is partitioned.
STORED_COLUMNS = (*fixed.TONNAGE_FACT_COLUMNS, "period_name")
TONS = "decimal(24,9)"
#: A few reps may have most of the orders: each rep's orders lie in that many tasks.
REP_SPREAD = 16


# ---------------------------------------------------------------- periods

def first_backfill_window(t: Tables, last_period: str, first_period: str = fixed.FIRST_TONNAGE_PERIOD) -> tuple[Column, Column]:
    """Bounds of a first load: the named first month up to the end of the chosen period."""
    return period_month(F.lit(first_period)), fiscal_window(t, last_period)[1]


def _in_window(low: Column, high: Column) -> Column:
    """Periods whose month begins inside a window; names that are no month are outside."""
    month = period_month(F.col("period_name"))
    return F.coalesce((month >= low) & (month <= high), F.lit(False))


def current_period(as_of: dt.date) -> str:
    return f"{fixed.MONTH_NAMES[as_of.month - 1]}-{as_of:%y}"


def fiscal_window(t: Tables, period_name: str) -> tuple[Column, Column]:
    fiscal = t["gl_periods"].filter(
        (F.col("period_set_name") == fixed.FISCAL_CALENDAR) & (F.col("period_name") == period_name)
    )
    return fiscal.agg(F.max("start_date")).scalar(), fiscal.agg(F.max("end_date")).scalar()


def periods_to_load(
    t: Tables, last_period: str, first_period: str = fixed.FIRST_TONNAGE_PERIOD,
    organizations: tuple[int, ...] = fixed.TONNAGE_ORGANIZATIONS,
) -> DataFrame:
    """Names of the accounting periods that a first load fills."""
    window = _in_window(*first_backfill_window(t, last_period, first_period))
    return t["org_acct_periods"].filter(F.col("organization_id").isin(*organizations) & window).select("period_name").distinct()


def period_bounds(t: Tables, low: Column, high: Column, organizations: tuple[int, ...]) -> DataFrame:
    """The plants' accounting periods whose month begins inside a window: [first_day, day_after).

    The closing day is inclusive: a day that two periods share doubles its transactions. A period
    that closes before it starts has no days.
    """
    first, last = F.col("period_start_date").cast("date"), F.col("schedule_close_date").cast("date")
    return (
        t["org_acct_periods"]
        .filter(F.col("organization_id").isin(*organizations) & _in_window(low, high) & (last >= first))
        .select("organization_id", "period_name", first.alias("first_day"), F.date_add(last, 1).alias("day_after"))
    )


def period_calendar(t: Tables, low: Column, high: Column, organizations: tuple[int, ...]) -> DataFrame:
    """The days of these periods, one row per plant, day and period; the fact is joined with the bounds instead."""
    days = F.sequence(F.col("first_day"), F.date_sub("day_after", 1))
    return period_bounds(t, low, high, organizations).select("organization_id", "period_name", F.explode(days).alias("day"))


# ---------------------------------------------------------------- orders and teams

def _reps_by_team(t: Tables) -> DataFrame:
    """(rep, organisation, name, wanted): reps whose person is in a team, by the team's description.

    ``wanted`` is a description, or ``*`` for any team that has one.
    """
    persons = (
        t["jtf_rs_team_members_vl"].select("team_id", "person_id")
        .join(t["jtf_rs_teams_vl"].select("team_id", "team_desc"), "team_id")
        .select("person_id", "team_desc")
        .filter(F.col("team_desc").isNotNull())
    )
    wanted = persons.unionByName(persons.withColumn("team_desc", F.lit(ANY_TEAM))).distinct()
    return t["jtf_rs_salesreps"].join(wanted, "person_id").select(
        "salesrep_id", "org_id", "name", F.col("team_desc").alias("wanted")
    )


def _reps_in_any_team(t: Tables) -> DataFrame:
    """Reps whose person is a member of any team, described or not."""
    members = t["jtf_rs_team_members_vl"].select("team_id", "person_id").join(
        t["jtf_rs_teams_vl"].select("team_id"), "team_id", "left_semi"
    )
    return t["jtf_rs_salesreps"].join(members.select("person_id"), "person_id", "left_semi").select("salesrep_id")


def _direct_orders(t: Tables) -> DataFrame:
    """Sales orders with the header of the same number and the team their kind asks for."""
    numbers = t["mtl_sales_orders"].select(
        F.col("segment1").alias("order_number"),
        numeric_key(F.col("segment1")).alias("_number"),
        F.coalesce(value_map(F.col("segment2"), fixed.TEAM_BY_ORDER_KIND), F.lit(ANY_TEAM)).alias("wanted"),
    )
    headers = t["oe_order_headers_all"].select(
        F.col("order_number").alias("_number"), "salesrep_id", "order_type_id"
    )
    return numbers.join(headers, "_number").drop("_number")


def _types(t: Tables) -> DataFrame:
    return t["oe_transaction_types_all"].select(
        F.col("transaction_type_id").alias("order_type_id"), F.col("attribute2").alias("lobo")
    )


def internal_order_path(t: Tables) -> DataFrame:
    """Internal order → requisition line → the standard order it was raised for.

    One row per path: internal order number, plant, and the standard order's number, rep and
    type. The requisition points at the standard line with text, which may be no number.
    """
    requisitions = (
        t["po_requisition_lines_all"]
        .filter(F.col("attribute_category") == fixed.REQUISITION_FROM_ORDER)
        .join(t["po_requisition_headers_all"].select("requisition_header_id"), "requisition_header_id", "left_semi")
        .select("requisition_line_id", numeric_key(F.col("attribute1")).alias("std_line_id"))
    )
    internal_lines = t["oe_order_lines_all"].filter(F.col("source_document_line_id").isNotNull()).select(
        F.col("source_document_line_id").alias("requisition_line_id"), F.col("header_id").alias("int_header_id")
    )
    standard_lines = t["oe_order_lines_all"].select(
        F.col("line_id").alias("std_line_id"), F.col("header_id").alias("std_header_id")
    )
    headers = t["oe_order_headers_all"]
    internal = headers.select(
        F.col("header_id").alias("int_header_id"), F.col("order_number").alias("int_order_number")
    )
    standard = headers.select(
        F.col("header_id").alias("std_header_id"),
        F.col("order_number").alias("std_order_number"),
        "salesrep_id",
        "order_type_id",
        F.col("ship_from_org_id").alias("organization_id"),
    )
    numbers = t["mtl_sales_orders"].select(
        F.col("segment1").alias("order_number"), numeric_key(F.col("segment1")).alias("int_order_number")
    )
    return (
        requisitions.join(internal_lines, "requisition_line_id")
        .join(internal, "int_header_id")
        .join(standard_lines, "std_line_id")
        .join(standard, "std_header_id")
        .join(_types(t), "order_type_id")
        .join(numbers, "int_order_number")
        .select("order_number", "organization_id", "std_order_number", "salesrep_id", "order_type_id", "lobo")
        .distinct()
    )


def _direct_attributes(t: Tables) -> DataFrame:
    """One row per order number: team, line of business and rep name of the order itself.

    The rep counts only if they are in a team the order may go to; the name only if the rep
    belongs to the main organisation. Each value comes with a flag that says whether it is
    ambiguous. Reps are brought to one row each first, and only those that have orders are copied, so
    that the orders of one rep meet them in several tasks.
    """
    main = F.col("org_id") == fixed.REP_ORGANIZATION
    reps = (
        _reps_by_team(t)
        .groupBy("salesrep_id", "wanted")
        .agg(
            F.max(F.when(main, F.col("name"))).alias("rep_name"),
            several_values(F.col("name"), main).alias("several_names"),
            (F.count(F.when(main, 1)) > 0).alias("named"),
        )
        .join(rep_team(t).select("salesrep_id", F.col("rollup_team").alias("team")), "salesrep_id", "left")
        .withColumn("in_team", F.lit(True))
        .join(t["oe_order_headers_all"].select("salesrep_id").distinct(), "salesrep_id", "left_semi")
    )
    spread = F.lit(REP_SPREAD).cast("bigint")
    copies = reps.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), spread - 1)))
    rows = (
        _direct_orders(t)
        .withColumn("_salt", F.pmod(F.xxhash64("order_number"), spread))
        .join(copies, ["salesrep_id", "wanted", "_salt"], "left")
        .join(_types(t).withColumn("typed", F.lit(True)), "order_type_id", "left")
        # order numbers hardly repeat: combining them before the shuffle would sort every row twice
        .repartition("order_number")
    )
    named = F.coalesce("named", F.lit(False))
    return rows.groupBy("order_number").agg(
        F.max("team").alias("direct_team"),
        several_values(F.col("salesrep_id"), F.col("in_team").isNotNull()).alias("reps"),
        F.max("lobo").alias("direct_lob"),
        several_values(F.col("lobo"), F.col("typed").isNotNull()).alias("lobs"),
        F.max("rep_name").alias("salesrep_name"),
        (several_values(F.col("rep_name"), named) | F.coalesce(F.max("several_names"), F.lit(False))).alias("names"),
    )


def _internal_attributes(t: Tables) -> DataFrame:
    """One row per (internal order, plant): team and line of business of the standard order."""
    reps = (
        _reps_in_any_team(t)
        .distinct()
        .join(rep_team(t).select("salesrep_id", F.col("rollup_team").alias("team")), "salesrep_id", "left")
        .withColumn("in_team", F.lit(True))
    )
    path = internal_order_path(t).join(reps, "salesrep_id", "left")
    return path.groupBy("order_number", "organization_id").agg(
        F.max("team").alias("internal_team"),
        several_values(F.col("salesrep_id"), F.col("in_team").isNotNull()).alias("internal_reps"),
        F.max("lobo").alias("internal_lob"),
        several_values(F.col("lobo")).alias("internal_lobs"),
    )


def with_order_attributes(t: Tables, rows: DataFrame, spread_by: list[str]) -> DataFrame:
    """Add ``team_desc``, ``lobo`` and ``salesrep_name`` by order number and plant.

    Team and line of business fall back from the order itself to the standard order behind an
    internal one, then to a fixed text. Everything about an order is gathered per order first,
    so the fact is joined twice in all; the default order number is spread.
    """
    hot = [fixed.NO_ORDER]
    pair = ["order_number", "organization_id"]
    one = spread_join(rows, _direct_attributes(t), ["order_number"], spread_by, hot=hot)
    both = spread_join(one, _internal_attributes(t), pair, spread_by, hot=hot)

    def value(name: str, flag: str) -> Column:
        return checked(F.col(name), F.col(flag), name, pair)

    helpers = (
        "direct_team direct_lob reps lobs names internal_team internal_lob internal_reps internal_lobs"
    ).split()
    return both.withColumns(
        {
            "team_desc": F.coalesce(
                value("direct_team", "reps"), value("internal_team", "internal_reps"), F.lit(fixed.NO_TEAM)
            ),
            "lobo": F.coalesce(
                value("direct_lob", "lobs"), value("internal_lob", "internal_lobs"), F.lit(fixed.NO_LOB)
            ),
            "salesrep_name": value("salesrep_name", "names"),
        }
    ).drop(*helpers)


def produced_orders(t: Tables) -> DataFrame:
    """Distinct (order number, plant) of completed production."""
    jobs = t["wip_entities"].select(F.col("wip_entity_id").alias("transaction_source_id"), "wip_entity_name")
    return (
        t["mtl_material_transactions"]
        .filter(F.col("transaction_type_id") == fixed.COMPLETION_TYPE)
        .select("transaction_source_id", "organization_id")
        .join(jobs, "transaction_source_id")
        .select(order_from_job(F.col("wip_entity_name"), fixed.NO_ORDER).alias("order_number"), "organization_id")
        .distinct()
    )


# ---------------------------------------------------------------- the fact

def completions_in_periods(t: Tables, calendar: DataFrame, organizations: tuple[int, ...]) -> DataFrame:
    """Completed production, once per accounting period its day lies in.

    The calendar's outer bounds are scalar subqueries of the date column's own type: they reach
    the scan, the exact days are the join's rest condition.
    """
    moves, when = t["mtl_material_transactions"], F.col("transaction_date")
    first, after = scan_bounds(calendar, F.col("first_day"), F.col("day_after"), moves.schema["transaction_date"].dataType)
    made = moves.filter(
        (F.col("transaction_type_id") == fixed.COMPLETION_TYPE)
        & (F.col("transaction_source_type_id") == fixed.COMPLETION_SOURCE_TYPE)
        & (F.col("transaction_action_id") == fixed.COMPLETION_ACTION)
        & F.col("organization_id").isin(*organizations)
        & (when >= first)
        & (when < after)
    )
    found = interval_join(made, calendar, ["organization_id"], "transaction_date", "first_day", "day_after")
    return found.drop("first_day", "day_after")


def tonnage_rows(t: Tables, low: Column, high: Column, organizations: tuple[int, ...]) -> DataFrame:
    calendar = period_bounds(t, low, high, organizations)
    jobs = t["wip_entities"].select(F.col("wip_entity_id").alias("transaction_source_id"), "wip_entity_name")
    lines = item_product_lines(t, structure=fixed.PRODUCT_LINE_STRUCTURE)
    # negative test: rows without a product line go too
    lines = lines.filter(F.col("product_line") != fixed.ACCESSORIES)
    items = t["mtl_system_items"].select(*ITEM, F.col("segment1").alias("item_code"), "unit_weight").hint("merge").join(lines, ITEM)
    types = t["mtl_transaction_types"].select("transaction_type_id", "transaction_type_name", "description")
    plants = t["mtl_parameters"].select("organization_id", F.col("organization_code").alias("org"))
    rows = (
        completions_in_periods(t, calendar, organizations)
        .join(types, "transaction_type_id")
        .join(items, ITEM)
        .join(plants, "organization_id")
        .join(jobs, "transaction_source_id")
        .withColumn("order_number", order_from_job(F.col("wip_entity_name"), fixed.NO_ORDER))
    )
    rated = with_unit_rate(
        rows, t["uom_rates"], "rate", item="inventory_item_id", from_uom="transaction_uom", to_literal="LB"
    )
    named = with_order_attributes(t, rated, spread_by=["transaction_id"])
    weight = pounds(F.col("rate"), F.col("primary_quantity"), F.col("unit_weight"))
    # an item in several category sets gives one row per set
    copies = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    full = named.withColumns(
        {
            "qty": (weight.cast("decimal(24,6)") / F.lit(fixed.POUNDS_PER_TON)).cast(TONS),
            "category": F.col("product_line"),
            "trans_month": month_name(F.col("transaction_date")),
            "wip_entity_id": F.col("transaction_source_id"),
            "_copy": copies,
        }
    )
    return full.select(*STORED_COLUMNS)


def tonnage_load(
    t: Tables, period_name: str, organizations: tuple[int, ...] = fixed.TONNAGE_ORGANIZATIONS
) -> DataFrame:
    """One fiscal period's rows of the fact."""
    return tonnage_rows(t, *fiscal_window(t, period_name), organizations)


def tonnage_backfill(
    t: Tables,
    last_period: str,
    first_period: str = fixed.FIRST_TONNAGE_PERIOD,
    organizations: tuple[int, ...] = fixed.TONNAGE_ORGANIZATIONS,
) -> DataFrame:
    """First load: every period from the named first month to the chosen one, in one pass."""
    low, high = first_backfill_window(t, last_period, first_period)
    return tonnage_rows(t, low, high, organizations)


def tonnage_refresh(
    t: Tables,
    target: DataFrame,
    requested: str | None,
    as_of: dt.date,
    *,
    first_load: bool | None = None,
    initial_flag: str | None = None,
    first_period: str = fixed.FIRST_TONNAGE_PERIOD,
    organizations: tuple[int, ...] = fixed.TONNAGE_ORGANIZATIONS,
    compat: bool = False,
) -> DataFrame:
    """New state of the fact table for a requested period.

    An empty target takes a first load up to the requested period. A filled one is refreshed for
    the current month only; asking for another period changes nothing. Without a requested
    period the current month is meant. ``compat`` reproduces the older behaviour for that case:
    no period dates are found, so nothing is loaded, and the current month is cleared when the
    initial-load flag is given and is not Y.
    """
    current = f"{as_of:%b-%y}".upper()
    if target.isEmpty():
        if requested is None:
            if compat:
                return target
            raise ValueError("a first load needs a period")
        return tonnage_backfill(t, requested, first_period, organizations).select(*target.columns)
    if requested is None and compat:
        clears = initial_flag is not None and initial_flag != "Y"
        return target.filter(~F.col("trans_month").eqNullSafe(current)) if clears else target
    if requested not in (None, current):
        return target
    fresh = tonnage_load(t, current, organizations)
    return target.filter(~_in_window(*fiscal_window(t, current))).unionByName(fresh.select(*target.columns))
