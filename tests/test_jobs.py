"""Invariants of the jobs, on small hand-made tables and on the adapted ones."""

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import catalog, fixed_values as fixed
from tallyline.plans import account_plan as plan, invoice_stage as stage, margin, projects, tonnage_load as fact
from tallyline.sources import sinks

M = "decimal(18,4)"


@pytest.fixture(scope="module")
def order(spark, tables):
    """One order: a model (line 11) with two components, each shipped; doubled distributions."""
    def rows(data, schema):
        return spark.createDataFrame(data, schema)

    d = Decimal
    when = dt.datetime(1998, 6, 3)
    return tables.with_tables(
        ra_cust_trx_line_gl_dist_all=rows(
            [(1, 1, 1, when, d(0)), (1, 1, 1, when, d(0)), (2, 1, 1, when, d(-7)), (3, 1, 4, when, d(9))],
            f"customer_trx_line_id bigint, customer_trx_id bigint, code_combination_id int, gl_date timestamp_ntz, acctd_amount {M}"),
        gl_code_combinations=rows([(1, "10", "3041"), (4, "10", "6415")], "code_combination_id int, segment2 string, segment5 string"),
        ra_customer_trx_all=rows(
            [(1, "T1", when, "Y", 1, 0, None, 2, 5, 3)],
            "customer_trx_id bigint, trx_number string, trx_date timestamp_ntz, complete_flag string, cust_trx_type_id int, "
            "org_id int, sold_to_customer_id bigint, bill_to_customer_id bigint, bill_to_site_use_id bigint, primary_salesrep_id bigint"),
        ra_customer_trx_lines_all=rows(
            [(1, 1, 0, 1, "LINE", "x", 7, 82, "1", "11", d(4), None, "LB", d(1), d(1), d(4)),
             (2, 1, 0, 2, "LINE", "x", 7, 82, "1", "14", None, d(-4), "EA", d(1), d(1), d(4)),
             (3, 1, 0, 3, "FREIGHT", "x", None, None, "1", "11", d(1), None, "EA", d(1), d(1), d(4))],
            f"customer_trx_line_id bigint, customer_trx_id bigint, org_id int, line_number int, line_type string, description string, "
            f"inventory_item_id bigint, warehouse_id int, interface_line_attribute1 string, interface_line_attribute6 string, "
            f"quantity_invoiced {M}, quantity_credited {M}, uom_code string, unit_standard_price {M}, unit_selling_price {M}, extended_amount {M}"),
        oe_order_lines_all=rows(
            [(11, 11, 1, 1, 82, 7, 1), (12, 11, 1, 1, 82, 7, 1), (13, 11, 1, 1, 82, 7, 1), (14, None, 4, 1, 82, 7, 1)],
            "line_id bigint, top_model_line_id bigint, line_number int, shipment_number int, ship_from_org_id int, "
            "inventory_item_id bigint, line_type_id int"),
        oe_transaction_types_tl=rows([(1, "Standard"), (1, "Standard")], "transaction_type_id int, name string"),
        mtl_material_transactions=rows(
            [(101, 7, 82, 33, 1, 12, None, d(1)), (102, 7, 82, 33, 1, 13, None, d(1)), (103, 7, 82, 15, 27, None, 14, d(1))],
            f"transaction_id bigint, inventory_item_id bigint, organization_id int, transaction_type_id int, transaction_action_id int, "
            f"source_line_id bigint, trx_source_line_id bigint, new_cost {M}"),
        mtl_transaction_accounts=rows(
            [(101, 2, 1, d(10)), (101, 36, 1, d(99)), (102, 36, 2, d(5))],
            f"transaction_id bigint, accounting_line_type int, cost_element_id int, base_transaction_value {M}"),
    )


def test_assembly_and_return_rules(order):
    rows = {r.query_identifier: r for r in margin.om_detail(order, as_of=catalog.MOMENT).collect()}
    assert set(rows) == {"Part2", "Part3", "Part4"}
    model = rows["Part2"]
    # the doubled distribution and the doubled type name count once for cost, each for replacements
    assert (model.om_cogs, model.om_replacements) == (Decimal("15.0000"), Decimal("60.0000"))
    assert (model.om_material, model.om_material_overhead) == (Decimal("10.0000"), Decimal("5.0000"))
    assert (model.order_line_id, model.order_line, model.customer) == (11, "1.1", "customer#000000002")
    # a return without accounting rows stays, without a cost
    back = rows["Part3"]
    assert (back.om_rev, back.om_cogs, back.om_credits, back.quantity) == (Decimal("-7"), None, Decimal("0"), Decimal("-4"))
    assert (rows["Part4"].om_freight, rows["Part4"].order_line, rows["Part4"].warehouse) == (Decimal("9"), None, None)


def test_one_pass_equals_the_six_parts(tables):
    def counted(*parts, refresh=True):
        columns = ("query_identifier", "customer_trx_line_id", "order_line_id", "gl_date", "om_rev", "om_cogs")
        rows = margin.margin_rows(tables, [dt.date(1998, 6, 1)], parts or margin.PARTS, refresh=refresh)
        return Counter(map(tuple, rows.select(*columns).collect()))

    whole = counted()
    assert whole == counted(refresh=False)
    assert whole == counted("Part1", "Part2", "Part3") + counted("Part4", "Part5") + counted("Part6")
    kinds = {p: {k[1] for k in whole if k[0] == p} for p in margin.PARTS}
    assert not kinds["Part3"] & kinds["Part6"]


def test_output_contracts(tables):
    detail = catalog.detail(tables)
    assert detail.columns == fixed.MARGIN_DETAIL_COLUMNS and len(detail.columns) == 49
    staged = stage.invoice_stage(tables, detail, as_of=catalog.MOMENT)
    assert len(staged.columns) == 65 and staged.columns[:49] == detail.columns
    for names, size in (
        (fixed.TONNAGE_FACT_COLUMNS, 18), (fixed.TONNAGE_REPORT_COLUMNS, 12), (fixed.SALES_TERRITORY_COLUMNS, 23),
        (fixed.REP_LIST_COLUMNS, 9), (fixed.SALES_REP_DIMENSION_COLUMNS, 11),
    ):
        assert len(names) == size


def test_plan_refresh_equals_loader_steps(spark):
    old = spark.createDataFrame(
        [(1, "10", dt.date(1998, 6, 1), None), (2, "10", dt.date(1998, 6, 1), None), (3, None, dt.date(1998, 5, 1), None)],
        "customer_account_id bigint, line_of_business string, summary_date date, account_number string",
    ).select("*", *[F.lit(7).cast(M).alias(m) for m in plan.MEASURES])

    def summary(rows, *measures):
        df = spark.createDataFrame(rows, "cust_account_id bigint, line_of_business string, summary_date date")
        return df.select("*", *[F.lit(5).cast(M).alias(m) for m in measures])

    june = dt.date(1998, 6, 1)
    orders = summary([(1, "10", june), (8, "40", june)], "om_freight", "om_credits", "om_replacements", "om_revenue", "om_cogs")
    billing = summary([(2, "10", june), (9, "40", june)], "pa_invoice", "pa_freight")
    revenue = summary([(1, "10", june), (7, "00", june)], "pa_revenue")
    cost = summary([(2, "10", june)], "pa_cost")
    batch = plan.combined_batch(orders, billing, revenue, cost)
    in_june = F.col("summary_date") == F.lit(june)
    new = {r.customer_account_id: r for r in plan.refreshed_interface(old, batch, in_june).collect()}
    steps = {r.customer_account_id: r for r in plan.account_plan_by_steps(old, orders, billing, in_june).collect()}
    for key, row in steps.items():
        for m in (*fixed.ORDER_MEASURES, *fixed.BILLING_MEASURES):
            assert new[key][m] == row[m], (key, m)
    assert new[8].pa_invoice == 0 and new[9].om_revenue is None and new[7].pa_invoice is None
    # revenue and cost are zeroed only together
    assert (new[1].pa_revenue, new[1].pa_cost) == (5, 7) and (new[2].pa_revenue, new[2].pa_cost) == (7, 5)
    assert (new[7].pa_revenue, new[7].pa_cost) == (5, 0) and (new[8].pa_revenue, new[8].pa_cost) == (0, 0)
    assert new[3].pa_cost == 7
    strict = {r.customer_account_id: r for r in plan.refreshed_interface(old, batch, in_june, strict=True).collect()}
    assert strict[1].pa_cost == 0


def test_tonnage_refresh_policy(spark, tables):
    kinds = dict(
        transaction_id="bigint", transaction_date="timestamp_ntz", qty=fact.TONS, transaction_source_id="bigint",
        wip_entity_id="bigint",
    )
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in fact.STORED_COLUMNS)
    old = spark.createDataFrame([], schema).unionByName(
        spark.createDataFrame([("MAY-98", 1), ("JUN-98", 2)], "trans_month string, transaction_id bigint"), allowMissingColumns=True
    )
    as_of = dt.date(1998, 6, 15)

    def months(df):
        return sorted(r.trans_month for r in df.select("trans_month").collect())

    assert months(fact.tonnage_refresh(tables, old, "MAY-98", as_of)) == ["JUN-98", "MAY-98"]
    assert months(fact.tonnage_refresh(tables, old, None, as_of, compat=True, initial_flag="N")) == ["MAY-98"]
    assert months(fact.tonnage_refresh(tables, old, None, as_of, compat=True)) == ["JUN-98", "MAY-98"]
    with pytest.raises(ValueError):
        fact.tonnage_refresh(tables, old.limit(0), None, as_of)


def test_static_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, m string")
    sinks.write_history(rows, path, "m")
    sinks.replace_period(rows.limit(0), path, "m", "a")
    assert [r.id for r in spark.read.schema("id bigint, m string").parquet(path).collect()] == [2]
    cut = sinks.reliable_checkpoint(rows, spark, fallback=str(tmp_path / "checkpoints"))
    assert cut.count() == 2


def test_refresh_of_a_full_load_is_the_full_load(tables):
    """The closing day of a period is the first day of the next one: its transactions count in both."""
    full = fact.tonnage_backfill(tables, catalog.LAST_PERIOD, catalog.FIRST_PERIOD)
    shared = full.groupBy("transaction_id").agg(F.countDistinct("period_name").alias("n")).filter("n > 1")
    assert shared.count() > 0
    for month in (dt.date(1998, 6, 15), dt.date(1998, 7, 1), dt.date(1997, 2, 3)):
        refreshed = fact.tonnage_refresh(tables, full, None, month, first_load=False)
        assert refreshed.exceptAll(full).count() == 0 and full.exceptAll(refreshed).count() == 0


def test_reversed_period_has_no_days(spark, tables):
    rows = spark.createDataFrame(
        [(82, "FEB-98", dt.datetime(1998, 2, 1), dt.datetime(1998, 1, 29)), (82, "MAR-98", dt.datetime(1998, 3, 1), dt.datetime(1998, 3, 2))],
        "organization_id int, period_name string, period_start_date timestamp_ntz, schedule_close_date timestamp_ntz",
    )
    low, high = F.lit(dt.date(1998, 1, 1)), F.lit(dt.date(1998, 12, 1))
    days = fact.period_calendar(t=tables.with_tables(org_acct_periods=rows), low=low, high=high, organizations=(82,))
    assert {r.period_name for r in days.collect()} == {"MAR-98"} and days.count() == 2


def test_a_period_is_swapped_only_by_a_job_that_succeeds(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "id bigint, m string"
    sinks.write_history(spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "x/y=z")], schema), path, "m")

    def stored():
        return {(r.id, r.m) for r in spark.read.schema(schema).parquet(path).collect()}

    failing = spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"), F.lit("a").alias("m"))
    with pytest.raises(Exception, match="no"):
        sinks.replace_period(failing, path, "m", "a")
    assert stored() == {(1, "a"), (2, "b"), (3, None), (4, "x/y=z")}
    own = spark.read.schema(schema).parquet(path).filter("m = 'a'").withColumn("id", F.col("id") + 10)
    sinks.replace_period(own, path, "m", "a")
    assert stored() == {(11, "a"), (2, "b"), (3, None), (4, "x/y=z")}
    rows = spark.createDataFrame([(7, "any")], schema)
    sinks.replace_period(rows, path, "m", None)
    sinks.replace_period(rows, path, "m", "x/y=z")
    assert stored() == {(11, "a"), (2, "b"), (7, None), (7, "x/y=z")}
    for value in (None, "x/y=z"):
        sinks.replace_period(rows.limit(0), path, "m", value)
    assert stored() == {(11, "a"), (2, "b")}


def test_refresh_limits_transactions_and_their_accounts(tables):
    def semi_joins(months):
        rows = margin.order_line_transactions(tables, margin.asked_order_lines(tables, months) if months else None)
        return [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in x]

    assert not semi_joins(None)
    assert any("(transaction_id" in x for x in semi_joins(catalog.MONTH)) and any("(line_id" in x for x in semi_joins(catalog.MONTH))


def test_table_sinks(spark):
    rows = spark.createDataFrame([(1, "a")], "id bigint, m string")
    sinks.replace_table(rows, "stored_rows", provider="parquet")
    # columns are written by name and order of the contract, not by position of the frame
    sinks.append_rows(spark.createDataFrame([("b", 2)], "m string, id bigint"), "stored_rows", ["id", "m"])
    assert sorted(map(tuple, spark.table("stored_rows").collect())) == [(1, "a"), (2, "b")]
    sinks.replace_table(rows, "stored_rows", provider="parquet")
    assert spark.table("stored_rows").count() == 1


def test_period_bounds_reach_the_scan(tables, capsys):
    recent = plan.limited_to_periods(tables, plan.open_periods(tables, catalog.AS_OF))
    for name, column in (("pa_cost_distribution_lines_all", "o_orderdate"), ("ra_cust_trx_line_gl_dist_all", "l_shipdate")):
        recent[name].explain("formatted")
        text = capsys.readouterr().out
        assert f"GreaterThanOrEqual({column},ScalarSubquery" in text and f"LessThan({column},ScalarSubquery" in text


def test_sales_views_and_tables(spark, tables):
    view = sinks.publish_view(catalog.JOBS["active_rows"](tables), "live_territories", ["salesrep_id", "territory_id"])
    assert spark.table("live_territories").columns == view.columns


@pytest.mark.parametrize("key", ["om_detail", "tonnage_by_org", "tonnage_load", "account_plan", "invoice_stage", "dim_sales_rep"])
def test_plans_stay_in_the_engine(spark, tables, key):
    text = catalog.JOBS[key](tables)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    if key == "dim_sales_rep":
        assert "WindowGroupLimit" in text


def test_month_filter_reaches_the_scan(tables):
    rows = projects.project_burden(tables, [dt.date(1998, 6, 1)])
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1998-06-01" in text


def test_hot_line_keeps_every_row(spark, tables):
    """A third of all shipments and accounts on one key: same result as brute force."""
    n = 3000
    ships = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("order_line_id"),
        F.element_at(F.array(*map(F.lit, ("HOU", "ATL"))), (F.col("id") % 2 + 1).cast("int")).alias("internal_ship_from"),
    )
    got = {r.order_line_id: r.manufacturing_plant for r in stage.plant_list(ships).collect()}
    want: dict[int, list[str]] = {}
    for i in range(n):
        want.setdefault(1 if i % 3 == 0 else i, []).append(("HOU", "ATL")[i % 2])
    assert got == {k: ", ".join(sorted(v)) for k, v in want.items()}
