"""What keeps shuffles, tasks and broadcasts in step with the input."""

import datetime as dt
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from tallyline import catalog
from tallyline.functions.dates import period_month
from tallyline.operators import units
from tallyline.operators.joins import spread_join, unsalted
from tallyline.plans import invoice_stage, margin, sales_org, tonnage_load, tonnage_report
from tallyline.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def organisation(spark):
    """Six reps, two groups with one name and text, links that repeat under both numbers, equal links of one team."""
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    people = range(1, 7)
    member = "team_member_id long, team_id int, resource_type string, category string, category_name string, resource_number string, person_id long, delete_flag string"
    return Tables(dict(
        jtf_rs_salesreps=frame([(k, str(k), k, k, 0, "A", None) for k in people],
                               "salesrep_id long, salesrep_number string, resource_id long, person_id long, org_id int, status string, email_address string"),
        jtf_rs_resource_extns_vl=frame([(k, f"R{k}", f"rep {k}", "EMPLOYEE", None) for k in people],
                                       "resource_id long, resource_number string, resource_name string, category string, end_date_active date"),
        jtf_rs_group_members_vl=frame([(k, g, k, f"R{k}", k, "N") for k in people for g in (1, 2) if k < 6 and (g == 1 or k % 2)],
                                      "group_member_id long, group_id long, resource_id long, resource_number string, person_id long, delete_flag string"),
        jtf_rs_defresroles_vl=frame([(k, "RS_GROUP_MEMBER", "Sales Group Reporting", "N") for k in people],
                                    "role_resource_id long, role_resource_type string, role_name string, delete_flag string"),
        jtf_rs_groups_vl=frame([(1, "G1", "same", None), (2, "G2", "same", None)], "group_id long, group_number string, group_name string, group_desc string"),
        jtf_rs_teams_vl=frame([(1, "1", "one", None, None, None), (2, "2", "two", "one", None, None)],
                              "team_id int, team_number string, team_name string, team_desc string, attribute1 string, end_date_active date"),
        jtf_rs_team_members_vl=frame(
            [(10, 1, "GROUP", "c", "C", g, None, None) for g in ("G1", "G2")] + [(11, 1, "GROUP", "c", "C", "G1", None, None)]
            + [(12, 2, "GROUP", "c", "C", None, None, None), (13, 2, "INDIVIDUAL", "c", "C", "R6", 6, "N"), (13, 2, "INDIVIDUAL", "c", "C", "R6", 6, "N")], member),
    ).__getitem__)


def test_memberships_under_several_group_numbers_are_one_row(spark):
    t = organisation(spark)
    rows = sales_org.team_members(t).select("salesrep_id", "team_member_id", "team_id").collect()
    assert sorted(map(tuple, rows)) == sorted([(k, m, 1) for k in range(1, 6) for m in (10, 11)] + [(6, 13, 2)])


def test_reduced_memberships_are_those_of_team_members(spark):
    t = organisation(spark)
    whole = [tuple(r) for r in sales_org.team_members(t).select("salesrep_number", "team_number", "team_name", "team_desc").collect()]
    counted = sales_org.counted_members(t, ["salesrep_number"], ["team_number", "team_name", "team_desc"]).collect()
    assert {tuple(r)[:-1]: r["copies"] for r in counted} == Counter(whole)
    columns = ["salesrep_number", "team_number", "team_name", "team_desc"]
    assert sorted(map(tuple, sales_org.distinct_members(t, columns).collect()), key=str) == sorted(set(whole), key=str)


def test_pairs_of_reps_and_links_are_not_shuffled(tables):
    # a union of two distinct kinds, not a distinct over all pairs
    assert plan(sales_org.team_members(tables)).startswith("Union")
    # a rep's team is found without the single memberships
    assert "team_member_id" not in plan(sales_org.rep_team(tables))
    assert "team_member_id" not in plan(sales_org.rep_list(tables))


def test_copies_are_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(sales_org, "REPEAT_BLOCK", 4)
    rows = spark.createDataFrame([("a", 1), ("b", 4), ("c", 9)], "k string, copies long")
    found = sales_org._repeated(rows, "copies", ["k"]).groupBy("k").agg(F.count(F.lit(1))).collect()
    assert dict(map(tuple, found)) == {"a": 1, "b": 4, "c": 9}


def test_own_rates_ride_with_the_item(spark):
    rates = spark.createDataFrame(
        [(i, a, b, Decimal(n)) for i, a, b, n in [(1, "EA", "LB", 3), (1, "KG", "LB", 4), (1, "KG", "LB", 5), (2, "EA", "KG", 7), (None, "EA", "LB", 9)]],
        "inventory_item_id long, from_uom string, to_uom string, rate decimal(10,5)",
    )
    items = spark.createDataFrame([(1, "LB"), (2, "LB"), (3, None)], "inventory_item_id long, primary_uom_code string")
    rows = spark.createDataFrame(
        [(k, i, u) for k, (i, u) in enumerate([(1, "EA"), (1, "KG"), (2, "EA"), (2, "LB"), (3, "EA"), (9, "EA"), (None, "EA"), (1, None)])],
        "k int, inventory_item_id long, uom_code string",
    )
    whole = rows.join(items, "inventory_item_id", "left")
    expected = units.with_unit_rate(whole, rates, "rate", item="inventory_item_id", from_uom="uom_code", to_uom="primary_uom_code")
    known = units.with_own_rates(items, rates, "own", item="inventory_item_id", to_uom="primary_uom_code")
    found = units.with_rate_of_item(
        rows.join(known, "inventory_item_id", "left"), rates, "rate", own="own", from_uom="uom_code", to_uom="primary_uom_code"
    )
    assert sorted(map(str, found.select("k", "rate").collect())) == sorted(map(str, expected.select("k", "rate").collect()))


def test_the_salt_stays_a_key_and_later_joins_need_no_shuffle(spark):
    left = spark.range(100).selectExpr("id", "case when id % 2 = 0 then null else id end as k")
    right = [spark.range(100).selectExpr("id as k", f"id + {n} as v{n}") for n in (1, 2)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(left, right[0], ["k"], ["id"], then=right[1:])
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange hashpartitioning(k") == 3  # the rows once, each other frame once
        assert text.count("_salt") and joined.filter("k is null").count() == 50
        assert all(r["v1"] == r["k"] + 1 and r["v2"] == r["k"] + 2 for r in joined.filter("k is not null").collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staging_columns_ride_with_the_detail(tables):
    more = invoice_stage.attached_columns(tables)
    when = dict(as_of=dt.datetime(1998, 6, 15))
    riding = invoice_stage.invoice_stage(tables, margin.om_detail(tables, attach=more, **when), **when)
    # above the detail there is no join: it is found without one by the columns it took along
    bare = invoice_stage.invoice_stage(tables, margin.om_detail(tables, **when), **when)
    joins = [plan(df).count("Join ") for df in (riding, bare)]
    assert joins[0] == joins[1]
    rows = [sorted(map(str, df.collect())) for df in (riding, bare)]
    assert rows[0] == rows[1] and rows[0]


def test_items_are_not_broadcast(tables):
    text = tonnage_report.tonnage_by_org(tables, dt.date(1995, 1, 1), dt.date(2001, 12, 31), (101, 2))._jdf.queryExecution().executedPlan().toString()
    # the hinted item side is sorted and merged
    assert text.count("SortMergeJoin [organization_id") >= 6


def test_models_known_by_their_components_alone_give_one_empty_row(spark):
    rows = [(1, "Part1", "a"), (1, "Part2", "a"), (1, "Part2", "b"), (2, "Part2", "a"), (2, "Part2", "b"), (3, None, "a"), (None, "Part6", "a")]
    sides = unsalted(spark.createDataFrame(rows, "order_key long, part string, order_line string"), "order_key").withColumn("has_order_line", F.lit(True))
    found = margin._with_absent_models(sides).select("order_key", "part", "order_line", "has_order_line").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(*r, True) for r in rows] + [(2, None, None, None)], key=str)


def test_order_sides_are_shuffled_once_for_grouping_and_join(tables, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(9).selectExpr("id", "nullif(id, 3) as order_key")
        joined = spread_join(left, margin.order_sides(tables, margin.PARTS), ["order_key"], ["id"])
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the left rows and the order sides, once each
    assert text.count("Exchange hashpartitioning(order_key") == 2
    # costs travel as whole numbers
    assert all(f.dataType.typeName() == "long" for f in margin.order_sides(tables, margin.PARTS).schema if f.name.startswith("om_"))


def test_general_rates_shuffle_no_facts(spark):
    rates = spark.createDataFrame([(None, "KG", "LB", Decimal(2))], "inventory_item_id long, from_uom string, to_uom string, rate decimal(10,5)")
    rows = spark.range(9).selectExpr("id", "id as item", "if(id % 2 = 0, 'KG', 'EA') as uom")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = units.with_unit_rate(rows, rates, "rate", item="item", from_uom="uom", to_literal="LB")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin [" in text and "hashpartitioning(_from#" not in text.replace("hashpartitioning(_item", "")


def test_month_texts_are_made_of_months_and_not_of_rows(tables):
    text = plan(tables["gl_period_statuses"].filter(period_month(F.col("period_name")).isNotNull()))
    # the filter stands above the aggregate that finds the months
    assert text.index("Filter") < text.index("Aggregate") and "gettimestamp" not in text[text.index("Aggregate"):].lower()


def test_orders_of_one_rep_meet_it_in_several_tasks(tables):
    text = plan(tonnage_load._direct_attributes(tables))
    assert f"% {tonnage_load.REP_SPREAD}" in text or f", {tonnage_load.REP_SPREAD}" in text
    keys = tonnage_load._direct_attributes(tables)
    assert keys.count() == keys.select("order_number").distinct().count()


def test_ledger_computes_its_summary_once(tables, monkeypatch):
    steps = []

    def seen(store, chunks, rows_of, period):
        steps.extend(plan(rows_of(months)) for months in chunks.values())
        return history(store, chunks, rows_of, period)

    history = catalog.loads.load_history
    monkeypatch.setattr(catalog.loads, "load_history", seen)
    assert catalog.load_ledger(tables).filter("not agrees").count() == 0
    assert len(steps) == 2 and not any("Join" in s or "Aggregate" in s for s in steps)
