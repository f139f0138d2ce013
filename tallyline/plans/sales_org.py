"""Sales organisation: reps, groups, teams, managers, territories; the rep dimension.

These are dimension-sized tables. No join carries a hint: Spark broadcasts what it knows to
be small and shuffles the rest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyline import fixed_values as fixed
from tallyline.functions.predicates import active_on, not_deleted, strictly_not_deleted
from tallyline.functions.text import join_text, prefix_before, value_map
from tallyline.operators.joins import SPREAD
from tallyline.operators.lookups import active_lookup, decode_column, scalar_lookup
from tallyline.sources.tables import Tables

REPEAT_BLOCK = 10_000


def rep_base(t: Tables) -> DataFrame:
    """Reps of the main organisation with their resource, five resource categories."""
    reps = t["jtf_rs_salesreps"].filter(F.col("org_id") == fixed.REP_ORGANIZATION).select(
        "salesrep_id", "salesrep_number", "resource_id", "person_id", "status", "email_address"
    )
    resources = t["jtf_rs_resource_extns_vl"].filter(F.col("category").isin(*fixed.REP_CATEGORIES)).select(
        "resource_id", "resource_number", F.col("resource_name").alias("name"), "end_date_active"
    )
    return reps.join(resources, "resource_id")


def group_roles(t: Tables) -> DataFrame:
    """Group members that hold the reporting role; neither record may lack its N flag."""
    members = t["jtf_rs_group_members_vl"].filter(strictly_not_deleted(F.col("delete_flag"))).select(
        "group_member_id", "group_id", "resource_id"
    )
    roles = t["jtf_rs_defresroles_vl"].filter(
        (F.col("role_resource_type") == fixed.GROUP_MEMBER_ROLE_TYPE)
        & (F.col("role_name") == fixed.REPORTING_ROLE)
        & strictly_not_deleted(F.col("delete_flag"))
    ).select(F.col("role_resource_id").alias("group_member_id"))
    groups = t["jtf_rs_groups_vl"].select("group_id", "group_name")
    return members.join(roles, "group_member_id", "left_semi").join(groups, "group_id").select(
        "group_id", "group_name", "resource_id"
    ).distinct()


MEMBER_COLUMNS = (
    "team_number team_name team_desc team_end_date manager_number team_member_id team_id resource_type "
    "person_id category category_name resource_number name resource_id salesrep_number salesrep_id "
    "email_address group_name group_desc"
).split()
GROUP_SIDE = (
    "salesrep_id salesrep_number resource_id resource_number name email_address person_id group_name group_desc"
).split()
LINK_SIDE = [c for c in MEMBER_COLUMNS if c not in GROUP_SIDE]


def _group_reps(t: Tables, columns: Sequence[str]) -> DataFrame:
    """Reps with the groups whose reporting role they hold; ``_number`` is the group's."""
    links = (
        t["jtf_rs_group_members_vl"]
        .filter(not_deleted(F.col("delete_flag")))
        .select("resource_number", "group_id", F.col("resource_id").alias("member_resource_id"), "person_id")
        .join(
            group_roles(t).select("group_id", F.col("resource_id").alias("member_resource_id")),
            ["group_id", "member_resource_id"], "left_semi",
        )
        .join(t["jtf_rs_groups_vl"].select("group_id", F.col("group_number").alias("_number"), "group_name", "group_desc"), "group_id")
    )
    return _reps(t).join(links, "resource_number").select(*columns, "_number")


def _reps(t: Tables) -> DataFrame:
    return rep_base(t).select("salesrep_id", "salesrep_number", "resource_id", "resource_number", "name", "email_address")


def _team_links(t: Tables, kind: str) -> DataFrame:
    """Members of one kind with their team; ``_number`` is that of the group or resource."""
    teams = t["jtf_rs_teams_vl"].select(
        "team_id", "team_number", "team_name", "team_desc",
        F.col("attribute1").alias("manager_number"),
        F.col("end_date_active").alias("team_end_date"),
    )
    links = t["jtf_rs_team_members_vl"].filter(not_deleted(F.col("delete_flag")) & (F.col("resource_type") == kind)).select(
        "team_member_id", "team_id", "resource_type", "category", "category_name",
        F.col("resource_number").alias("_number"), F.col("person_id").alias("member_person_id"),
    )
    return links.join(teams, "team_id")


def _individual_members(t: Tables) -> DataFrame:
    links = _team_links(t, "INDIVIDUAL")
    return _reps(t).join(links, F.col("resource_number") == F.col("_number")).withColumns({
        "person_id": F.col("member_person_id"),
        "group_name": F.lit(None).cast("string"),
        "group_desc": F.lit(None).cast("string"),
    })


def _with_numbers(side: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of one side with all numbers they go by; rows without a number meet nothing."""
    numbers = F.sort_array(F.collect_set("_number")).alias("_numbers")
    return side.groupBy(*columns).agg(numbers).filter(F.size("_numbers") > 0)


def _met(reps: DataFrame, links: DataFrame) -> DataFrame:
    """Each rep row with each link row that shares a number, once: at the smallest number they share.

    Distinct sides give distinct pairs, so the pairs, of which there are as many as a group's reps times
    its links, are never shuffled. Groups are few and their pairs many: reps are spread, links copied.
    """
    left = reps.withColumns({
        "_number": F.explode("_numbers"), "_salt": F.pmod(F.xxhash64(*reps.columns), F.lit(SPREAD).cast("bigint")),
    })
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))
    right = links.withColumnRenamed("_numbers", "_link_numbers").withColumn("_number", F.explode("_link_numbers"))
    pairs = left.join(right.withColumn("_salt", F.explode(salts)), ["_number", "_salt"])
    once = (F.size("_numbers") == 1) | (F.size("_link_numbers") == 1)
    return pairs.filter(once | (F.col("_number") == F.array_min(F.array_intersect("_numbers", "_link_numbers"))))


def team_members(t: Tables) -> DataFrame:
    """Team membership of reps: through their group, or individually (distinct union).

    The two kinds differ in ``resource_type``, so each is made distinct by itself.
    """
    via_group = _met(
        _with_numbers(_group_reps(t, GROUP_SIDE), GROUP_SIDE), _with_numbers(_team_links(t, "GROUP"), LINK_SIDE)
    )
    individual = _individual_members(t).select(*MEMBER_COLUMNS).distinct()
    return via_group.select(*MEMBER_COLUMNS).unionByName(individual)


def distinct_members(t: Tables, columns: Sequence[str]) -> DataFrame:
    """Distinct values of some columns of `team_members`; both sides are reduced to them before they meet.

    A group's links to one team count once here, so rows grow with the reps and not with reps times links.
    """
    of_rep, of_link = [c for c in columns if c in GROUP_SIDE], [c for c in columns if c in LINK_SIDE]
    reps = _group_reps(t, of_rep).distinct()
    links = _team_links(t, "GROUP").select(*of_link, "_number").distinct()
    via_group = reps.join(links, "_number").select(*columns)
    return via_group.unionByName(_individual_members(t).select(*columns)).distinct()


def counted_members(t: Tables, of_rep: Sequence[str], of_link: Sequence[str]) -> DataFrame:
    """How many rows of `team_members` (``copies``) have the same values in some columns, without building those rows."""
    def counted(side: DataFrame, columns: Sequence[str], n: str) -> DataFrame:
        return side.groupBy(*columns, "_numbers").agg(F.count(F.lit(1)).alias(n))

    reps = counted(_with_numbers(_group_reps(t, GROUP_SIDE), GROUP_SIDE), of_rep, "_reps")
    links = counted(_with_numbers(_team_links(t, "GROUP"), LINK_SIDE), of_link, "_links")
    columns = [*of_rep, *of_link]
    via_group = _met(reps, links).select(*columns, (F.col("_reps") * F.col("_links")).alias("copies"))
    individual = _individual_members(t).select(*MEMBER_COLUMNS).distinct().select(*columns, F.lit(1).cast("bigint").alias("copies"))
    return via_group.unionByName(individual).groupBy(*columns).agg(F.sum("copies").alias("copies"))


def _repeated(rows: DataFrame, copies: str, spread_by: Sequence[str]) -> DataFrame:
    """Each row as often as ``copies`` says, in blocks; spread first, so that no task makes the copies of many rows."""
    size, n = F.lit(REPEAT_BLOCK).cast("bigint"), F.col(copies)
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / size)))
    inside = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(size, n - F.col("_block") * size)))
    spread = rows.repartition(*spread_by).withColumn("_block", blocks)
    return spread.withColumn("_nth", inside).drop("_block", "_nth", copies)


def team_rollup(t: Tables) -> DataFrame:
    """Each team with its parent: the team whose *name* is this team's description."""
    teams = t["jtf_rs_teams_vl"].select("team_id", "team_number", "team_name", "team_desc")
    return _with_rollup_id(t, teams)


def _with_rollup_id(t: Tables, df: DataFrame) -> DataFrame:
    parents = t["jtf_rs_teams_vl"].select(
        F.col("team_name").alias("team_desc"), F.col("team_number").alias("top_rollup_id")
    )
    return scalar_lookup(
        df, parents, ["team_desc"], ["top_rollup_id"], spread_by=["team_number"], distinct=True
    )


def _full_name(t: Tables, upper: bool) -> DataFrame:
    """Distinct names per person; a person has several dated records."""
    def part(name: str) -> Column:
        return F.upper(name) if upper else F.col(name)

    return t["per_all_people_f"].select(
        "person_id", join_text(part("first_name"), " ", part("last_name")).alias("person_name")
    ).distinct()


def team_manager(t: Tables, as_of: dt.date) -> DataFrame:
    """Active teams with the rep that manages them and that rep's upper-case full name."""
    reps = (
        rep_base(t)
        .join(_full_name(t, upper=True), "person_id", "left")
        .select(
            "salesrep_id", F.col("salesrep_number").alias("manager_number"), "status",
            # without a person record the name is the separator alone
            F.coalesce("person_name", F.lit(" ")).alias("manager_name"),
        )
        .distinct()
    )
    teams = t["jtf_rs_teams_vl"].filter(active_on(F.col("end_date_active"), as_of, inclusive=False)).select(
        "team_number", "team_name", "team_desc", F.col("attribute1").alias("manager_number")
    )
    return teams.join(reps, "manager_number", "left").select(
        "team_number", "team_name", "team_desc",
        F.when(F.col("salesrep_id").isNotNull(), F.col("manager_number")).alias("salesrep_number"),
        "manager_name",
    )


def rep_team(t: Tables) -> DataFrame:
    """Rep → roll-up team text (stands in for two database functions whose bodies are not known).

    A rep's team is the membership with the lowest team id; its roll-up is the parent named
    by the team, or the team itself when it has no parent.
    """
    return distinct_members(t, ["salesrep_id", "team_id", "team_name", "team_desc"]).groupBy("salesrep_id").agg(
        F.min_by(F.coalesce("team_desc", "team_name"), "team_id").alias("rollup_team"),
        F.min_by("team_name", "team_id").alias("own_team"),
    )


def rep_team_text(t: Tables) -> DataFrame:
    """Rep → ``roll-up team|own team``."""
    return rep_team(t).select("salesrep_id", join_text(F.col("rollup_team"), "|", F.col("own_team")).alias("team_text"))


def active_rep_territories(t: Tables, as_of: dt.date) -> DataFrame:
    """Territory assignments without an end date, or ending on the day or later."""
    return t["ra_salesrep_territories"].filter(active_on(F.col("end_date_active"), as_of)).select(
        "salesrep_id", "territory_id", "start_date_active"
    )


def sales_territory(t: Tables, as_of: dt.date) -> DataFrame:
    """Rep → territory → team → roll-up manager, 23 columns; every step is an outer join."""
    territories = t["ra_territories"].select(
        "territory_id",
        F.col("name").alias("territory"),
        F.col("description").alias("territory_text"),
        F.col("segment1").alias("territory_flexfield"),
        F.col("attribute1").alias("lob_id"),
    )
    # resource attributes exist only for reps whose resource category is a known object
    attributes = (
        t["jtf_rs_resource_extns_vl"]
        .join(t["jtf_objects_vl"].select(F.col("object_code").alias("category")), "category")
        .join(
            t["jtf_rs_salesreps"].filter(F.col("org_id") == fixed.REP_ORGANIZATION).select("resource_id", "salesrep_number"),
            "resource_id",
        )
        .select(
            "salesrep_number", F.col("attribute1").alias("title"),
            F.col("attribute2").alias("div"), F.col("attribute3").alias("plt"),
        )
    )
    # a rep's equal memberships of a team are counted and become rows again at the end
    teams = counted_members(t, ["salesrep_number"], ["team_number", "team_name", "team_desc"])
    managers = team_manager(t, as_of).select(
        "team_number",
        F.col("team_desc").alias("top_rollup_team"),
        F.col("salesrep_number").alias("top_rollup_number"),
        F.col("manager_name").alias("top_rollup_name"),
    )
    rows = (
        rep_base(t)
        .join(active_rep_territories(t, as_of), "salesrep_id", "left")
        .withColumnRenamed("territory_id", "assigned_territory_id")
        .join(territories, F.col("assigned_territory_id") == F.col("territory_id"), "left")
        .join(attributes, "salesrep_number", "left")
    )
    lookups = t["fnd_lookup_values_vl"]
    for kind, code, out in (
        (fixed.LOOKUP_LOB, "lob_id", "line_of_business"),
        (fixed.LOOKUP_TITLES, "title", "job_title"),
        (fixed.LOOKUP_DIVISIONS, "div", "division"),
        (fixed.LOOKUP_PLANTS, "plt", "plant"),
    ):
        rows = decode_column(rows, lookups, kind, code, out)
    rows = _with_rollup_id(t, rows.join(teams, "salesrep_number", "left")).join(managers, "team_number", "left")
    override = {fixed.MANUFACTURING_LOB_CODE: fixed.MANUFACTURING_TERRITORY}
    rows = _repeated(rows.withColumn("copies", F.coalesce("copies", F.lit(1))), "copies", ["salesrep_number", "team_number"])
    return rows.select(
        "*",
        value_map(F.col("lob_id"), override, F.col("territory_text")).alias("territory_desc"),
        F.col("team_number").alias("team_id"),
        F.col("team_name").alias("team"),
    ).select(*fixed.SALES_TERRITORY_COLUMNS)


def rep_list(t: Tables, *, ordered: bool = True) -> DataFrame:
    """Reps with title, team, roll-up team and manager; NULLs last when ordered."""
    columns = "salesrep_id salesrep_number name email_address resource_id team_name manager_number person_id".split()
    members = distinct_members(t, columns).select(
        "salesrep_id", F.col("salesrep_number").alias("sales_rep_number"), F.col("name").alias("sales_rep"),
        "email_address", "resource_id", F.col("team_name").alias("team"), "manager_number", "person_id",
    )

    titles = active_lookup(t["fnd_lookup_values"], fixed.LOOKUP_TITLES).select(
        F.col("lookup_code").alias("attribute1"), F.col("meaning").alias("title")
    )
    resource_titles = t["jtf_rs_resource_extns_vl"].select("resource_id", "attribute1").join(
        titles, "attribute1"
    ).select("resource_id", "title")
    managers = t["jtf_rs_salesreps"].select(
        F.col("salesrep_number").alias("manager_number"), "person_id"
    ).join(_full_name(t, upper=False), "person_id").select(
        "manager_number", F.col("person_name").alias("manager")
    )
    spread = ["salesrep_id", "team"]
    titled = scalar_lookup(members, resource_titles, ["resource_id"], ["title"], spread_by=spread)
    managed = scalar_lookup(titled, managers, ["manager_number"], ["manager"], spread_by=spread, distinct=True)
    rows = managed.join(rep_team_text(t), "salesrep_id", "left").withColumn(
        "rollup_team", prefix_before(F.col("team_text"), "|")
    ).select(*fixed.REP_LIST_COLUMNS).distinct()
    return rows.orderBy(F.asc_nulls_last("team"), F.asc_nulls_last("rollup_team")) if ordered else rows


def sales_rep_dimension(t: Tables) -> DataFrame:
    """One row per rep: title, team, roll-up and manager, from lakehouse tables.

    Of several team memberships the one with a missing delete flag wins, then N, then Y; equal
    flags are decided by the team id, then by name, title and manager, of which there may be one
    per language. The first-row filter is applied before the shuffle too,
    so a rep with very many memberships sends one row per task.
    """
    lookups = t["fnd_lookup_values"]
    resources = t["jtf_rs_resource_extns_vl"].select("resource_id", "attribute1", "attribute4")
    resources = decode_column(resources, lookups, fixed.LOOKUP_TITLES, "attribute1", "title")
    resources = decode_column(resources, lookups, fixed.LOOKUP_TEAMS, "attribute4", "manager_code", value="tag")
    resources = decode_column(
        resources, lookups, fixed.LOOKUP_TEAM_MANAGERS, "manager_code", "manager", value="description"
    ).select("resource_id", "title", "manager")
    memberships = t["jtf_rs_team_members"].select(
        F.col("team_resource_id").alias("resource_id"), "team_id", "team_member_id", "delete_flag"
    )
    names = t["jtf_rs_teams_tl"].select("team_id", "team_name", "team_desc")

    def without_suffix(column: str) -> Column:
        return F.replace(F.col(column), F.lit(" Team"), F.lit(""))

    rows = (
        t["jtf_rs_salesreps"]
        .join(resources, "resource_id", "left")
        .join(memberships, "resource_id", "left")
        .join(names, "team_id", "left")
        .select(
            "salesrep_id",
            F.col("salesrep_number").alias("sales_rep_number"),
            F.col("name").alias("sales_rep"),
            "email_address",
            "title",
            without_suffix("team_name").alias("team"),
            without_suffix("team_desc").alias("rollup_team"),
            "manager",
            "delete_flag",
            "person_id",
            "team_id",
            "team_member_id",
        )
    )
    first = Window.partitionBy("salesrep_id").orderBy(
        *[
            F.asc_nulls_first(c)
            for c in ("delete_flag", "team_id", "team_member_id", "team", "rollup_team", "title", "manager")
        ]
    )
    return rows.withColumn("r", F.row_number().over(first)).filter("r = 1").select(
        *fixed.SALES_REP_DIMENSION_COLUMNS
    )
