"""Adapters: source-system shaped tables, projected from the supplied star-schema tables.

Every adapter is one projection of one *base* (a supplied table, or one grain derived from
it). The column expressions are a SQL subset that means the same in Spark and in the
checking engine, so both sides read the same rows; everything above the adapters is
written twice, independently.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyline.sources.tables import Tables

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class Adapter(NamedTuple):
    base: str
    columns: dict[str, str]
    where: str | None = None


MONTH_TEXT = (
    "concat(substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC',cast(3*month(d)-2 as int),3),"
    "'-',substr(cast(year(d) as string),3,2))"
)
ORG = "cast(81+supp_id%5 as int)"
ORG_OF_LINE = "cast(case when order_key%10=8 then 1 else 0 end as int)"
BRAND_NO = "cast(substr(p_brand,7,2) as int)"
CATEGORY_ID = (
    f"{BRAND_NO}*10+case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 when 'MEDIUM' then 3 "
    "when 'PROMO' then 4 when 'SMALL' then 5 else 6 end"
)
SEGMENTS = {
    "segment1": "cast(supp_id%2 as string)",
    "segment2": "cast(supp_id%3 as string)",
    "segment3": "cast(supp_id%5 as string)",
    "segment4": "cast(supp_id%7 as string)",
    "segment5": "cast(supp_id%11 as string)",
}
ACCOUNT_ID = "{account} + cast(l_suppkey%3 as int)"
TEAM = {
    "team_id": "id",
    "team_number": "cast(id as string)",
    "team_name": "concat(nm,' Team')",
    "team_desc": "case when up is null then null else concat(up,' Team') end",
    "attribute1": "case when id>=100 then null else cast(id%10 as string) end",
    "end_date_active": "case when id%12=5 then date '1997-01-01' else cast(null as date) end",
}
PERSON = "case when s_suppkey%8=7 then null else s_suppkey end"

ADAPTERS: dict[str, Adapter] = {
    # ---- organisations, items, categories ----
    "mtl_parameters": Adapter("region", {
        "organization_id": "cast(81+r_regionkey as int)",
        "organization_code": "substr(r_name,1,3)",
    }),
    "hr_all_organization_units": Adapter("region", {
        "organization_id": "cast(r_regionkey as int)",
        "name": "concat(r_name,' OU')",
    }),
    "mtl_system_items_b": Adapter("part_org", {
        "organization_id": "cast(81+r as int)",
        "inventory_item_id": "p_partkey",
        "segment1": "p_name",
        "primary_uom_code": "'EA'",
        "weight_uom_code": "case when p_size%2=0 then 'LB' else 'KG' end",
        "unit_weight": "cast(nullif(p_size,50) as decimal(9,4))",
    }),
    "mtl_categories": Adapter("category", {
        "category_id": CATEGORY_ID,
        "structure_id": f"case when {BRAND_NO}=25 then 102 else 101 end",
        "segment1": "p_type",
        "segment2": "p_brand",
        "segment3": f"case when {BRAND_NO}%3=0 then 'X' else cast(null as string) end",
        "segment4": "cast(null as string)",
    }),
    "mtl_item_categories": Adapter("part_org_set", {
        "organization_id": "cast(81+r as int)",
        "inventory_item_id": "p_partkey",
        "category_set_id": "s+1",
        "category_id": CATEGORY_ID,
    }, "s=0 or p_partkey%20=0"),
    "mtl_category_sets": Adapter("region", {
        "category_set_id": "r_regionkey+1",
        "category_set_name": "case r_regionkey when 0 then 'Inventory' when 1 then 'Other' else r_name end",
        "structure_id": "case when r_regionkey<2 then 101 else 50328 end",
    }),
    "fnd_flex_value_sets": Adapter("region", {
        "flex_value_set_id": "1005933+r_regionkey",
        "flex_value_set_name": "case r_regionkey when 0 then 'WSB_PRODUCT_LINE_CATEGORY' else r_name end",
    }),
    "fnd_flex_values": Adapter("part_type_pair", {
        "flex_value_set_id": "1005933+s",
        "flex_value": "p_type",
        "attribute2": "case when s=1 then 'Frame' else case p_type when 'ECONOMY' then 'Frame' "
                      "when 'LARGE' then 'Hi-Tensile' when 'MEDIUM' then 'Trim' when 'PROMO' then "
                      "'Sheeting' when 'SMALL' then 'Accessories' else null end end",
    }),
    "uom_rates": Adapter("part_rate", {
        "inventory_item_id": "case when k=-1 then null else k end",
        "from_uom": "case when k=-1 then 'KG' else 'EA' end",
        "to_uom": "'LB'",
        "rate": "cast(case when k=-1 then 2.20462 when k is null then 1.5 else 3 end as decimal(10,5))",
    }),
    # ---- material transactions ----
    # kind 0: made or shipped stock; kinds 1, 2: issues and returns of order lines
    "mtl_material_transactions": Adapter("line_txn", {
        "transaction_id": "line_key*4+s",
        "organization_id": f"case when s=1 and line_number=3 and order_key%13=0 then 80 else {ORG} end",
        "inventory_item_id": "item_id",
        "transaction_type_id": "case when s=0 then case flag when 'A' then 44 when 'R' then 33 else 62 end "
                               "when line_number=5 then 15 else 33 end",
        "transaction_source_type_id": "case when s=0 then case flag when 'A' then 5 when 'R' then 2 else 8 end "
                                      "when line_number=5 then 12 else 2 end",
        "transaction_action_id": "case when s=0 then case flag when 'A' then 31 when 'R' then 1 else 21 end "
                                 "when line_number=5 then 27 else 1 end",
        "primary_quantity": "case when s=0 and flag='A' then quantity else -quantity end",
        "transaction_uom": "case line_number%3 when 0 then 'LB' when 1 then 'KG' else 'EA' end",
        "transaction_date": "ship_date",
        "transaction_reference": "case when line_number%2=0 then concat('REF',cast(order_key as string)) else null end",
        "transaction_source_name": "concat('SRC',cast(line_number as string))",
        "transaction_source_id": "case when s=0 then line_key else null end",
        "source_line_id": "case when s>0 and line_number<>5 then line_key else null end",
        "trx_source_line_id": "case when s>0 and line_number=5 then line_key else null end",
        "new_cost": "cast(case when order_key%3=0 then 0 else 1 end as decimal(18,4))",
    }),
    "mtl_transaction_accounts": Adapter("lineitem", {
        "transaction_id": "(l_orderkey*10+l_linenumber)*4+case when l_linenumber=2 and l_partkey%3=0 then 2 else 1 end",
        "accounting_line_type": "case l_returnflag when 'N' then 2 when 'A' then 36 else 1 end",
        "cost_element_id": "cast(l_suppkey%5+1 as int)",
        "base_transaction_value": "cast(l_extendedprice as decimal(18,4))",
    }, "l_linenumber<>4"),
    "mtl_transaction_types": Adapter("region", {
        "transaction_type_id": "case r_regionkey when 0 then 44 when 1 then 33 when 2 then 62 when 3 then 15 else 99 end",
        "transaction_type_name": "concat('Type ',r_name)",
        "description": "concat('About ',r_name)",
    }),
    "wip_entities": Adapter("line", {
        "wip_entity_id": "line_key",
        "wip_entity_name": "case when line_number=1 then cast(order_key as string) when line_number=2 then "
                           "concat('-',cast(order_key as string)) else concat(cast(order_key as string),'-',"
                           "cast(line_number as string),'-X') end",
    }),
    # ---- periods ----
    "org_acct_periods": Adapter("ship_month_org", {
        "organization_id": "cast(81+r as int)",
        "period_name": MONTH_TEXT,
        "period_start_date": "cast(date_trunc('month',d) as date)",
        "schedule_close_date": "case when r=4 then d+1 else d end",
    }),
    "gl_periods": Adapter("ship_month", {
        "period_set_name": "'WSB_13_Calendar'",
        "period_name": MONTH_TEXT,
        "start_date": "cast(date_trunc('month',d) as date)",
        "end_date": "d",
    }),
    "fnd_application": Adapter("region", {
        "application_id": "100+r_regionkey",
        "application_short_name": "case r_regionkey when 0 then 'AR' when 1 then 'SQLGL' when 2 then 'INV' else r_name end",
    }),
    "gl_period_statuses": Adapter("order_month_app", {
        "application_id": "100+s",
        "period_name": f"case when month(d)=6 and s=0 then concat('ADJ-',substr(cast(year(d) as string),3,2)) else {MONTH_TEXT} end",
        "closing_status": "case when d>date '1998-07-31' then 'N' when d>=date '1998-06-01' then 'O' else 'C' end",
        "last_update_date": "case when d=date '1998-05-31' then date '1998-06-12' else d end",
    }),
    # ---- purchasing ----
    "po_headers_all": Adapter("orders", {
        "po_header_id": "o_orderkey",
        "vendor_id": "o_orderkey%10",
        "type_lookup_code": "case o_custkey%3 when 0 then 'STANDARD' when 1 then 'PLANNED' else 'BLANKET' end",
        "closed_code": "case o_orderkey%4 when 0 then 'CLOSED' when 1 then 'OPEN' else null end",
        "cancel_flag": "case o_orderkey%7 when 0 then 'Y' when 1 then 'N' else null end",
    }),
    "po_lines_all": Adapter("line", {
        "po_line_id": "line_key",
        "po_header_id": "order_key",
        "line_type_id": "line_number%2+1",
        "closed_code": "case when line_number=6 then 'CLOSED' when line_number=3 then 'OPEN' else null end",
        "cancel_flag": "case when item_id%17=0 then 'Y' when item_id%17=1 then 'N' else null end",
    }),
    "po_line_locations_all": Adapter("line", {
        "line_location_id": "line_key",
        "po_line_id": "line_key",
        "shipment_type": "case when line_number=7 then 'PREPAYMENT' else 'STANDARD' end",
        "approved_flag": "case when order_key%6=0 then null else 'Y' end",
        "cancel_flag": "case when item_id%19=0 then 'Y' when item_id%19=1 then 'N' else null end",
        "closed_code": "case order_key%5 when 0 then 'CLOSED FOR INVOICE' when 1 then 'CLOSED' else null end",
        "quantity": "nullif(quantity,10)",
        "quantity_cancelled": "case when line_number=4 then quantity else null end",
        "quantity_received": "case when line_number=5 then 20 else null end",
    }),
    "po_distributions_all": Adapter("line_pair", {
        "po_distribution_id": "line_key*2+s",
        "line_location_id": "line_key",
        "wip_entity_id": "line_key",
        "bom_resource_id": "order_key%10",
    }, "s=0 or line_number=1"),
    "po_vendors": Adapter("supplier", {"vendor_id": "s_suppkey"}),
    "po_line_types": Adapter("region", {"line_type_id": "r_regionkey+1"}),
    "bom_resources": Adapter("supplier", {
        "resource_id": "s_suppkey",
        "attribute6": "case when s_suppkey%9=0 then null else 'Y' end",
    }),
    "wip_discrete_jobs": Adapter("line", {
        "wip_entity_id": "line_key",
        "organization_id": ORG,
        "primary_item_id": "item_id",
        "status_type": "case when order_key%3=0 then 4 else 3 end",
    }),
    "po_requisition_headers_all": Adapter("orders", {"requisition_header_id": "o_orderkey"}, "o_orderkey%10=0"),
    "po_requisition_lines_all": Adapter("orders", {
        "requisition_line_id": "o_orderkey",
        "requisition_header_id": "o_orderkey",
        "attribute1": "case when o_orderkey%30=0 then 'n/a' else cast((o_orderkey+1)*10+1 as string) end",
        "attribute_category": "case when o_orderkey%20=0 then 'ORDER ENTRY' else 'OTHER' end",
    }, "o_orderkey%10=0"),
    # ---- orders ----
    "oe_order_headers_all": Adapter("orders", {
        "header_id": "o_orderkey",
        "order_number": "o_orderkey",
        "salesrep_id": "case when o_orderkey%5=0 then -3 else o_orderkey%10 end",
        "order_type_id": "case when o_orderkey%5=0 then 9 else cast(substr(o_orderpriority,1,1) as int) end",
        "ship_from_org_id": "cast(81+o_custkey%5 as int)",
    }),
    "oe_order_lines_all": Adapter("line", {
        "line_id": "line_key",
        "header_id": "order_key",
        "top_model_line_id": "case when line_number in (1,2,3) then order_key*10+1 else null end",
        "line_number": "case when line_number=3 then 2 else line_number end",
        "shipment_number": "1",
        "ship_from_org_id": f"case when line_number=4 and order_key%17=0 then null else {ORG} end",
        "inventory_item_id": "item_id",
        "line_type_id": "case when line_number=3 then 2 when line_number=5 then 99 else line_number end",
        "source_document_line_id": "case when order_key%10=0 and line_number=1 then order_key else null end",
    # some models are known by their components alone
    }, "line_number<=5 and order_key%11<>0 and not (line_number=1 and order_key%13=0)"),
    "oe_transaction_types_tl": Adapter("region", {
        "transaction_type_id": "r_regionkey+1",
        "name": "concat('Line ',r_name)",
    }),
    "oe_transaction_types_all": Adapter("region", {
        "transaction_type_id": "r_regionkey+1",
        "attribute2": "case r_regionkey when 0 then '10' when 1 then '40' when 2 then '00' when 3 then '20' else null end",
    }),
    "mtl_sales_orders": Adapter("orders", {
        "segment1": "cast(o_orderkey as string)",
        "segment2": "case substr(o_orderpriority,1,1) when '1' then 'HOU-COMPONENT ORDER' when '2' then "
                    "'ATL-COMPONENT ORDER' else 'STANDARD' end",
    }),
    # ---- receivables ----
    "ra_cust_trx_types_all": Adapter("region_pair", {
        "cust_trx_type_id": "r_regionkey+1",
        "org_id": "s",
        "description": "concat('Invoice type ',cast(r_regionkey+1 as string))",
    }),
    "ra_customer_trx_all": Adapter("orders", {
        "customer_trx_id": "o_orderkey",
        "trx_number": "concat('T',cast(o_orderkey as string))",
        "trx_date": "o_orderdate",
        "complete_flag": "case when o_orderstatus='P' then 'N' else 'Y' end",
        "cust_trx_type_id": "cast(substr(o_orderpriority,1,1) as int)",
        "org_id": "cast(case when o_orderkey%10=8 then 1 else 0 end as int)",
        "sold_to_customer_id": "case when o_custkey%7=0 then null else o_custkey end",
        "bill_to_customer_id": "o_custkey",
        "bill_to_site_use_id": "o_custkey*2+1",
        "primary_salesrep_id": "o_orderkey%10",
    }),
    "ra_customer_trx_lines_all": Adapter("line", {
        "customer_trx_line_id": "line_key",
        "customer_trx_id": "order_key",
        "org_id": ORG_OF_LINE,
        "line_number": "line_number",
        "line_type": "case when line_number=7 then 'FREIGHT' else 'LINE' end",
        "description": "concat('Line ',cast(line_number as string))",
        "inventory_item_id": "case when line_number in (6,7) then null else item_id end",
        "warehouse_id": ORG,
        "interface_line_attribute1": "cast(order_key as string)",
        "interface_line_attribute6": "case when line_number=6 then 'n/a' else cast(line_key as string) end",
        "quantity_invoiced": "case when line_number=5 then null else quantity end",
        "quantity_credited": "case when line_number=5 then -quantity else null end",
        "uom_code": "case line_number%3 when 0 then 'LB' when 1 then 'KG' else 'EA' end",
        "unit_standard_price": "cast(item_id%100 as decimal(18,4))",
        "unit_selling_price": "cast(item_id%90 as decimal(18,4))",
        "extended_amount": "price",
    }),
    "ra_cust_trx_line_gl_dist_all": Adapter("lineitem_pair", {
        "customer_trx_line_id": "l_orderkey*10+l_linenumber",
        "customer_trx_id": "l_orderkey",
        "gl_date": "l_shipdate",
        "acctd_amount": "cast(case when l_discount=0 then 0 when l_returnflag='R' then -1 else 1 end * l_extendedprice "
                        "as decimal(18,4))",
        "code_combination_id": ACCOUNT_ID.format(
            account="case when s=1 and l_partkey%2=0 then 30 else 0 end + case when l_linenumber=7 and "
                    "l_linestatus='O' then 3 when l_linestatus='F' then 0 when l_suppkey%2=0 then 6 else 9 end"),
    }, "s=0 or l_partkey%13=0"),
    "gl_code_combinations": Adapter("nation_triple", {
        "code_combination_id": "n_nationkey+25*s",
        "segment1": "case when n_nationkey+25*s>=30 then 'B' else 'A' end",
        "segment2": "case (n_nationkey+25*s)%3 when 0 then '10' when 1 then '40' else '00' end",
        "segment5": "case (n_nationkey+25*s)%30-(n_nationkey+25*s)%3 when 0 then '3041' when 3 then '6415' "
                    "when 6 then '2405' when 9 then '1210' when 12 then '3010' when 15 then '4138' when 18 then "
                    "'6405' when 21 then '6410' when 24 then '4309' else '9999' end",
    }),
    "hz_cust_accounts": Adapter("customer", {
        "cust_account_id": "c_custkey",
        "party_id": "c_custkey+1000000",
        "account_number": "concat('A',cast(c_custkey as string))",
    }),
    "hz_parties": Adapter("customer", {"party_id": "c_custkey+1000000", "party_name": "lower(c_name)"}),
    "hz_cust_site_uses_all": Adapter("customer", {
        "site_use_id": "c_custkey*2+1",
        "cust_acct_site_id": "c_custkey+500",
    }),
    "hz_cust_acct_sites_all": Adapter("customer", {
        "cust_acct_site_id": "c_custkey+500",
        "territory": "concat('NATION_',cast(c_nationkey as string))",
    }),
    # ---- projects ----
    "pa_projects_all": Adapter("customer", {
        "project_id": "c_custkey",
        "segment1": "cast(c_custkey as string)",
        "project_type": "case c_mktsegment when 'BUILDING' then 'WSB BUILDINGS' when 'MACHINERY' then "
                        "'WSB PROJECT SERVICES' when 'AUTOMOBILE' then 'WSB COMMON' when 'FURNITURE' then null "
                        "else 'WSB OTHER' end",
    }),
    "pa_project_customers": Adapter("customer_pair", {
        "project_id": "c_custkey",
        "customer_id": "c_custkey+s",
        "customer_bill_split": "cast(case when s=0 then 62.5 else 37.5 end as decimal(9,4))",
    }),
    "pa_draft_revenues_all": Adapter("orders", {
        "project_id": "o_custkey",
        "draft_revenue_num": "o_orderkey",
        "gl_date": "o_orderdate",
    }),
    "pa_draft_revenue_items": Adapter("line_order", {
        "project_id": "o_custkey",
        "draft_revenue_num": "order_key",
        "line_num": "line_number",
    }),
    "pa_cust_event_rdl_all": Adapter("lineitem_order", {
        "project_id": "o_custkey",
        "draft_revenue_num": "l_orderkey",
        "draft_revenue_item_line_num": "l_linenumber",
        "amount": "cast(l_extendedprice as decimal(18,4))",
        "code_combination_id": ACCOUNT_ID.format(
            account="case l_partkey%6 when 0 then 12 when 1 then 3 when 2 then 15 when 3 then 18 when 4 then 21 else 24 end"),
    }),
    "pa_expenditure_items_all": Adapter("orders", {
        "project_id": "o_custkey",
        "expenditure_item_id": "o_orderkey",
        "burden_cost": "cast(o_totalprice as decimal(18,4))",
    }),
    "pa_cost_distribution_lines_all": Adapter("orders", {
        "project_id": "o_custkey",
        "expenditure_item_id": "o_orderkey",
        "gl_date": "o_orderdate",
        "dr_code_combination_id": "case substr(o_orderpriority,1,1) when '1' then 15 when '2' then 18 when '3' then 21 "
                                  "when '4' then 24 else 27 end + o_orderkey%3",
    }),
    # ---- sales organisation ----
    "jtf_rs_salesreps": Adapter("supplier", {
        "salesrep_id": "s_suppkey",
        "salesrep_number": "cast(s_suppkey as string)",
        "name": "s_name",
        "resource_id": "s_suppkey",
        "person_id": PERSON,
        "org_id": "cast(case when s_suppkey%9=8 then 1 else 0 end as int)",
        "status": "case when s_suppkey%2=0 then 'A' else 'I' end",
        "email_address": "concat(cast(s_suppkey as string),'@example.com')",
    }),
    "jtf_rs_resource_extns_vl": Adapter("supplier", {
        "resource_id": "s_suppkey",
        "resource_number": "concat('R',cast(s_suppkey as string))",
        "resource_name": "s_name",
        "category": "case when s_nationkey%6=0 then 'TBH' else 'EMPLOYEE' end",
        "attribute1": "case when s_suppkey%4=0 then null else cast(s_suppkey%4 as string) end",
        "attribute2": "cast(s_suppkey%5 as string)",
        "attribute3": "cast(s_suppkey%6 as string)",
        "attribute4": "cast(s_suppkey%5 as string)",
        "end_date_active": "case when s_suppkey%11=0 then date '1999-12-31' else cast(null as date) end",
    }),
    "jtf_objects_vl": Adapter("region", {
        "object_code": "case r_regionkey when 0 then 'EMPLOYEE' when 1 then 'OTHER' when 2 then 'PARTY' when 3 then "
                       "'PARTNER' else 'SUPPLIER_CONTACT' end",
    }),
    "jtf_rs_groups_vl": Adapter("region", {
        "group_id": "cast(r_regionkey as bigint)",
        "group_number": "concat('G',cast(r_regionkey as string))",
        "group_name": "concat('Group ',r_name)",
        "group_desc": "concat('About ',r_name)",
    }),
    "jtf_rs_group_members_vl": Adapter("supplier", {
        "group_member_id": "s_suppkey+1000",
        "group_id": "s_suppkey%5",
        "resource_id": "s_suppkey",
        "resource_number": "concat('R',cast(s_suppkey as string))",
        "person_id": PERSON,
        "delete_flag": "case s_suppkey%7 when 0 then null when 1 then 'Y' else 'N' end",
    }),
    "jtf_rs_defresroles_vl": Adapter("supplier", {
        "role_resource_id": "s_suppkey+1000",
        "role_resource_type": "case when s_suppkey%13=12 then 'RS_INDIVIDUAL' else 'RS_GROUP_MEMBER' end",
        "role_name": "case when s_suppkey%3=0 then 'Other' else 'Sales Group Reporting' end",
        "delete_flag": "case when s_suppkey%17=16 then 'Y' else 'N' end",
    }),
    "jtf_rs_teams_vl": Adapter("team", TEAM),
    "jtf_rs_teams_tl": Adapter("team", {k: TEAM[k] for k in ("team_id", "team_name", "team_desc")}),
    "jtf_rs_team_members_vl": Adapter("supplier_triple", {
        "team_member_id": "s_suppkey*3+s",
        "team_id": "cast(case when s=0 then s_nationkey else (s_suppkey*7+s)%25 end as int)",
        "team_resource_id": "case when s=2 then s_suppkey%5 else s_suppkey end",
        "resource_number": "case when s=2 then concat('G',cast(s_suppkey%5 as string)) else concat('R',cast(s_suppkey as string)) end",
        "resource_type": "case when s=2 then 'GROUP' else 'INDIVIDUAL' end",
        "person_id": PERSON,
        "category": "case when s=2 then 'GROUP' else 'EMPLOYEE' end",
        "category_name": "case when s=2 then 'Group' else 'Employee' end",
        "delete_flag": "case s_suppkey%3 when 0 then null when 1 then 'N' else 'Y' end",
    }, "s<2 or s_suppkey%4=0"),
    "ra_territories": Adapter("nation", {
        "territory_id": "n_nationkey",
        "name": "n_name",
        "description": "concat('Territory ',n_name)",
        "segment1": "concat('S',cast(n_nationkey as string))",
        "attribute1": "case when n_nationkey%5=0 then '1020' else '10' end",
    }),
    "ra_salesrep_territories": Adapter("supplier", {
        "salesrep_id": "s_suppkey",
        "territory_id": "s_nationkey",
        "start_date_active": "date '1996-01-01'",
        "end_date_active": "case s_suppkey%3 when 0 then cast(null as date) when 1 then date '1997-01-01' else date '1999-01-01' end",
    }, "s_suppkey%5<>4"),
    "per_all_people_f": Adapter("supplier_pair", {
        "person_id": "s_suppkey",
        "first_name": "case when s_suppkey%10=3 then null else 'First' end",
        "last_name": "s_name",
    }),
    "fnd_lookup_values": Adapter("region_six", {
        "lookup_type": "case s when 0 then 'WSB_SALESREP_TITLES' when 1 then 'WSB_DIVISIONS' when 2 then 'WSB_PLANTS' "
                       "when 3 then 'WSB_LINE_OF_BUSINESS' when 4 then 'WSB_SALES_TEAMS' else 'WSB_SALES_TEAM_MGRS' end",
        "lookup_code": "case when s=3 and r_regionkey=0 then '10' when s=3 and r_regionkey=1 then '1020' "
                       "else cast(r_regionkey as string) end",
        "meaning": "concat('Meaning ',cast(s as string),'_',cast(r_regionkey as string))",
        "description": "concat('Manager ',cast(r_regionkey as string))",
        "tag": "case when s=4 then cast((r_regionkey+1)%5 as string) else null end",
        "enabled_flag": "case when r_regionkey=2 then 'N' else 'Y' end",
        "end_date_active": "case when r_regionkey=3 then date '1997-01-01' else cast(null as date) end",
    }),
    # ---- staging helpers and stored state ----
    "margin_cogs_segments": Adapter("line", {"order_line_id": "line_key", **SEGMENTS}, "line_number<>3"),
    "margin_rev_segments": Adapter("line", {"customer_trx_line_id": "line_key", **SEGMENTS}, "line_number<>2"),
    "internal_shipments": Adapter("lineitem", {
        "order_line_id": "l_orderkey*10+l_linenumber",
        "internal_ship_from": "case l_suppkey%4 when 0 then 'ATL' when 1 then 'HOU' when 2 then 'CLE' else null end",
    }),
    "account_plan_interface": Adapter("customer_pair", {
        "customer_account_id": "c_custkey",
        "line_of_business": "case c_custkey%4 when 0 then '10' when 1 then '40' when 2 then '00' else null end",
        "summary_date": "case when s=0 then date '1998-05-01' else date '1998-06-01' end",
        "account_number": "case when c_custkey%2=0 then null else concat('A',cast(c_custkey as string)) end",
        "om_freight": "cast(10 as decimal(18,4))",
        "om_credits": "cast(20 as decimal(18,4))",
        "om_replacements": "cast(30 as decimal(18,4))",
        "om_revenue": "cast(100 as decimal(18,4))",
        "om_cost": "cast(40 as decimal(18,4))",
        "pa_invoice": "cast(60 as decimal(18,4))",
        "pa_freight": "cast(5 as decimal(18,4))",
        "pa_revenue": "cast(50 as decimal(18,4))",
        "pa_cost": "cast(25 as decimal(18,4))",
    }, "c_custkey%3=0"),
}
ADAPTERS["mtl_system_items"] = ADAPTERS["mtl_system_items_b"]
ADAPTERS["hz_cust_accounts_all"] = ADAPTERS["hz_cust_accounts"]
ADAPTERS["fnd_lookup_values_vl"] = ADAPTERS["fnd_lookup_values"]
ADAPTERS["jtf_rs_team_members"] = ADAPTERS["jtf_rs_team_members_vl"]


class _Bases:
    """Row sources of the adapters. Copies of a row are made by exploding a short array."""

    def __init__(self, spark: SparkSession, root: str):
        self._raw = {name: spark.read.parquet(f"{root}/{name}.parquet") for name in RAW}

    def get(self, name: str) -> DataFrame:
        return self._raw[name] if name in self._raw else getattr(self, name)()

    @staticmethod
    def _copies(df: DataFrame, n: int, column: str = "s") -> DataFrame:
        return df.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))

    @staticmethod
    def _exact_sum(column: str) -> Column:
        """Sum of a double with up to four decimals, added up in whole ten-thousandths."""
        units = F.sum(F.rint(F.col(column) * 10000).cast("bigint"))
        return (units.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,4)")

    def line(self) -> DataFrame:
        # one row per (order, line number); hashed by line_key, which later joins reuse
        grouped = (
            self._raw["lineitem"]
            .groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_key"))
            .agg(
                F.min("l_partkey").alias("item_id"),
                F.min("l_suppkey").alias("supp_id"),
                self._exact_sum("l_quantity").alias("quantity"),
                self._exact_sum("l_extendedprice").alias("price"),
                F.min("l_shipdate").alias("ship_date"),
                # the smallest flag, by its character code: numeric minima aggregate by hash
                F.min(F.ascii("l_returnflag")).alias("flag_code"),
            )
        )
        return grouped.selectExpr("*", "chr(flag_code) as flag", "line_key div 10 as order_key", "cast(line_key % 10 as int) as line_number")

    def line_pair(self) -> DataFrame:
        return self._copies(self.line(), 2)

    def line_txn(self) -> DataFrame:
        return self.line().selectExpr(
            "*",
            "explode(case when line_number=2 then array(0,1,2) when line_number in (1,3,5) "
            "then array(0,1) else array(0) end) as s",
        )

    def line_order(self) -> DataFrame:
        return self.line().join(self._raw["orders"], F.col("order_key") == F.col("o_orderkey"))

    def lineitem_pair(self) -> DataFrame:
        return self._copies(self._raw["lineitem"], 2)

    def lineitem_order(self) -> DataFrame:
        return self._raw["lineitem"].join(self._raw["orders"], F.col("l_orderkey") == F.col("o_orderkey"))

    def part_org(self) -> DataFrame:
        return self._copies(self._raw["part"], 5, "r")

    def part_org_set(self) -> DataFrame:
        return self._copies(self.part_org(), 2)

    def part_type_pair(self) -> DataFrame:
        return self._copies(self._raw["part"].select("p_type").distinct(), 2)

    def category(self) -> DataFrame:
        return self._raw["part"].select("p_type", "p_brand").distinct()

    def part_rate(self) -> DataFrame:
        # an own rate for every tenth item, and two general rates (no item) held by item 0
        own = self._raw["part"].filter("p_partkey%10=0").selectExpr("p_partkey as k")
        general = self._raw["part"].filter("p_partkey=0").selectExpr(
            "explode(array(cast(null as bigint), cast(-1 as bigint))) as k"
        )
        return own.unionByName(general)

    def _months(self, table: str, column: str) -> DataFrame:
        # the day is an aggregate, no key: filters on the texts made of it read the few months, not every row
        days = self._raw[table].groupBy(F.trunc(column, "MM").alias("m")).agg(F.max(F.last_day(column)).alias("d"))
        return days.select("d")

    def ship_month(self) -> DataFrame:
        return self._months("lineitem", "l_shipdate")

    def ship_month_org(self) -> DataFrame:
        return self._copies(self.ship_month(), 5, "r")

    def order_month_app(self) -> DataFrame:
        return self._copies(self._months("orders", "o_orderdate"), 3)

    def region_pair(self) -> DataFrame:
        return self._copies(self._raw["region"], 2)

    def region_six(self) -> DataFrame:
        return self._copies(self._raw["region"], 6)

    def nation_triple(self) -> DataFrame:
        return self._copies(self._raw["nation"], 3)

    def customer_pair(self) -> DataFrame:
        return self._copies(self._raw["customer"], 2)

    def supplier_pair(self) -> DataFrame:
        return self._copies(self._raw["supplier"], 2)

    def supplier_triple(self) -> DataFrame:
        return self._copies(self._raw["supplier"], 3)

    def team(self) -> DataFrame:
        area = "case r_name when 'ASIA' then 'TX Components' when 'EUROPE' then 'GA Components' else r_name end"
        region = self._raw["region"].selectExpr("r_regionkey", f"{area} as area")
        local = (
            self._raw["nation"]
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr("n_nationkey as id", "n_name as nm", "area as up")
        )
        return local.unionByName(
            region.selectExpr("100+r_regionkey as id", "area as nm", "cast(null as string) as up")
        )


def adapted_tables(spark: SparkSession, root: str) -> Tables:
    """Source-shaped tables over a directory of the supplied parquet files."""
    bases = _Bases(spark, root)

    def resolve(name: str) -> DataFrame:
        adapter = ADAPTERS[name]
        rows = bases.get(adapter.base)
        if adapter.where:
            rows = rows.filter(adapter.where)
        return rows.selectExpr(*[f"{expr} as {column}" for column, expr in adapter.columns.items()])

    return Tables(resolve)
