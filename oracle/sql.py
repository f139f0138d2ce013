"""The checking side: every query again, as plain SQL for DuckDB.

Only the adapters' column expressions are shared with the library. The queries here take the
direct road (row-level joins, one branch per kind of line, window functions), so that they
check the library's rearranged plans.
"""

from __future__ import annotations

import re

from tallyline.sources.adapters import ADAPTERS

BASES = {
    "line": """
        select l_orderkey*10+l_linenumber as line_key, min(l_orderkey) as order_key,
               min(l_linenumber) as line_number, min(l_partkey) as item_id, min(l_suppkey) as supp_id,
               cast(sum(cast(l_quantity as decimal(18,4))) as decimal(18,4)) as quantity,
               cast(sum(cast(l_extendedprice as decimal(18,4))) as decimal(18,4)) as price,
               min(l_shipdate) as ship_date, min(l_returnflag) as flag
        from lineitem group by l_orderkey, l_linenumber""",
    "line_pair": "select * from base_line, (select unnest([0,1]) as s) c",
    "line_txn": """
        select * from base_line, (select unnest([0,1,2]) as s) c
        where s=0 or line_number=2 or (s=1 and line_number in (1,3,5))""",
    "line_order": "select * from base_line join orders on order_key=o_orderkey",
    "lineitem_pair": "select * from lineitem, (select unnest([0,1]) as s) c",
    "lineitem_order": "select * from lineitem join orders on l_orderkey=o_orderkey",
    "part_org": "select p.*, r_regionkey as r from part p, region",
    "part_org_set": "select * from base_part_org, (select unnest([0,1]) as s) c",
    "part_type_pair": "select * from (select distinct p_type from part) p, (select unnest([0,1]) as s) c",
    "category": "select distinct p_type, p_brand from part",
    "part_rate": """
        select p_partkey as k from part where p_partkey%10=0
        union all select null from part where p_partkey=0
        union all select -1 from part where p_partkey=0""",
    "ship_month": "select distinct last_day(l_shipdate) as d from lineitem",
    "ship_month_org": "select d, r_regionkey as r from base_ship_month, region",
    "order_month_app": """
        select * from (select distinct last_day(o_orderdate) as d from orders) m, (select unnest([0,1,2]) as s) c""",
    "region_pair": "select * from region, (select unnest([0,1]) as s) c",
    "region_six": "select * from region, (select unnest([0,1,2,3,4,5]) as s) c",
    "nation_triple": "select * from nation, (select unnest([0,1,2]) as s) c",
    "customer_pair": "select * from customer, (select unnest([0,1]) as s) c",
    "supplier_pair": "select * from supplier, (select unnest([0,1]) as s) c",
    "supplier_triple": "select * from supplier, (select unnest([0,1,2]) as s) c",
    "team": """
        select n_nationkey as id, n_name as nm, area as up from nation join base_area on n_regionkey=r_regionkey
        union all select 100+r_regionkey, area, null from base_area""",
    "area": """
        select r_regionkey, case r_name when 'ASIA' then 'TX Components' when 'EUROPE' then 'GA Components'
               else r_name end as area from region""",
}


def _adapter_sql(name: str) -> str:
    adapter = ADAPTERS[name]
    source = f"base_{adapter.base}" if adapter.base in BASES else adapter.base
    columns = ", ".join(f"{expr} as {column}" for column, expr in adapter.columns.items())
    return f"select {columns} from {source}" + (f" where {adapter.where}" if adapter.where else "")


def _product_line_sums(value: str, prefix: str = "") -> str:
    tests = {
        "frame": "= 'Frame'", "hi_tensile": "= 'Hi-Tensile'", "trim": "= 'Trim'", "sheeting": "= 'Sheeting'",
        "non_frame": "in ('Hi-Tensile','Trim','Sheeting')",
    }
    return ", ".join(
        f"sum(case when product_line {test} then {value} else 0 end) as {prefix}{name}" for name, test in tests.items()
    )


REPORT = (
    "frame non_frame osp_frame osp_non_frame osp_hi_tensile hi_tensile trim osp_trim sheeting osp_sheeting "
    "ship_confirmed"
).split()


def _doubles(columns: list[str], scale: int = 6) -> str:
    return ", ".join(f"cast(cast({c} as decimal(38,{scale})) as double) as {c}" for c in columns)


def _report(branches: str) -> str:
    """Combined report over three named branch relations."""
    made, osp, shipped = branches.split()
    own = {
        made: ["frame", "hi_tensile", "trim", "sheeting", "non_frame"],
        osp: ["osp_frame", "osp_hi_tensile", "osp_trim", "osp_sheeting", "osp_non_frame"],
        shipped: ["ship_confirmed"],
    }
    selects = []
    for relation, names in own.items():
        cells = ", ".join(c if c in names else f"0 as {c}" for c in REPORT)
        selects.append(f"select org, {cells} from {relation}")
    sums = ", ".join(f"sum({c}) as {c}" for c in REPORT if c != "ship_confirmed")
    return (
        f"select org, {_doubles(REPORT)} from (select org, {sums}, abs(sum(ship_confirmed)) as ship_confirmed "
        f"from ({' union '.join(selects)}) u group by org) v"
    )


COSTS = "om_cogs om_material om_material_overhead om_resource om_outside_processing om_overhead".split()


def _cost(name: str) -> str:
    element = {"om_material": 1, "om_material_overhead": 2, "om_resource": 3, "om_outside_processing": 4, "om_overhead": 5}
    extra = f" and cost_element_id={element[name]}" if name in element else ""
    v = "sum(base_transaction_value) filter (where accounting_line_type={}" + extra + ")"
    return f"coalesce({v.format(2)}, {v.format(36)}) as {name}"


INVOICE = (
    "customer_trx_line_id operating_unit line_of_business rev_gl_account territory sales_person cust_account_id "
    "account_number customer order_number invoice_type invoice_date invoice_number invoice_line inv_line_type "
    "line_desc gl_date quantity uom_code unit_standard_price unit_selling_price extended_amount om_freight "
    "om_credits om_rev"
).split()
ITEM_COLUMNS = (
    "item_key item_number primary_uom_code weight_uom_code unit_weight inventory_category1 inventory_category2 "
    "inventory_category3 inventory_category4"
).split()


def _branch(part: str, joins: str, *, order_line_id: str, costed: bool, text: str = "ol.order_line") -> str:
    """One kind of line with an item, at the grain of its joins."""
    figures = (
        [f"k.{c} as {c}" for c in COSTS]
        + ["case when m.new_cost<>0 and i.om_rev=0 then k.om_cogs else 0 end as om_replacements"]
        if costed else [f"0 as {c}" for c in [*COSTS, "om_replacements"]]
    )
    transaction = "m.transaction_id" if costed else "null"
    return (
        f"select '{part}' as query_identifier, {', '.join('i.' + c for c in INVOICE)}, {order_line_id} as order_line_id, "
        f"{text} as order_line, ty.name as order_line_type, p.organization_code as warehouse, "
        f"{', '.join('it.' + c for c in ITEM_COLUMNS)}, {', '.join(figures)}, {transaction} as txn "
        f"from invoice_rows i {joins} "
        "join item_dim it on it.organization_id=i.warehouse_id and it.item_key=i.inventory_item_id"
    )


def _plain_branch(part: str, where: str) -> str:
    nulls = ", ".join(f"null as {c}" for c in [*ITEM_COLUMNS])
    zeros = ", ".join(f"0 as {c}" for c in [*COSTS, "om_replacements"])
    return (
        f"select '{part}' as query_identifier, {', '.join('i.' + c for c in INVOICE)}, null as order_line_id, "
        f"null as order_line, null as order_line_type, null as warehouse, {nulls}, {zeros}, null as txn "
        f"from invoice_rows i where {where} and om_rev<>0"
    )


ISSUES = (
    "join moves m on m.transaction_type_id={kind} and m.{link}=ol.line_id and m.inventory_item_id=ol.inventory_item_id "
    "and m.organization_id=ol.ship_from_org_id left join costs k on k.transaction_id=m.transaction_id "
    "join mtl_parameters p on p.organization_id=ol.ship_from_org_id "
    "left join oe_transaction_types_tl ty on ty.transaction_type_id=ol.line_type_id"
)
KEYS_OF_DETAIL = (
    ["query_identifier", *INVOICE, "order_line_id", "order_line", "order_line_type", "warehouse", *ITEM_COLUMNS]
)

RATE = (
    "cast(coalesce((select max(rate) from uom_rates where inventory_item_id={item} and from_uom={src} and to_uom={dst}), "
    "(select max(rate) from uom_rates where inventory_item_id is null and from_uom={src} and to_uom={dst}), "
    "case when {src}={dst} then 1 end) as decimal(10,5))"
)

# round(num/den*100, 2), half away from zero, on whole numbers of 1/10000
PERCENT = (
    "case when om_rev<>0 then cast(sign(({n})*({d})) * "
    "((abs({n})*20000 + abs({d})) // (abs({d})*2)) as double)/100 else 0 end"
)
_N = "cast((om_rev-om_cogs)*10000 as hugeint)"
_D = "cast(om_rev*10000 as hugeint)"

DETAIL_VALUES = {
    "summary_date": "cast(cast(date_trunc('month', gl_date) as date) as varchar)",
    "om_gross_profit": "cast(om_rev-om_cogs as double)",
    "om_gross_profit_percent": PERCENT.format(n=_N, d=_D),
    "creation_date": "timestamp '1998-06-15 00:00:00'",
    "request_id": "cast(1 as bigint)",
    "market_quantity": "cast(cast(market_quantity as decimal(24,6)) as double)",
    "market_uom": "'LB'",
    **{c: f"cast({c} as double)" for c in (
        "quantity unit_standard_price unit_selling_price extended_amount om_freight om_credits om_rev "
        "om_replacements om_cogs").split()},
    **{c: f"cast(coalesce({c},0) as double)" for c in COSTS if c != "om_cogs"},
}
DETAIL = (
    "query_identifier customer_trx_line_id summary_date operating_unit line_of_business rev_gl_account territory "
    "sales_person cust_account_id account_number customer order_number order_line order_line_type invoice_type "
    "invoice_date invoice_number invoice_line inv_line_type line_desc gl_date warehouse item_number "
    "inventory_category1 inventory_category2 inventory_category3 inventory_category4 quantity uom_code "
    "unit_standard_price unit_selling_price extended_amount om_freight om_credits om_rev om_replacements om_cogs "
    "om_gross_profit om_gross_profit_percent creation_date request_id market_quantity market_uom om_material "
    "om_material_overhead om_resource om_outside_processing om_overhead order_line_id"
).split()


def _detail(columns: list[str], where: str = "true") -> str:
    cells = ", ".join(f"{DETAIL_VALUES[c]} as {c}" if c in DETAIL_VALUES else c for c in columns)
    return f"select {cells} from detail_rows where {where}"


MEASURES = "om_freight om_credits om_replacements om_revenue om_cost pa_invoice pa_freight pa_revenue pa_cost".split()
BILLING_JUNE = "(select * from billing where summary_date=date '1998-06-01')"
SAME_KEY = (
    "o.customer_account_id=b.cust_account_id and o.line_of_business is not distinct from b.line_of_business "
    "and o.summary_date=b.summary_date"
)
STAGE_EXTRA = (
    ", ".join(f"c.segment{i} as rev_{n}" for i, n in enumerate(("co", "lob", "loc", "dept", "gl"), 1)) + ", "
    + ", ".join(f"r.segment{i} as cogs_{n}" for i, n in enumerate(("co", "lob", "loc", "dept", "gl"), 1))
)


def _stage(user: str, where: str = "true") -> str:
    detail = ", ".join(
        f"{DETAIL_VALUES[c]} as {c}" if c in DETAIL_VALUES else f"{c} as {c}" for c in DETAIL
    )
    return (
        f"select d.*, {STAGE_EXTRA}, w.manufacturing_plant, upper(d.customer) as customername, "
        f"timestamp '1998-06-15 00:00:00' as load_creation_date, {user} as created_by, "
        f"timestamp '1998-06-15 00:00:00' as last_updated_date, {user} as last_updated_by "
        f"from (select {detail} from detail_rows) d "
        "left join margin_cogs_segments c on c.order_line_id=d.order_line_id "
        "left join margin_rev_segments r on r.customer_trx_line_id=d.customer_trx_line_id "
        f"left join plants_of_line w on w.order_line_id=d.order_line_id where {where}"
    )


def _interface(cells: dict[str, str], source: str, where: str = "true") -> str:
    names = ["customer_account_id", "line_of_business", "summary_date", "account_number", *MEASURES]
    out = []
    for n in names:
        value = cells.get(n, f"o.{n}")
        kind = "double" if n in MEASURES else "varchar" if n == "summary_date" else None
        if kind == "double":
            value = f"cast({value} as decimal(18,4))"
        out.append(f"cast({value} as {kind}) as {n}" if kind else f"{value} as {n}")
    return f"select {', '.join(out)} from {source} where {where}"


TONNAGE = (
    "org category trans_month transaction_date transaction_id transaction_reference transaction_source_name item_code "
    "qty transaction_type_name description transaction_source_id order_number wip_entity_name wip_entity_id team_desc "
    "lobo salesrep_name"
).split()
MEMBER_COLUMNS = (
    "team_number, team_name, team_desc, team_end_date, manager_number, team_member_id, team_id, resource_type, person_id, "
    "category, category_name, resource_number, name, resource_id, salesrep_number, salesrep_id, email_address, "
    "group_name, group_desc"
)

RELATIONS = {
    # ---- tonnage ----
    "item_line": """
        select ic.organization_id, ic.inventory_item_id, ic.category_set_id, c.structure_id, v.attribute2 as product_line
        from mtl_item_categories ic join mtl_categories c on c.category_id=ic.category_id
        join fnd_flex_values v on v.flex_value=c.segment1
        join fnd_flex_value_sets f on f.flex_value_set_id=v.flex_value_set_id
        where f.flex_value_set_name='WSB_PRODUCT_LINE_CATEGORY'""",
    "own_rate": "select inventory_item_id, from_uom, rate from uom_rates where to_uom='LB' and inventory_item_id is not null",
    "any_rate": "select from_uom, rate from uom_rates where to_uom='LB' and inventory_item_id is null",
    "rated_moves": """
        select m.*, cast(coalesce(o.rate, a.rate, case when m.transaction_uom='LB' then 1 end) as decimal(10,5)) as rate
        from mtl_material_transactions m
        left join own_rate o on o.inventory_item_id=m.inventory_item_id and o.from_uom=m.transaction_uom
        left join any_rate a on a.from_uom=m.transaction_uom""",
    "weighed": """
        select m.*, il.product_line, i.segment1 as item_code, p.organization_code as org,
               cast(m.rate*m.primary_quantity as decimal(24,9))*cast(coalesce(i.unit_weight,1) as decimal(9,4)) as lb
        from rated_moves m
        join mtl_system_items_b i on i.organization_id=m.organization_id and i.inventory_item_id=m.inventory_item_id
        join item_line il on il.organization_id=m.organization_id and il.inventory_item_id=m.inventory_item_id
        join mtl_parameters p on p.organization_id=m.organization_id
        where il.structure_id=101""",
    "made_rows": """
        select * from weighed where transaction_type_id=44 and transaction_source_type_id=5 and transaction_action_id=31""",
    "shipped_rows": """
        select * from weighed where transaction_type_id in (33,62) and transaction_source_type_id in (2,8)
        and transaction_action_id in (1,21)""",
    "open_po": """
        select loc.line_location_id, loc.po_line_id, h.po_header_id, h.type_lookup_code,
               coalesce(loc.quantity,0)-coalesce(loc.quantity_cancelled,0) as open_quantity
        from po_line_locations_all loc
        join po_lines_all l on l.po_line_id=loc.po_line_id
        join po_headers_all h on h.po_header_id=l.po_header_id
        join po_vendors v on v.vendor_id=h.vendor_id
        join po_line_types lt on lt.line_type_id=l.line_type_id
        where h.type_lookup_code in ('STANDARD','PLANNED')
          and coalesce(h.closed_code,'OPEN')='OPEN' and coalesce(l.closed_code,'OPEN')='OPEN'
          and coalesce(h.cancel_flag,'N')='N' and coalesce(l.cancel_flag,'N')='N' and coalesce(loc.cancel_flag,'N')='N'
          and loc.shipment_type in ('STANDARD','SCHEDULED','BLANKET') and loc.approved_flag='Y'
          and coalesce(loc.closed_code,'OPEN') in ('OPEN','CLOSED FOR INVOICE')
          and coalesce(loc.quantity,0)-coalesce(loc.quantity_cancelled,0) > coalesce(loc.quantity_received,0)""",
    "osp_rows": """
        select p.organization_code as org, il.product_line, po.open_quantity as q,
               j.organization_id, j.primary_item_id as inventory_item_id
        from open_po po
        join po_distributions_all d on d.line_location_id=po.line_location_id
        join wip_discrete_jobs j on j.wip_entity_id=d.wip_entity_id and j.status_type=3
        join wip_entities w on w.wip_entity_id=j.wip_entity_id
        join bom_resources b on b.resource_id=d.bom_resource_id and b.attribute6='Y'
        join mtl_system_items_b i on i.organization_id=j.organization_id and i.inventory_item_id=j.primary_item_id
        join item_line il on il.organization_id=j.organization_id and il.inventory_item_id=j.primary_item_id
        join mtl_parameters p on p.organization_id=j.organization_id
        where il.category_set_id=1""",
    "chosen_items": """
        select ic.organization_id, ic.inventory_item_id from mtl_item_categories ic
        join mtl_category_sets s on s.category_set_id=ic.category_set_id
        join mtl_categories c on c.category_id=ic.category_id
        where s.structure_id=101 and s.category_set_id=2""",
    "made": f"select org, {_product_line_sums('lb')} from made_rows group by org",
    "osp": f"select org, {_product_line_sums('q', 'osp_')} from osp_rows group by org",
    "shipped": "select org, sum(lb) as ship_confirmed from shipped_rows group by org",
    "made_chosen": f"select org, {_product_line_sums('lb')} from made_rows join chosen_items using (organization_id, inventory_item_id) group by org",
    "osp_chosen": f"select org, {_product_line_sums('q', 'osp_')} from osp_rows join chosen_items using (organization_id, inventory_item_id) group by org",
    "shipped_chosen": "select org, sum(lb) as ship_confirmed from shipped_rows join chosen_items using (organization_id, inventory_item_id) group by org",
    # ---- orders behind production ----
    "job_order": """
        select wip_entity_id, wip_entity_name,
               case when strpos(wip_entity_name,'-')>1 then substr(wip_entity_name,1,strpos(wip_entity_name,'-')-1)
               else '0' end as order_number
        from wip_entities""",
    "wanted_team": """
        select o.segment1 as order_number, h.salesrep_id, h.order_type_id,
               case o.segment2 when 'HOU-COMPONENT ORDER' then 'TX Components Team'
                    when 'ATL-COMPONENT ORDER' then 'GA Components Team' end as team
        from mtl_sales_orders o join oe_order_headers_all h on h.order_number=try_cast(o.segment1 as bigint)""",
    "rep_in_team": """
        select distinct r.salesrep_id, r.org_id, r.name, tm.team_desc
        from jtf_rs_salesreps r join jtf_rs_team_members_vl m on m.person_id=r.person_id
        join jtf_rs_teams_vl tm on tm.team_id=m.team_id""",
    "direct_rep": """
        select distinct w.order_number, w.salesrep_id, case when r.org_id=0 then r.name end as rep_name
        from wanted_team w join rep_in_team r on r.salesrep_id=w.salesrep_id
        where r.team_desc=coalesce(w.team, r.team_desc)""",
    "path": """
        select distinct o.segment1 as order_number, hs.ship_from_org_id as organization_id,
               hs.order_number as std_order_number, hs.salesrep_id, hs.order_type_id, ot.attribute2 as lobo
        from mtl_sales_orders o
        join oe_order_headers_all hi on hi.order_number=try_cast(o.segment1 as bigint)
        join oe_order_lines_all li on li.header_id=hi.header_id
        join po_requisition_lines_all rl on rl.requisition_line_id=li.source_document_line_id
        join po_requisition_headers_all rh on rh.requisition_header_id=rl.requisition_header_id
        join oe_order_lines_all ls on ls.line_id=try_cast(rl.attribute1 as bigint)
        join oe_order_headers_all hs on hs.header_id=ls.header_id
        join oe_transaction_types_all ot on ot.transaction_type_id=hs.order_type_id
        where rl.attribute_category='ORDER ENTRY'""",
    "rollup_of_rep": """
        select salesrep_id, coalesce(team_desc, team_name) as rollup, team_name as own
        from (select *, row_number() over (partition by salesrep_id order by team_id) as n
              from (select distinct salesrep_id, team_id, team_name, team_desc from member) d) x where n=1""",
    "order_facts": """
        select k.order_number, k.organization_id,
               coalesce(t1.rollup, t2.rollup, 'NO TEAM') as team_desc,
               coalesce(l1.lobo, p.lobo, 'NO LOB') as lobo, n.rep_name as salesrep_name
        from (select distinct j.order_number, m.organization_id from mtl_material_transactions m
              join job_order j on j.wip_entity_id=m.transaction_source_id where m.transaction_type_id=44) k
        left join (select distinct order_number, salesrep_id from direct_rep) d on d.order_number=k.order_number
        left join rollup_of_rep t1 on t1.salesrep_id=d.salesrep_id
        left join (select distinct order_number, rep_name from direct_rep where rep_name is not null) n
               on n.order_number=k.order_number
        left join (select distinct order_number, organization_id, salesrep_id, lobo from path) p
               on p.order_number=k.order_number and p.organization_id=k.organization_id
        left join rollup_of_rep t2 on t2.salesrep_id=p.salesrep_id
               and p.salesrep_id in (select salesrep_id from rep_in_team)
        left join (select distinct w.order_number, ot.attribute2 as lobo from wanted_team w
                   join oe_transaction_types_all ot on ot.transaction_type_id=w.order_type_id) l1
               on l1.order_number=k.order_number""",
    "periods_of_plant": """
        select organization_id, period_name, period_start_date, schedule_close_date from org_acct_periods
        where organization_id in (82,85)""",
    "completion_period": """
        select m.transaction_id, m.organization_id, a.period_name
        from mtl_material_transactions m join periods_of_plant a on a.organization_id=m.organization_id
         and cast(m.transaction_date as date) between a.period_start_date and a.schedule_close_date
        where m.transaction_type_id=44 and m.transaction_source_type_id=5 and m.transaction_action_id=31""",
    "fact": """
        select m.org, m.product_line as category, upper(strftime(m.transaction_date,'%b-%y')) as trans_month,
               m.transaction_date, m.transaction_id, m.transaction_reference, m.transaction_source_name, m.item_code,
               cast(m.lb as decimal(24,6)) as lb, tt.transaction_type_name, tt.description, m.transaction_source_id,
               j.order_number, j.wip_entity_name, j.wip_entity_id, f.team_desc, f.lobo, f.salesrep_name,
               strptime('01-'||a.period_name,'%d-%b-%y') as period_month
        from made_rows m join completion_period a on a.transaction_id=m.transaction_id
        join mtl_transaction_types tt on tt.transaction_type_id=m.transaction_type_id
        join job_order j on j.wip_entity_id=m.transaction_source_id
        join order_facts f on f.order_number=j.order_number and f.organization_id=m.organization_id
        where m.product_line<>'Accessories'""",
    # ---- margin ----
    "costs": f"select transaction_id, {', '.join(_cost(c) for c in COSTS)} from mtl_transaction_accounts where accounting_line_type in (2,36) group by transaction_id",
    "moves": """
        select transaction_id, inventory_item_id, organization_id, transaction_type_id, source_line_id,
               trx_source_line_id, new_cost
        from mtl_material_transactions where transaction_action_id in (1,27)""",
    "order_lines": "select *, concat(line_number,'.',shipment_number) as order_line from oe_order_lines_all",
    "invoice_rows": """
        select l.customer_trx_line_id, u.name as operating_unit, cc.segment2 as line_of_business,
               cc.segment5 as rev_gl_account, s.territory, rep.name as sales_person, a.cust_account_id, a.account_number,
               pt.party_name as customer, l.interface_line_attribute1 as order_number, ty.description as invoice_type,
               x.trx_date as invoice_date, x.trx_number as invoice_number, l.line_number as invoice_line,
               l.line_type as inv_line_type, l.description as line_desc, g.gl_date,
               coalesce(l.quantity_invoiced, l.quantity_credited) as quantity, l.uom_code, l.unit_standard_price,
               l.unit_selling_price, l.extended_amount,
               if(cc.segment5='6415', g.acctd_amount, 0) as om_freight,
               if(g.acctd_amount<0 and l.quantity_invoiced>0 and cc.segment5<>'6415', g.acctd_amount, 0) as om_credits,
               g.acctd_amount as om_rev, l.warehouse_id, l.inventory_item_id,
               try_cast(l.interface_line_attribute6 as bigint) as order_key
        from ra_cust_trx_line_gl_dist_all g
        join gl_code_combinations cc on cc.code_combination_id=g.code_combination_id and cc.segment5 in ('3041','6415')
        join ra_customer_trx_lines_all l on l.customer_trx_line_id=g.customer_trx_line_id
        join ra_customer_trx_all x on x.customer_trx_id=l.customer_trx_id and x.customer_trx_id=g.customer_trx_id
        join ra_cust_trx_types_all ty on ty.cust_trx_type_id=x.cust_trx_type_id and ty.org_id=x.org_id
        join hr_all_organization_units u on u.organization_id=l.org_id
        join hz_cust_accounts a on a.cust_account_id=coalesce(x.sold_to_customer_id, x.bill_to_customer_id)
        join hz_parties pt on pt.party_id=a.party_id
        join hz_cust_site_uses_all su on su.site_use_id=x.bill_to_site_use_id
        join hz_cust_acct_sites_all s on s.cust_acct_site_id=su.cust_acct_site_id
        join jtf_rs_salesreps rep on rep.salesrep_id=x.primary_salesrep_id and rep.org_id=x.org_id
        where x.complete_flag='Y'""",
    "item_dim": """
        select i.organization_id, i.inventory_item_id as item_key, i.segment1 as item_number, i.primary_uom_code,
               i.weight_uom_code, i.unit_weight, c.segment1 as inventory_category1, c.segment2 as inventory_category2,
               c.segment3 as inventory_category3, c.segment4 as inventory_category4
        from mtl_system_items_b i
        join mtl_item_categories ic on ic.organization_id=i.organization_id and ic.inventory_item_id=i.inventory_item_id
        join mtl_category_sets cs on cs.category_set_id=ic.category_set_id and cs.category_set_name='Inventory'
        join mtl_categories c on c.category_id=ic.category_id""",
    "part1": _branch(
        "Part1", "join order_lines ol on ol.line_id=i.order_key and i.inv_line_type='LINE' "
        + ISSUES.format(kind=33, link="source_line_id"), order_line_id="ol.line_id", costed=True),
    "part2_moves": _branch(
        "Part2", "join order_lines ol on ol.top_model_line_id=i.order_key and i.inv_line_type='LINE' "
        + ISSUES.format(kind=33, link="source_line_id"), order_line_id="ol.top_model_line_id", costed=True),
    # equal rows of one transaction count once for cost, but each for replacements
    "part2": f"""
        select {', '.join(KEYS_OF_DETAIL)}, {', '.join(f'any_value({c}) as {c}' for c in COSTS)},
               sum(om_replacements) as om_replacements, txn
        from part2_moves group by {', '.join(KEYS_OF_DETAIL)}, txn""",
    "part3": _branch(
        "Part3", "join order_lines ol on ol.line_id=i.order_key and i.inv_line_type='LINE' "
        + ISSUES.format(kind=15, link="trx_source_line_id"), order_line_id="ol.line_id", costed=True),
    "part4": _plain_branch("Part4", "inv_line_type='FREIGHT'"),
    "part5": _plain_branch("Part5", "inv_line_type='LINE' and inventory_item_id is null"),
    "part6": _branch(
        "Part6", "left join order_lines ol on ol.line_id=i.order_key "
        "join mtl_parameters p on p.organization_id=coalesce(ol.ship_from_org_id, i.warehouse_id) "
        "left join oe_transaction_types_tl ty on ty.transaction_type_id=ol.line_type_id",
        order_line_id="ol.line_id", costed=False, text="coalesce(ol.order_line,'.')")
        + """ where i.inv_line_type='LINE' and i.om_rev<>0
              and coalesce(ol.line_id,0)<>coalesce(ol.top_model_line_id,-1)
              and (ol.line_id is null or ol.line_id not in (
                   select o.line_id from order_lines o join moves m
                     on ((m.transaction_type_id=33 and m.source_line_id=o.line_id)
                      or (m.transaction_type_id=15 and m.trx_source_line_id=o.line_id))
                    and m.inventory_item_id=o.inventory_item_id and m.organization_id=o.ship_from_org_id))""",
    "all_parts": " union all ".join(f"select * from part{n}" for n in range(1, 7)),
    "detail_grouped": f"""
        select {', '.join(KEYS_OF_DETAIL)}, {', '.join(f'round(sum({c}),2) as {c}' for c in [*COSTS, 'om_replacements'])}
        from all_parts group by {', '.join(KEYS_OF_DETAIL)}""",
    "uom_pairs": """
        select distinct item_key, uom_code, primary_uom_code, weight_uom_code from detail_grouped where item_key is not null""",
    "pair_rates": f"""
        select *, {RATE.format(item='item_key', src='uom_code', dst='primary_uom_code')} as to_primary,
               {RATE.format(item='item_key', src='weight_uom_code', dst="'LB'")} as to_pounds
        from uom_pairs""",
    "detail_rows": """
        select d.*, coalesce(case when d.uom_code='LB' then cast(d.quantity as decimal(24,6)) else
               cast(cast(d.quantity*r.to_primary as decimal(20,9)) * cast(d.unit_weight*r.to_pounds as decimal(18,9))
                    as decimal(24,6)) end, 0) as market_quantity
        from detail_grouped d left join pair_rates r on r.item_key=d.item_key and r.uom_code=d.uom_code
         and r.primary_uom_code=d.primary_uom_code and r.weight_uom_code=d.weight_uom_code""",
    "month_summary": """
        select cust_account_id, line_of_business, cast(date_trunc('month',gl_date) as date) as summary_date,
               sum(om_freight) as om_freight, sum(om_credits) as om_credits,
               round(sum(om_replacements),2) as om_replacements, sum(om_rev) as om_revenue, round(sum(om_cogs),2) as om_cogs
        from detail_rows group by all""",
    # ---- projects ----
    "billing": """
        select a.cust_account_id, case p.project_type when 'WSB BUILDINGS' then '10' when 'WSB PROJECT SERVICES' then '40'
               else '00' end as line_of_business, cast(date_trunc('month',g.gl_date) as date) as summary_date,
               sum(if(l.inventory_item_id=7, g.acctd_amount, 0)) as pa_freight, sum(g.acctd_amount) as pa_invoice
        from ra_cust_trx_line_gl_dist_all g
        join gl_code_combinations cc on cc.code_combination_id=g.code_combination_id and cc.segment5 in ('1210','2405')
        join ra_customer_trx_lines_all l on l.customer_trx_line_id=g.customer_trx_line_id
        join ra_customer_trx_all x on x.customer_trx_id=l.customer_trx_id and x.complete_flag='Y'
        join ra_cust_trx_types_all ty on ty.cust_trx_type_id=x.cust_trx_type_id and ty.org_id=x.org_id
        join hr_all_organization_units u on u.organization_id=l.org_id
        join hz_cust_accounts a on a.cust_account_id=coalesce(x.sold_to_customer_id, x.bill_to_customer_id)
        join pa_projects_all p on p.segment1=l.interface_line_attribute1 and p.project_type<>'WSB COMMON'
        group by all""",
    "event_rows": """
        select r.project_id, cc.segment2 as line_of_business, cc.segment5 as account,
               cast(date_trunc('month',d.gl_date) as date) as summary_date, r.amount
        from pa_cust_event_rdl_all r
        join gl_code_combinations cc on cc.code_combination_id=r.code_combination_id
        join pa_draft_revenue_items i on i.project_id=r.project_id and i.draft_revenue_num=r.draft_revenue_num
         and i.line_num=r.draft_revenue_item_line_num
        join pa_draft_revenues_all d on d.project_id=i.project_id and d.draft_revenue_num=i.draft_revenue_num
        where cast(d.gl_date as date)=last_day(d.gl_date)""",
    "shares": """
        select c.project_id, c.customer_id as cust_account_id, c.customer_bill_split as split
        from pa_project_customers c join pa_projects_all p on p.project_id=c.project_id
        where p.project_type<>'WSB COMMON'""",
    "revenue": """
        select cust_account_id, line_of_business, summary_date,
               sum(cast(amount*split as decimal(30,8))*cast(0.01 as decimal(3,2))) as pa_revenue
        from event_rows join shares using (project_id) where account in ('3010','6415') group by all""",
    "cost_rows": """
        select project_id, line_of_business, summary_date, -amount as amount from event_rows
        where account in ('4138','6405','6410','4309')
        union all
        select e.project_id, cc.segment2, cast(date_trunc('month',c.gl_date) as date), e.burden_cost
        from pa_expenditure_items_all e
        join pa_cost_distribution_lines_all c on c.project_id=e.project_id and c.expenditure_item_id=e.expenditure_item_id
        join gl_code_combinations cc on cc.code_combination_id=c.dr_code_combination_id
        where cc.segment5 in ('4138','6405','6410','4309')""",
    "project_cost": """
        select cust_account_id, line_of_business, summary_date,
               sum(cast(amount*split as decimal(30,8))*cast(0.01 as decimal(3,2))) as pa_cost
        from cost_rows join shares using (project_id) group by all""",
    # ---- account plan ----
    "run_periods": """
        select distinct s.period_name, cast(try_strptime('01-'||s.period_name,'%d-%b-%y') as date) as summary_date
        from gl_period_statuses s join fnd_application a on a.application_id=s.application_id
        where a.application_short_name in ('SQLGL','AR')
          and (s.closing_status='O' or (s.closing_status='C' and s.last_update_date>date '1998-06-15'-7))
          and try_strptime('01-'||s.period_name,'%d-%b-%y') is not null""",
    "run_months": "select distinct summary_date from run_periods",
    # the three loaders, one after the other
    "s0": """
        select customer_account_id, line_of_business as lob, summary_date as m, account_number,
               om_freight, om_credits, om_replacements, om_revenue, om_cost, pa_invoice, pa_freight, pa_revenue, pa_cost
        from account_plan_interface""",
    "om_run": "select * from month_summary where summary_date in (select summary_date from run_months)",
    "bill_run": "select * from billing where summary_date in (select summary_date from run_months)",
    "rev_run": "select * from revenue where summary_date in (select summary_date from run_months)",
    "cost_run": "select * from project_cost where summary_date in (select summary_date from run_months)",
    "s1": """
        select coalesce(o.customer_account_id,b.cust_account_id) as customer_account_id,
               if(o.customer_account_id is null, b.line_of_business, o.lob) as lob, coalesce(o.m,b.summary_date) as m,
               o.account_number,
               case when b.summary_date is not null then b.om_freight when o.m in (select summary_date from run_months) then 0 else o.om_freight end as om_freight,
               case when b.summary_date is not null then b.om_credits when o.m in (select summary_date from run_months) then 0 else o.om_credits end as om_credits,
               case when b.summary_date is not null then b.om_replacements when o.m in (select summary_date from run_months) then 0 else o.om_replacements end as om_replacements,
               case when b.summary_date is not null then b.om_revenue when o.m in (select summary_date from run_months) then 0 else o.om_revenue end as om_revenue,
               case when b.summary_date is not null then b.om_cogs when o.m in (select summary_date from run_months) then 0 else o.om_cost end as om_cost,
               o.pa_invoice, o.pa_freight, o.pa_revenue, o.pa_cost
        from s0 o full join om_run b on b.cust_account_id=o.customer_account_id
         and coalesce(b.line_of_business,'?')=coalesce(o.lob,'?') and b.summary_date=o.m""",
    "s2": """
        select coalesce(o.customer_account_id,b.cust_account_id) as customer_account_id,
               if(o.customer_account_id is null, b.line_of_business, o.lob) as lob, coalesce(o.m,b.summary_date) as m,
               o.account_number, o.om_freight, o.om_credits, o.om_replacements, o.om_revenue, o.om_cost,
               case when b.summary_date is not null then b.pa_invoice when o.m in (select summary_date from run_months) then 0 else o.pa_invoice end as pa_invoice,
               case when b.summary_date is not null then b.pa_freight when o.m in (select summary_date from run_months) then 0 else o.pa_freight end as pa_freight,
               o.pa_revenue, o.pa_cost
        from s1 o full join bill_run b on b.cust_account_id=o.customer_account_id
         and coalesce(b.line_of_business,'?')=coalesce(o.lob,'?') and b.summary_date=o.m""",
    "s3": """
        select coalesce(o.customer_account_id,b.cust_account_id) as customer_account_id,
               if(o.customer_account_id is null, b.line_of_business, o.lob) as lob, coalesce(o.m,b.summary_date) as m,
               o.account_number, o.om_freight, o.om_credits, o.om_replacements, o.om_revenue, o.om_cost,
               o.pa_invoice, o.pa_freight,
               if(b.summary_date is not null, cast(b.pa_revenue as decimal(18,4)), o.pa_revenue) as pa_revenue,
               if(o.m is null, 0, o.pa_cost) as pa_cost, b.summary_date is not null as touched
        from s2 o full join rev_run b on b.cust_account_id=o.customer_account_id
         and coalesce(b.line_of_business,'?')=coalesce(o.lob,'?') and b.summary_date=o.m""",
    "s4": """
        select coalesce(o.customer_account_id,b.cust_account_id) as customer_account_id,
               if(o.customer_account_id is null, b.line_of_business, o.lob) as lob, coalesce(o.m,b.summary_date) as m,
               o.account_number, o.om_freight, o.om_credits, o.om_replacements, o.om_revenue, o.om_cost,
               o.pa_invoice, o.pa_freight, if(o.m is null, 0, o.pa_revenue) as pa_revenue,
               if(b.summary_date is not null, cast(b.pa_cost as decimal(18,4)), o.pa_cost) as pa_cost,
               coalesce(o.touched,false) or b.summary_date is not null as touched
        from s3 o full join cost_run b on b.cust_account_id=o.customer_account_id
         and coalesce(b.line_of_business,'?')=coalesce(o.lob,'?') and b.summary_date=o.m""",
    "new_plan": """
        select o.customer_account_id, o.lob as line_of_business, o.m as summary_date,
               coalesce(o.account_number, a.account_number) as account_number,
               om_freight, om_credits, om_replacements, om_revenue, om_cost, pa_invoice, pa_freight,
               if(not touched and o.m in (select summary_date from run_months), 0, pa_revenue) as pa_revenue,
               if(not touched and o.m in (select summary_date from run_months), 0, pa_cost) as pa_cost
        from s4 o left join hz_cust_accounts a on a.cust_account_id=o.customer_account_id""",
    # ---- staging ----
    "plants_of_line": """
        select order_line_id, string_agg(internal_ship_from, ', ' order by internal_ship_from) as manufacturing_plant
        from internal_shipments where internal_ship_from is not null group by order_line_id""",
    # ---- sales organisation ----
    "rep": """
        select s.salesrep_id, s.salesrep_number, s.resource_id, s.person_id, s.status, s.email_address,
               r.resource_number, r.resource_name as name, r.end_date_active
        from jtf_rs_salesreps s join jtf_rs_resource_extns_vl r on r.resource_id=s.resource_id
        where s.org_id=0 and r.category in ('EMPLOYEE','OTHER','PARTY','PARTNER','SUPPLIER_CONTACT')""",
    "reporting": """
        select distinct g.group_id, g.group_name, m.resource_id
        from jtf_rs_group_members_vl m join jtf_rs_groups_vl g on g.group_id=m.group_id
        join jtf_rs_defresroles_vl d on d.role_resource_id=m.group_member_id
        where m.delete_flag='N' and d.delete_flag='N' and d.role_resource_type='RS_GROUP_MEMBER'
          and d.role_name='Sales Group Reporting'""",
    "live_member": "select * from jtf_rs_team_members_vl where delete_flag is null or delete_flag='N'",
    "member": f"""
        select {MEMBER_COLUMNS} from (
            select tm.team_number, tm.team_name, tm.team_desc, tm.end_date_active as team_end_date,
                   tm.attribute1 as manager_number, l.team_member_id, l.team_id, l.resource_type, gm.person_id, l.category,
                   l.category_name, r.resource_number, r.name, r.resource_id, r.salesrep_number, r.salesrep_id,
                   r.email_address, g.group_name, g.group_desc
            from rep r join jtf_rs_group_members_vl gm on gm.resource_number=r.resource_number
             and (gm.delete_flag is null or gm.delete_flag='N')
            join jtf_rs_groups_vl g on g.group_id=gm.group_id
            join reporting q on q.group_id=gm.group_id and q.resource_id=gm.resource_id
            join live_member l on l.resource_number=g.group_number and l.resource_type='GROUP'
            join jtf_rs_teams_vl tm on tm.team_id=l.team_id) a
        union
        select tm.team_number, tm.team_name, tm.team_desc, tm.end_date_active, tm.attribute1, l.team_member_id, l.team_id,
               l.resource_type, l.person_id, l.category, l.category_name, r.resource_number, r.name, r.resource_id,
               r.salesrep_number, r.salesrep_id, r.email_address, null, null
        from rep r join live_member l on l.resource_number=r.resource_number and l.resource_type='INDIVIDUAL'
        join jtf_rs_teams_vl tm on tm.team_id=l.team_id""",
    "manager": """
        select tm.team_number, tm.team_name, tm.team_desc, r.salesrep_number, r.full_name as manager_name
        from jtf_rs_teams_vl tm left join (
            select distinct rep.salesrep_id, rep.salesrep_number, rep.status,
                   coalesce(upper(h.first_name),'') || ' ' || coalesce(upper(h.last_name),'') as full_name
            from rep left join per_all_people_f h on h.person_id=rep.person_id) r on r.salesrep_number=tm.attribute1
        where tm.end_date_active is null or tm.end_date_active>date '1998-06-15'""",
    "live_code": """
        select lookup_type, lookup_code, meaning, description, tag from fnd_lookup_values
        where enabled_flag='Y' and end_date_active is null""",
    "live_territory": """
        select salesrep_id, territory_id, start_date_active from ra_salesrep_territories
        where end_date_active is null or end_date_active>=date '1998-06-15'""",
}

TONS = "lb*cast(0.0005 as decimal(5,4))"  # exact: a division by 2000 would round twice


def _fact(tons: str) -> str:
    return ", ".join(f"cast({tons} as double) as qty" if c == "qty" else c for c in TONNAGE)



QUERIES = {
    "tonnage_made": f"select org, {_doubles(['frame', 'hi_tensile', 'trim', 'sheeting', 'non_frame'])} from made",
    "tonnage_osp": f"select org, {_doubles(['osp_frame', 'osp_hi_tensile', 'osp_trim', 'osp_sheeting', 'osp_non_frame'])} from osp",
    "tonnage_shipped": f"select org, {_doubles(['ship_confirmed'])} from shipped",
    "tonnage_by_org": _report("made osp shipped"),
    "tonnage_category_filter": _report("made_chosen osp_chosen shipped_chosen"),
    "osp_open_po": "select line_location_id, po_line_id, po_header_id, type_lookup_code, cast(open_quantity as double) as open_quantity from open_po",
    "uom_rate": "select distinct inventory_item_id, transaction_uom, cast(rate as double) as rate from rated_moves",
    "order_from_job": "select wip_entity_id, order_number from job_order",
    "period_range_join": "select * from completion_period",
    "internal_order_path": "select * from path",
    "order_team": "select order_number, organization_id, team_desc from order_facts",
    "order_lob": "select order_number, organization_id, lobo from order_facts",
    "order_salesrep": "select order_number, organization_id, salesrep_name from order_facts",
    "tonnage_load": f"select {_fact(TONS)} from fact",
    # the rows of a full load; those of the period June 1998 are loaded afresh, all others are the stored ones
    "tonnage_refresh": f"""
        select {_fact(TONS)} from fact where period_month=timestamp '1998-06-01'
        union all
        select {_fact(TONS + ' + 1')} from fact where period_month is distinct from timestamp '1998-06-01'""",
    "cost_elements": f"select transaction_id, {_doubles(COSTS, 4)} from costs",
    "om_freight_credits": """
        select customer_trx_line_id, line_of_business, rev_gl_account, gl_date, cast(om_rev as double) as om_rev,
               cast(om_freight as double) as om_freight, cast(om_credits as double) as om_credits, cast(count(*) as double) as times
        from (select l.customer_trx_line_id, cc.segment2 as line_of_business, cc.segment5 as rev_gl_account, g.gl_date,
                     g.acctd_amount as om_rev, if(cc.segment5='6415', g.acctd_amount, 0) as om_freight,
                     if(g.acctd_amount<0 and l.quantity_invoiced>0 and cc.segment5<>'6415', g.acctd_amount, 0) as om_credits
              from ra_cust_trx_line_gl_dist_all g
              join gl_code_combinations cc on cc.code_combination_id=g.code_combination_id and cc.segment5 in ('3041','6415')
              join ra_customer_trx_lines_all l on l.customer_trx_line_id=g.customer_trx_line_id
              join ra_customer_trx_all x on x.customer_trx_id=l.customer_trx_id and x.complete_flag='Y') r
        group by all""",
    "om_replacements": _detail(
        "query_identifier customer_trx_line_id order_line_id order_line line_of_business rev_gl_account gl_date om_rev "
        "om_replacements".split(), "query_identifier in ('Part1','Part2','Part3')"),
    "om_part1_sales": _detail(DETAIL, "query_identifier='Part1'"),
    "om_part2_config": _detail(DETAIL, "query_identifier='Part2'"),
    "om_part3_returns": _detail(DETAIL, "query_identifier='Part3'"),
    "om_part4_freight": _detail(DETAIL, "query_identifier='Part4'"),
    "om_part5_no_item": _detail(DETAIL, "query_identifier='Part5'"),
    "om_part6_no_txn": _detail(DETAIL, "query_identifier='Part6'"),
    "om_detail": _detail(DETAIL),
    "gross_profit": _detail(
        "query_identifier customer_trx_line_id order_line_id order_line line_of_business rev_gl_account gl_date om_rev "
        "om_cogs om_gross_profit om_gross_profit_percent".split()),
    "market_quantity": _detail(
        "query_identifier customer_trx_line_id order_line_id order_line line_of_business rev_gl_account gl_date om_rev "
        "quantity uom_code market_quantity market_uom".split()),
    "om_month_summary": f"""
        select cust_account_id, line_of_business, cast(summary_date as varchar) as summary_date,
               {_doubles(['om_freight', 'om_credits', 'om_replacements', 'om_revenue', 'om_cogs'], 4)} from month_summary""",
    "pa_invoice": f"""
        select cust_account_id, line_of_business, cast(summary_date as varchar) as summary_date,
               {_doubles(['pa_freight', 'pa_invoice'], 4)} from billing""",
    "pa_revenue": f"""
        select cust_account_id, line_of_business, cast(summary_date as varchar) as summary_date,
               {_doubles(['pa_revenue'], 10)} from revenue""",
    "pa_cost": f"""
        select cust_account_id, line_of_business, cast(summary_date as varchar) as summary_date,
               {_doubles(['pa_cost'], 10)} from project_cost""",
    "account_plan": _interface({}, "new_plan o"),
    "stored_account_plan": _interface({}, "new_plan o"),
    "load_ledger": """
        select cast(cast(m as date) as varchar) as period, 'history' as run, 'done' as state, cast(0 as bigint) as rows_before,
               count(s.summary_date) as rows_after, cast(0 as bigint) as rows_rejected, count(s.summary_date) as rows_stored, true as agrees
        from (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-01', interval 1 month)) as m) x
        left join month_summary s on s.summary_date=cast(x.m as date) group by m""",
    "period_replace": "select * replace (cast(if(summary_date='1998-06-01', 2, 1) as bigint) as request_id) from ("
    + _detail(DETAIL) + ")",
    "upsert_measures": _interface(
        {"customer_account_id": "coalesce(o.customer_account_id, b.cust_account_id)",
         "line_of_business": "coalesce(o.line_of_business, b.line_of_business)",
         "summary_date": "coalesce(o.summary_date, b.summary_date)",
         "pa_invoice": "if(b.summary_date is null, o.pa_invoice, b.pa_invoice)",
         "pa_freight": "if(b.summary_date is null, o.pa_freight, b.pa_freight)"},
        f"account_plan_interface o full join {BILLING_JUNE} b on {SAME_KEY}"),
    "reset_stale": _interface(
        {m: f"if(b.summary_date is null and o.summary_date=date '1998-06-01', 0, o.{m})" for m in ("pa_invoice", "pa_freight")},
        f"account_plan_interface o left join {BILLING_JUNE} b on {SAME_KEY}"),
    "backfill_null": _interface(
        {"account_number": "coalesce(o.account_number, a.account_number)"},
        "account_plan_interface o left join hz_cust_accounts_all a on a.cust_account_id=o.customer_account_id"),
    "open_periods": "select period_name, cast(summary_date as varchar) as summary_date from run_periods",
    "period_month": """
        select period_name, cast(cast(m as date) as varchar) as month_start, upper(strftime(m,'%b-%y')) as month_name
        from (select distinct period_name, try_strptime('01-'||period_name,'%d-%b-%y') as m from gl_period_statuses) x""",
    "row_quarantine": """
        select * from (select customer_trx_line_id, line_type, concat_ws(', ',
               case when inventory_item_id is null then 'no item' end,
               case when try_cast(interface_line_attribute6 as bigint) is null then 'order line is no number' end,
               case when not coalesce(coalesce(quantity_invoiced,quantity_credited)>0,false) then 'quantity not positive' end
               ) as load_error from ra_customer_trx_lines_all) x where load_error<>''""",
    "load_audit": f"""
        select cast(m as varchar) as period, cast(sum(b) as bigint) as rows_before, cast(sum(a) as bigint) as rows_after from (
          select summary_date as m, 1 as b, 0 as a from account_plan_interface union all
          select coalesce(o.summary_date,b.summary_date), 0, 1
          from account_plan_interface o full join {BILLING_JUNE} b on {SAME_KEY}) x group by m""",
    "history_backfill": _stage("'loader'", "year(d.gl_date) between 1995 and 2001"),
    "incremental_refresh": _stage("case when d.summary_date='1998-06-01' then 'refresh' else 'first load' end"),
    "lookup_active": "select lookup_code, meaning, description, tag from live_code where lookup_type='WSB_SALESREP_TITLES'",
    "active_rows": "select salesrep_id, territory_id, cast(start_date_active as varchar) as start_date_active from live_territory",
    "rep_base": "select * exclude (end_date_active), cast(end_date_active as varchar) as end_date_active from rep",
    "group_roles": "select * from reporting",
    "team_members": "select * exclude (team_end_date), cast(team_end_date as varchar) as team_end_date from member",
    "team_rollup": """
        select tm.team_desc, tm.team_id, tm.team_number, tm.team_name, up.team_number as top_rollup_id
        from jtf_rs_teams_vl tm left join jtf_rs_teams_vl up on up.team_name=tm.team_desc""",
    "team_manager": "select * from manager",
    "sales_territory": """
        select ter.territory_id, rep.salesrep_number, rep.name,
               if(ter.attribute1='1020','PMFG',ter.description) as territory_desc, ter.name as territory,
               ter.segment1 as territory_flexfield, ter.attribute1 as lob_id, bl.meaning as line_of_business,
               att.attribute1 as title, ti.meaning as job_title, att.attribute2 as div, dv.meaning as division,
               att.attribute3 as plt, pl.meaning as plant, mb.team_number as team_id, mb.team_name as team,
               cast(lt.start_date_active as varchar) as start_date_active, up.team_number as top_rollup_id,
               mg.team_desc as top_rollup_team, mg.salesrep_number as top_rollup_number, mg.manager_name as top_rollup_name,
               cast(rep.end_date_active as varchar) as end_date_active, rep.status
        from rep
        left join live_territory lt on lt.salesrep_id=rep.salesrep_id
        left join ra_territories ter on ter.territory_id=lt.territory_id
        left join (select s.salesrep_number, r.attribute1, r.attribute2, r.attribute3 from jtf_rs_resource_extns_vl r
                   join jtf_objects_vl o on o.object_code=r.category
                   join jtf_rs_salesreps s on s.resource_id=r.resource_id and s.org_id=0) att
               on att.salesrep_number=rep.salesrep_number
        left join live_code bl on bl.lookup_type='WSB_LINE_OF_BUSINESS' and bl.lookup_code=ter.attribute1
        left join live_code ti on ti.lookup_type='WSB_SALESREP_TITLES' and ti.lookup_code=att.attribute1
        left join live_code dv on dv.lookup_type='WSB_DIVISIONS' and dv.lookup_code=att.attribute2
        left join live_code pl on pl.lookup_type='WSB_PLANTS' and pl.lookup_code=att.attribute3
        left join member mb on mb.salesrep_number=rep.salesrep_number
        left join jtf_rs_teams_vl up on up.team_name=mb.team_desc
        left join manager mg on mg.team_number=mb.team_number""",
    "rep_list": """
        select distinct mb.salesrep_id, mb.salesrep_number as sales_rep_number, mb.name as sales_rep, mb.email_address,
               ti.meaning as title, mb.team_name as team, ru.rollup as rollup_team, boss.full_name as manager, mb.person_id
        from member mb
        join jtf_rs_resource_extns_vl r on r.resource_id=mb.resource_id
        left join live_code ti on ti.lookup_type='WSB_SALESREP_TITLES' and ti.lookup_code=r.attribute1
        left join rollup_of_rep ru on ru.salesrep_id=mb.salesrep_id
        left join (select distinct s.salesrep_number, coalesce(h.first_name,'') || ' ' || coalesce(h.last_name,'') as full_name
                   from jtf_rs_salesreps s join per_all_people_f h on h.person_id=s.person_id) boss
               on boss.salesrep_number=mb.manager_number
        order by team nulls last, rollup_team nulls last""",
    "dim_sales_rep": """
        select * from (
          select s.salesrep_id, s.salesrep_number as sales_rep_number, s.name as sales_rep, s.email_address,
                 ti.meaning as title, replace(n.team_name,' Team','') as team, replace(n.team_desc,' Team','') as rollup_team,
                 mg.description as manager, mb.delete_flag, s.person_id,
                 cast(row_number() over (partition by s.salesrep_id order by mb.delete_flag nulls first, mb.team_id nulls first,
                              mb.team_member_id nulls first) as int) as r
          from jtf_rs_salesreps s
          left join jtf_rs_resource_extns_vl res on res.resource_id=s.resource_id
          left join live_code ti on ti.lookup_type='WSB_SALESREP_TITLES' and ti.lookup_code=res.attribute1
          left join live_code tc on tc.lookup_type='WSB_SALES_TEAMS' and tc.lookup_code=res.attribute4
          left join live_code mg on mg.lookup_type='WSB_SALES_TEAM_MGRS' and mg.lookup_code=tc.tag
          left join jtf_rs_team_members mb on mb.team_resource_id=s.resource_id
          left join jtf_rs_teams_tl n on n.team_id=mb.team_id) x where r=1""",
    "scalar_lookup": """
        select l.line_id as order_line_id, l.header_id, c.segment1 as rev_co, c.segment2 as rev_lob, c.segment3 as rev_loc,
               c.segment4 as rev_dept, c.segment5 as rev_gl
        from oe_order_lines_all l left join margin_cogs_segments c on c.order_line_id=l.line_id""",
    "plant_list": "select order_line_id, manufacturing_plant from plants_of_line",
    "invoice_stage": _stage("'loader'"),
}

_DEFINITIONS = {
    **{f"base_{name}": sql for name, sql in BASES.items()},
    **{name: _adapter_sql(name) for name in ADAPTERS},
    **RELATIONS,
}
_WORD = re.compile(r"[a-z_][a-z_0-9]*")


def _needed(sql: str, known: list[str]) -> None:
    for word in dict.fromkeys(_WORD.findall(sql)):
        if word in _DEFINITIONS and word not in known:
            if re.search(rf"\b(?:from|join|,|\()\s*{word}\b", sql):
                _needed(_DEFINITIONS[word], known)
                known.append(word)


def with_relations(sql: str) -> str:
    """Prefix a query with the definitions of the relations it uses, in dependency order."""
    names: list[str] = []
    _needed(sql, names)
    if not names:
        return sql
    parts = ",\n".join(f"{name} as ({_DEFINITIONS[name]})" for name in names)
    return f"with {parts}\n{sql}"


def oracle_queries() -> dict[str, str]:
    return {key: with_relations(sql) for key, sql in QUERIES.items()}
