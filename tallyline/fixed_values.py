"""Fixed values.

These codes, ids and names must equal the ones stored in the source system's tables for
the results to be right. They are data, stated as plain text; jobs take them as defaults.
"""

# --- product lines (descriptive attribute of the product-line value set) ---
PRODUCT_LINE_VALUE_SET = "WSB_PRODUCT_LINE_CATEGORY"
FRAME = "Frame"
HI_TENSILE = "Hi-Tensile"
TRIM = "Trim"
SHEETING = "Sheeting"
ACCESSORIES = "Accessories"
PRODUCT_LINE_STRUCTURE = 101
PURCHASING_CATEGORY_SET = 1
INVENTORY_CATEGORY_SET_NAME = "Inventory"

# --- material transactions: (types, source types, actions) ---
COMPLETION_TYPE = 44
COMPLETION_SOURCE_TYPE = 5
COMPLETION_ACTION = 31
SHIPMENT_TYPES = (33, 62)
SHIPMENT_SOURCE_TYPES = (2, 8)
SHIPMENT_ACTIONS = (1, 21)
ORDER_ISSUE_TYPE = 33
ORDER_RETURN_TYPE = 15
ORDER_ACTIONS = (1, 27)

# --- tonnage fact ---
TONNAGE_ORGANIZATIONS = (82, 85)
FISCAL_CALENDAR = "WSB_13_Calendar"
FIRST_TONNAGE_PERIOD = "JAN-20"
POUNDS_PER_TON = 2000
NO_ORDER = "0"
NO_TEAM = "NO TEAM"
NO_LOB = "NO LOB"
TEAM_BY_ORDER_KIND = {
    "HOU-COMPONENT ORDER": "TX Components Team",
    "ATL-COMPONENT ORDER": "GA Components Team",
}
REQUISITION_FROM_ORDER = "ORDER ENTRY"

# --- outsourced purchasing ---
PO_TYPES = ("BLANKET", "STANDARD", "PLANNED")
PO_TYPES_WITH_HEADER_STATUS = ("STANDARD", "PLANNED")
PO_TYPE_WITHOUT_STATUS = "BLANKET"
PO_SHIPMENT_TYPES = ("STANDARD", "SCHEDULED", "BLANKET")
PO_OPEN_SHIPMENT_STATUSES = ("OPEN", "CLOSED FOR INVOICE")
RELEASED_JOB_STATUS = 3

# --- ledger accounts ---
ORDER_REVENUE_ACCOUNTS = ("3041", "6415")
FREIGHT_ACCOUNT = "6415"
PROJECT_BILLING_ACCOUNTS = ("1210", "2405")
PROJECT_REVENUE_ACCOUNTS = ("3010", "6415")
PROJECT_COST_ACCOUNTS = ("4138", "6405", "6410", "4309")
PRIMARY_COST_LINE_TYPE = 2
FALLBACK_COST_LINE_TYPE = 36
COST_ELEMENTS = {
    "om_material": 1,
    "om_material_overhead": 2,
    "om_resource": 3,
    "om_outside_processing": 4,
    "om_overhead": 5,
}

# --- projects ---
SHARED_PROJECT_TYPE = "WSB COMMON"
LOB_BY_PROJECT_TYPE = {"WSB BUILDINGS": "10", "WSB PROJECT SERVICES": "40"}
OTHER_PROJECT_LOB = "00"
PROJECT_FREIGHT_ITEM = 53460

# --- periods ---
PERIOD_APPLICATIONS = ("SQLGL", "AR")
CLOSED_PERIOD_LOOKBACK_DAYS = 7
STAGING_HISTORY_YEARS = (2019, 2020, 2021, 2022, 2023, 2024)

# --- sales organisation ---
REP_CATEGORIES = ("EMPLOYEE", "OTHER", "PARTY", "PARTNER", "SUPPLIER_CONTACT")
REP_ORGANIZATION = 0
REPORTING_ROLE = "Sales Group Reporting"
GROUP_MEMBER_ROLE_TYPE = "RS_GROUP_MEMBER"
LOOKUP_TITLES = "WSB_SALESREP_TITLES"
LOOKUP_DIVISIONS = "WSB_DIVISIONS"
LOOKUP_PLANTS = "WSB_PLANTS"
LOOKUP_LOB = "WSB_LINE_OF_BUSINESS"
LOOKUP_TEAMS = "WSB_SALES_TEAMS"
LOOKUP_TEAM_MANAGERS = "WSB_SALES_TEAM_MGRS"
MANUFACTURING_LOB_CODE = "1020"
MANUFACTURING_TERRITORY = "PMFG"

# --- output columns, in contract order ---
MARGIN_DETAIL_COLUMNS = (
    "query_identifier customer_trx_line_id summary_date operating_unit line_of_business "
    "rev_gl_account territory sales_person cust_account_id account_number customer "
    "order_number order_line order_line_type invoice_type invoice_date invoice_number "
    "invoice_line inv_line_type line_desc gl_date warehouse item_number "
    "inventory_category1 inventory_category2 inventory_category3 inventory_category4 "
    "quantity uom_code unit_standard_price unit_selling_price extended_amount "
    "om_freight om_credits om_rev om_replacements om_cogs om_gross_profit "
    "om_gross_profit_percent creation_date request_id market_quantity market_uom "
    "om_material om_material_overhead om_resource om_outside_processing om_overhead "
    "order_line_id"
).split()
INVOICE_STAGE_EXTRA_COLUMNS = (
    "rev_co rev_lob rev_loc rev_dept rev_gl cogs_co cogs_lob cogs_loc cogs_dept cogs_gl "
    "manufacturing_plant customername load_creation_date created_by last_updated_date "
    "last_updated_by"
).split()
TONNAGE_FACT_COLUMNS = (
    "org category trans_month transaction_date transaction_id transaction_reference "
    "transaction_source_name item_code qty transaction_type_name description "
    "transaction_source_id order_number wip_entity_name wip_entity_id team_desc lobo "
    "salesrep_name"
).split()
TONNAGE_REPORT_COLUMNS = (
    "org frame non_frame osp_frame osp_non_frame osp_hi_tensile hi_tensile trim osp_trim "
    "sheeting osp_sheeting ship_confirmed"
).split()
SALES_TERRITORY_COLUMNS = (
    "territory_id salesrep_number name territory_desc territory territory_flexfield lob_id "
    "line_of_business title job_title div division plt plant team_id team "
    "start_date_active top_rollup_id top_rollup_team top_rollup_number top_rollup_name "
    "end_date_active status"
).split()
REP_LIST_COLUMNS = (
    "salesrep_id sales_rep_number sales_rep email_address title team rollup_team manager "
    "person_id"
).split()
SALES_REP_DIMENSION_COLUMNS = (
    "salesrep_id sales_rep_number sales_rep email_address title team rollup_team manager "
    "delete_flag person_id r"
).split()
ORDER_MEASURES = ("om_freight", "om_credits", "om_replacements", "om_revenue", "om_cost")
BILLING_MEASURES = ("pa_invoice", "pa_freight")
PROJECT_MEASURES = ("pa_revenue", "pa_cost")

# Month names of period names and month texts, whatever the locale.
MONTH_NAMES = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
