"""Table contracts: columns, keys, labels, thresholds and targets."""

from __future__ import annotations

# --- Fixed values -----------------------------------------------------------
# Column names, keys, labels, targets and guardrails that results depend on.

RAW_COLUMNS: dict[str, list[str]] = {
    "erp_customers": (
        "erp_customer_id legal_name dba_name parent_erp_customer_id industry "
        "customer_status payment_terms credit_limit_usd primary_bill_to_state "
        "account_owner_email created_date last_modified_ts source_system "
        "is_test_account notes annual_volume_tier"
    ).split(),
    "customer_id_crosswalk": (
        "erp_customer_id tms_customer_code is_primary_mapping effective_from "
        "effective_to mapping_confidence notes"
    ).split(),
    "ref_warehouses": (
        "warehouse_id wms_location_code warehouse_name city state postal_code "
        "latitude longitude timezone daily_outbound_capacity is_active source_system"
    ).split(),
    "ref_carriers": (
        "carrier_id scac carrier_legal_name mode status notes source_system"
    ).split(),
    "tms_shipments": (
        "tms_shipment_id tms_customer_code erp_customer_id_ref sales_order_id "
        "customer_po bol_number pro_number tracking_number origin_warehouse_id "
        "origin_wms_code dest_name dest_address1 dest_city dest_state dest_postal "
        "dest_country is_residential carrier_id carrier_scac mode "
        "service_level_code service_level_name planned_transit_days "
        "lane_miles_est ship_create_date ship_create_ts promised_delivery_date "
        "actual_pickup_ts actual_delivery_ts shipment_status exception_code "
        "weight_lb pieces freight_class estimated_revenue_usd "
        "estimated_cost_usd currency on_time_flag is_void is_re_tender "
        "parent_tms_shipment_id source_system extract_batch_id last_update_ts "
        "row_hash"
    ).split(),
    "tms_shipment_lines": (
        "tms_shipment_id line_number sku description qty_ordered qty_shipped "
        "unit_weight_lb hazardous_flag source_system"
    ).split(),
    "carrier_tracking_events": (
        "column1 tms_shipment_id tracking_number event_code event_description "
        "event_ts_utc event_ts_local event_city event_state exception_reason "
        "source ingested_ts"
    ).split(),
    "wms_outbound": (
        "wms_outbound_id wms_location_code sales_order_id tms_shipment_id "
        "pick_start_ts pack_complete_ts ship_confirm_ts lines_picked "
        "short_pick_flag inventory_accuracy_snapshot source_system"
    ).split(),
    "erp_invoices": (
        "invoice_id invoice_type erp_customer_id tms_shipment_id sales_order_id "
        "pro_number invoice_date gl_post_date line_amount_usd "
        "accessorial_amount_usd fuel_surcharge_usd tax_usd currency "
        "payment_status dispute_flag source_system"
    ).split(),
    "claims": (
        "claim_id tms_shipment_id pro_number claim_type filed_date "
        "claim_amount_requested_usd claim_amount_paid_usd claim_status "
        "carrier_id source_system adjuster_notes"
    ).split(),
    "crm_tickets": (
        "ticket_id opened_ts erp_customer_id tms_customer_code tms_shipment_id "
        "tracking_number channel category_raw severity status subject "
        "description_free_text resolution_hours source_system"
    ).split(),
    "csat_survey_responses": (
        "response_id survey_sent_ts response_ts erp_customer_id tms_shipment_id "
        "csat_score_1_to_5 nps_score_0_to_10 comment source_system"
    ).split(),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "erp_customers": ["erp_customer_id"],
    "customer_id_crosswalk": ["tms_customer_code", "effective_from"],
    "ref_warehouses": ["warehouse_id"],
    "ref_carriers": ["carrier_id"],
    "tms_shipments": ["tms_shipment_id"],
    "tms_shipment_lines": ["tms_shipment_id", "line_number"],
    "carrier_tracking_events": ["column1"],
    "wms_outbound": ["wms_outbound_id"],
    "erp_invoices": ["invoice_id"],
    "claims": ["claim_id"],
    "crm_tickets": ["ticket_id"],
    "csat_survey_responses": ["response_id"],
}

# Staged columns in order: "target rule" or "target rule source".
# Rules: text, upper, lower, code, country, int, double, money, date, ts,
# flag (false when unreadable) and tri (stays null when unreadable).
STAGED_COLUMNS: dict[str, str] = {
    "stg_customers": """
        erp_customer_id text
        legal_name text
        dba_name text
        parent_erp_customer_id text
        industry text
        customer_status upper
        payment_terms text
        credit_limit_usd money
        primary_bill_to_state upper
        account_owner_email lower
        created_date date
        last_modified_ts ts
        is_test_account flag
        notes text
        annual_volume_tier upper
        source_system text
    """,
    "stg_customer_crosswalk": """
        erp_customer_id text
        tms_customer_code_raw text tms_customer_code
        tms_customer_code_normalized code tms_customer_code
        is_primary_mapping flag
        effective_from date
        effective_to date
        mapping_confidence upper
        notes text
    """,
    "stg_warehouses": """
        warehouse_id text
        wms_location_code upper
        warehouse_name text
        city text
        state upper
        postal_code text
        latitude double
        longitude double
        timezone text
        daily_outbound_capacity int
        is_active flag
        source_system text
    """,
    "stg_carriers": """
        carrier_id text
        scac upper
        carrier_legal_name text
        mode upper
        carrier_status upper status
        notes text
        source_system text
    """,
    "stg_shipments": """
        tms_shipment_id text
        tms_customer_code_raw text tms_customer_code
        tms_customer_code_normalized code tms_customer_code
        erp_customer_id_ref text
        sales_order_id text
        customer_po text
        bol_number text
        pro_number text
        tracking_number text
        origin_warehouse_id text
        origin_wms_code upper
        dest_name text
        dest_city text
        dest_state upper
        dest_postal text
        dest_country country
        is_residential flag
        carrier_id text
        carrier_scac upper
        mode upper
        service_level_code upper
        service_level_name upper
        planned_transit_days int
        lane_miles_est double
        ship_create_date date
        ship_create_ts ts
        promised_delivery_date date
        actual_pickup_ts ts
        actual_delivery_ts ts
        shipment_status upper
        exception_code upper
        weight_lb double
        pieces int
        freight_class double
        estimated_revenue_usd money
        estimated_cost_usd money
        currency upper
        source_on_time_flag tri on_time_flag
        is_void flag
        is_re_tender flag
        parent_tms_shipment_id text
        source_system text
        extract_batch_id text
        last_update_ts ts
        row_hash text
    """,
    "stg_shipment_lines": """
        tms_shipment_id text
        line_number int
        sku upper
        product_description text description
        qty_ordered int
        qty_shipped int
        unit_weight_lb double
        hazardous_flag flag
        source_system text
    """,
    "stg_tracking_events": """
        tracking_event_id text column1
        tms_shipment_id text
        tracking_number text
        event_code upper
        event_description text
        event_ts_utc ts
        event_ts_local ts
        event_city text
        event_state upper
        exception_reason text
        event_source upper source
        ingested_ts ts
    """,
    "stg_wms_outbound": """
        wms_outbound_id text
        wms_location_code upper
        sales_order_id text
        source_tms_shipment_id text tms_shipment_id
        pick_start_ts ts
        pack_complete_ts ts
        ship_confirm_ts ts
        lines_picked int
        short_pick_flag flag
        inventory_accuracy_snapshot double
        source_system text
    """,
    "stg_invoices": """
        invoice_id text
        invoice_type upper
        erp_customer_id text
        source_tms_shipment_id text tms_shipment_id
        sales_order_id text
        pro_number text
        invoice_date date
        gl_post_date date
        line_amount_usd money
        accessorial_amount_usd money
        fuel_surcharge_usd money
        tax_usd money
        currency upper
        payment_status upper
        dispute_flag flag
        source_system text
    """,
    "stg_claims": """
        claim_id text
        source_tms_shipment_id text tms_shipment_id
        pro_number text
        claim_type upper
        filed_date date
        claim_amount_requested_usd money
        claim_amount_paid_usd money
        claim_status upper
        carrier_id text
        source_system text
        adjuster_notes text
    """,
    "stg_crm_tickets": """
        ticket_id text
        opened_ts ts
        source_erp_customer_id text erp_customer_id
        tms_customer_code_raw text tms_customer_code
        tms_customer_code_normalized code tms_customer_code
        source_tms_shipment_id text tms_shipment_id
        tracking_number text
        channel upper
        category_raw text
        severity upper
        ticket_status upper status
        subject text
        description_free_text text
        resolution_hours double
        source_system text
    """,
    "stg_csat_responses": """
        response_id text
        survey_sent_ts ts
        response_ts ts
        erp_customer_id text
        tms_shipment_id text
        csat_score int csat_score_1_to_5
        nps_score int nps_score_0_to_10
        survey_comment text comment
        source_system text
    """,
}

RAW_OF_STAGED: dict[str, str] = {
    "stg_customers": "erp_customers",
    "stg_customer_crosswalk": "customer_id_crosswalk",
    "stg_warehouses": "ref_warehouses",
    "stg_carriers": "ref_carriers",
    "stg_shipments": "tms_shipments",
    "stg_shipment_lines": "tms_shipment_lines",
    "stg_tracking_events": "carrier_tracking_events",
    "stg_wms_outbound": "wms_outbound",
    "stg_invoices": "erp_invoices",
    "stg_claims": "claims",
    "stg_crm_tickets": "crm_tickets",
    "stg_csat_responses": "csat_survey_responses",
}

US_SPELLINGS = ["US", "USA", "UNITED STATES", "UNITED STATES OF AMERICA"]
DEAD_STATUSES = ["VOID", "CANCELLED", "CANCELED", "REPLACED"]
EXCEPTION_EVENT_CODES = ["EXC", "DELAY", "LATE"]
SEVERE_LEVELS = ["HIGH", "CRITICAL"]
KPI_LAG_DAYS = 3
UNKNOWN = "UNKNOWN"
UNKNOWN_DATE = "1900-01-01"

BY_SHIPMENT_ID = "TMS SHIPMENT ID"
BY_SALES_ORDER = "SALES ORDER FALLBACK"
BY_PRO_NUMBER = "PRO NUMBER FALLBACK"
BY_TRACKING_NUMBER = "TRACKING NUMBER FALLBACK"
BY_CUSTOMER_ID = "ERP CUSTOMER ID"
BY_CROSSWALK = "CUSTOMER CROSSWALK"
UNMATCHED = "UNMATCHED"

# First bucket whose word occurs in the text wins.
CLAIM_TYPE_WORDS = [
    ("CONCEALED DAMAGE", ["CONCEALED"]),
    ("DAMAGE", ["DAMAGE"]),
    ("SHORTAGE", ["SHORT"]),
    ("LOSS", ["LOSS", "LOST"]),
]
TICKET_CATEGORY_WORDS = [
    ("DAMAGE", ["DAMAGE"]),
    ("LATE DELIVERY", ["LATE", "DELAY"]),
    ("SHORTAGE / PARTIAL DELIVERY", ["PARTIAL", "SHORT", "MISSING"]),
    ("LOST SHIPMENT", ["LOST", "LOSS"]),
    ("DRIVER BEHAVIOR", ["DRIVER"]),
    ("BILLING", ["BILL", "INVOICE"]),
]

# name, target, warning tolerance, better direction
KPI_TARGETS = [
    ("On-Time Delivery %", 0.95, 0.02, "Higher"),
    ("OTIF %", 0.93, 0.02, "Higher"),
    ("Average Fill Rate", 0.98, 0.01, "Higher"),
    ("Gross Margin %", 0.20, 0.03, "Higher"),
    ("Claim Rate", 0.02, 0.01, "Lower"),
    ("Complaint Rate", 0.04, 0.01, "Lower"),
    ("Average CSAT", 4.30, 0.30, "Higher"),
    ("Net Promoter Score", 50.00, 10.00, "Higher"),
]

# Published totals of the benchmark data.
BENCHMARK_TOTALS = {
    "total_shipments": 98595,
    "customer_revenue_usd": 72336827.17,
    "otd_eligible_shipments": 78452,
    "on_time_shipments": 59986,
    "otif_eligible_shipments": 74198,
    "otif_shipments": 46321,
}

MIN_CARRIER_OTD = 1000
MIN_LANE_OTIF = 250
MIN_CUSTOMER_SHIPMENTS = 1000
TOP_CARRIERS, TOP_LANES, TOP_CUSTOMERS = 10, 15, 10

# Landed columns whose name says they hold text, not numbers.
TEXT_NAME_PARTS = (
    "_id _code _number _postal _state _country _email _name _status _type "
    "_mode _currency _description _reason _notes _subject _comment _address"
).split()
TEXT_NAMES = (
    "column1 sku scac channel severity source source_system row_hash customer_po"
).split()

EXPORTS = (
    "fact_shipment dim_date dim_customer dim_carrier dim_warehouse dim_service "
    "dim_lane vw_executive_kpis vw_monthly_performance vw_carrier_scorecard "
    "vw_warehouse_scorecard vw_customer_scorecard vw_lane_scorecard"
).split()

TABLE_PROFILE_COLUMNS = (
    "table_name row_count column_count fully_duplicated_rows "
    "duplicate_key_groups file_bytes"
).split()
COLUMN_PROFILE_COLUMNS = (
    "table_name column_name data_type row_count null_count null_percentage "
    "distinct_count minimum_value maximum_value sample_value"
).split()
QUALITY_ISSUE_COLUMNS = (
    "table_name check_name status issue_count severity description"
).split()

# Dimension -> (its key, the fact's key)
DIMENSION_KEYS = {
    "dim_date": ("date_key", "ship_date"),
    "dim_customer": ("customer_key", "customer_key"),
    "dim_carrier": ("carrier_key", "carrier_key"),
    "dim_warehouse": ("warehouse_key", "warehouse_key"),
    "dim_service": ("service_key", "service_key"),
    "dim_lane": ("lane_key", "lane_key"),
}
# --- End of fixed values ----------------------------------------------------


def staged_columns(table: str) -> list[tuple[str, str, str]]:
    """(target, rule, source) for each cleaned column of a staging table."""
    out = []
    for line in STAGED_COLUMNS[table].split("\n"):
        parts = line.split()
        if parts:
            out.append((parts[0], parts[1], parts[-1] if len(parts) == 3 else parts[0]))
    return out


def require_columns(df, columns, what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks column(s): {', '.join(missing)}")
