"""One DuckDB statement per registered query."""

from haulgrain import contracts as C
from oracle.model import CSAT, KPI, NPS, div, n, rate, with_query

ORACLE: dict[str, str] = {}


def add(name: str, final: str, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = with_query(final, extra)


def rounded(source: str, fractions: str = "", columns: str = "*") -> str:
    """Select with the fractional columns as doubles of six places."""
    names = fractions.split()
    if not names:
        return f"SELECT {columns} FROM {source}"
    swap = ", ".join(f"ROUND({c}::DOUBLE, 6) AS {c}" for c in names)
    return f"SELECT {columns} REPLACE ({swap}) FROM {source}"


MARGINS = " gross_margin_usd gross_margin_percentage"
MONEY = " customer_revenue_usd carrier_cost_usd claims_paid_usd" + MARGINS
SERVICE = " on_time_delivery_rate otif_rate average_fill_rate full_fill_rate"
FACT = (
    "lane_miles_est weight_lb shipment_fill_rate calculated_line_weight_lb warehouse_cycle_hours pick_to_pack_hours"
    " pack_to_ship_hours average_inventory_accuracy total_accessorial_usd total_fuel_surcharge_usd"
    " claims_requested_usd average_resolution_hours average_csat_score shipment_nps" + MONEY
)
LINE_FRACTIONS = "shipment_fill_rate calculated_line_weight_lb"

for _name, _source, _fractions in [
    ("stg_customers", "stg_customers", "credit_limit_usd"),
    ("stg_crosswalk", "stg_customer_crosswalk", ""),
    ("stg_warehouses", "stg_warehouses", "latitude longitude"),
    ("stg_carriers", "stg_carriers", ""),
    ("stg_shipments", "stg_shipments",
     "lane_miles_est weight_lb freight_class estimated_revenue_usd estimated_cost_usd"),
    ("stg_lines", "stg_shipment_lines", "unit_weight_lb line_fill_rate calculated_line_weight_lb"),
    ("stg_events", "stg_tracking_events", ""),
    ("stg_events_dedup", "stg_tracking_events_dedup", ""),
    ("stg_wms", "stg_wms_outbound",
     "inventory_accuracy_snapshot pick_to_pack_hours pack_to_ship_hours total_warehouse_cycle_hours"),
    ("stg_invoices", "stg_invoices",
     "line_amount_usd accessorial_amount_usd fuel_surcharge_usd tax_usd net_freight_amount_usd"
     " invoice_total_usd customer_revenue_usd carrier_cost_usd"),
    ("stg_claims", "stg_claims", "claim_amount_requested_usd claim_amount_paid_usd"),
    ("stg_tickets", "stg_crm_tickets", "resolution_hours"),
    ("stg_surveys", "stg_csat_responses", ""),
    ("agg_lines", "agg_lines", LINE_FRACTIONS),
    ("agg_events", "agg_events", ""),
    ("agg_wms", "agg_wms",
     "warehouse_cycle_hours pick_to_pack_hours pack_to_ship_hours average_inventory_accuracy"),
    ("agg_invoices", "agg_invoices",
     "customer_revenue_usd carrier_cost_usd total_accessorial_usd total_fuel_surcharge_usd"),
    ("agg_claims", "agg_claims", "claims_requested_usd claims_paid_usd"),
    ("agg_tickets", "agg_tickets", "average_resolution_hours"),
    ("agg_surveys", "agg_surveys", "average_csat_score shipment_nps"),
    ("dim_customer", "dim_customer", "credit_limit_usd"),
    ("dim_carrier", "dim_carrier", ""),
    ("dim_warehouse", "dim_warehouse", "latitude longitude"),
    ("dim_service", "dim_service", ""),
    ("fact_shipment", "fact_shipment", FACT),
    ("kpi_executive", "kpi_executive",
     "average_days_late average_warehouse_cycle_hours accessorial_cost_usd complaint_rate claim_rate"
     " average_csat_score net_promoter_score" + MONEY + SERVICE),
    ("kpi_monthly", "kpi_monthly",
     "average_days_late average_warehouse_cycle_hours complaint_rate claim_rate average_csat_score"
     " net_promoter_score" + MONEY + SERVICE),
    ("kpi_carrier", "kpi_carrier",
     "average_days_late average_tracking_exceptions accessorial_cost_usd carrier_cost_per_shipment complaint_rate"
     " claim_rate average_csat_score" + MONEY + SERVICE),
    ("kpi_warehouse", "kpi_warehouse",
     "average_warehouse_cycle_hours average_pick_to_pack_hours average_pack_to_ship_hours short_pick_rate"
     " average_inventory_accuracy complaint_rate claim_rate average_csat_score" + MONEY + SERVICE),
    ("kpi_customer", "kpi_customer",
     "complaint_rate claim_rate average_csat_score net_promoter_score" + MONEY + SERVICE),
    ("kpi_lane", "kpi_lane",
     "average_days_late average_lane_miles accessorial_cost_usd carrier_cost_per_shipment complaint_rate claim_rate"
     " average_csat_score" + MONEY + SERVICE),
]:
    add(_name, rounded(_source, _fractions))

for _name, _columns in {
    "match_wms": "wms_outbound_id, matched_tms_shipment_id, shipment_match_method",
    "match_invoices": "invoice_id, matched_tms_shipment_id, shipment_match_method",
    "match_claims": "claim_id, matched_tms_shipment_id, shipment_match_method, actual_delivery_ts",
}.items():
    add(_name, f"SELECT {_columns} FROM {_name}")
add("match_ticket_shipment",
    "SELECT ticket_id, matched_tms_shipment_id, shipment_match_method FROM match_tickets")
add("match_ticket_customer",
    "SELECT ticket_id, matched_erp_customer_id, customer_match_method FROM match_tickets")
add("resolve_customer",
    "SELECT tms_shipment_id, resolved_customer_key, customer_match_method, resolved_test_account_flag FROM resolved")
add("live_child_antijoin",
    "SELECT tms_shipment_id, parent_tms_shipment_id, base_eligible_flag,"
    " base_eligible_flag AND NOT EXISTS (SELECT 1 FROM ship_clean c WHERE c.base_eligible_flag"
    " AND c.parent_tms_shipment_id = s.tms_shipment_id) AS final_live_shipment_flag FROM ship_clean s")
add("latest_per_sales_order", "SELECT sales_order_id, hit AS tms_shipment_id FROM by_sales_order")
add("crosswalk_best",
    "SELECT code AS tms_customer_code_normalized, hit AS erp_customer_id FROM by_code WHERE code IS NOT NULL")
add("dim_date",
    "SELECT *, year * 100 + month_number AS year_month_sort, 'Q' || quarter AS quarter_label,"
    " year || ' Q' || quarter AS year_quarter FROM dim_date")
add("dim_lane",
    "SELECT *, origin_warehouse_id || ' → ' || destination_city || ', ' || destination_state AS lane_label"
    " FROM dim_lane")

# --- measures and slices ----------------------------------------------------

def cnt(cond: str) -> str:
    return n(cond)


def r6(expr: str) -> str:
    return f"ROUND(({expr})::DOUBLE, 6)"


def listing(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {c}" for c, e in columns.items())


def isum(c: str) -> str:
    return f"SUM({c})::BIGINT"


ALL = "COUNT(*)"
PR, PA, DE = (f"SUM(IFNULL({c}_count, 0))" for c in ("promoter", "passive", "detractor"))
MEASURES = {
    "volume": {
        "total_shipments": ALL,
        "official_kpi_shipments": KPI["official_kpi_shipments"],
        "shipment_lines": isum("shipment_line_count"),
        "quantity_ordered": isum("total_quantity_ordered"),
        "quantity_shipped": isum("total_quantity_shipped"),
        "delivered_shipments": "COUNT(actual_delivery_date)",
        "promised_shipments": "COUNT(promised_delivery_date)",
    },
    "service": {
        "otd_eligible_shipments": KPI["otd_eligible_shipments"],
        "on_time_shipments": KPI["on_time_shipments"],
        "late_shipments": KPI["late_shipments"],
        "on_time_delivery_pct": r6(KPI["on_time_delivery_rate"]),
        "otif_eligible_shipments": KPI["otif_eligible_shipments"],
        "otif_shipments": KPI["otif_shipments"],
        "otif_pct": r6(KPI["otif_rate"]),
        "average_fill_rate": r6(KPI["average_fill_rate"]),
        "full_fill_eligible_shipments": KPI["full_fill_eligible_shipments"],
        "full_fill_shipments": KPI["full_fill_shipments"],
        "full_fill_rate": r6(KPI["full_fill_rate"]),
        "fill_rate_coverage_pct": r6(div(KPI["full_fill_eligible_shipments"], KPI["official_kpi_shipments"])),
        "average_days_late": r6(KPI["average_days_late"]),
        "tracking_exceptions": isum("tracking_exception_count"),
        "tracking_exceptions_per_shipment": r6("AVG(tracking_exception_count)"),
    },
    "warehouse": {
        "average_warehouse_cycle_hours": r6("AVG(warehouse_cycle_hours)"),
        "average_pick_to_pack_hours": r6("AVG(pick_to_pack_hours)"),
        "average_pack_to_ship_hours": r6("AVG(pack_to_ship_hours)"),
        "wms_matched_shipments": cnt("wms_record_count > 0"),
        "wms_match_rate": r6(rate("wms_record_count > 0")),
        "short_pick_shipments": cnt("wms_record_count > 0 AND short_pick_flag"),
        "short_pick_eligible_shipments": cnt("wms_record_count > 0 AND short_pick_flag IS NOT NULL"),
        "short_pick_rate": r6(KPI["short_pick_rate"]),
        "average_inventory_accuracy": r6("AVG(average_inventory_accuracy)"),
    },
    "financial": {
        "customer_revenue": r6("SUM(customer_revenue_usd)"),
        "carrier_cost": r6("SUM(carrier_cost_usd)"),
        "accessorial_cost": r6("SUM(total_accessorial_usd)"),
        "fuel_surcharge": r6("SUM(total_fuel_surcharge_usd)"),
        "claims_paid": r6("SUM(claims_paid_usd)"),
        "gross_margin": r6("SUM(gross_margin_usd)"),
        "gross_margin_pct": r6(KPI["gross_margin_percentage"]),
        "revenue_per_shipment": r6(div("SUM(customer_revenue_usd)", ALL)),
        "carrier_cost_per_shipment": r6(div("SUM(carrier_cost_usd)", ALL)),
        "margin_per_shipment": r6(div("SUM(gross_margin_usd)", ALL)),
        "accessorial_cost_pct": r6(div("SUM(total_accessorial_usd)", "SUM(carrier_cost_usd)")),
        "invoice_matched_shipments": cnt("invoice_count > 0"),
        "invoice_match_rate": r6(rate("invoice_count > 0")),
    },
    "customer": {
        "claim_count": isum("claim_count"),
        "shipments_with_claims": cnt("claim_flag"),
        "claim_rate": r6(rate("claim_flag")),
        "claims_paid_per_shipment": r6(div("SUM(claims_paid_usd)", ALL)),
        "complaint_tickets": isum("ticket_count"),
        "shipments_with_complaints": cnt("complaint_flag"),
        "complaint_rate": r6(rate("complaint_flag")),
        "complaints_per_1000": r6(div("SUM(ticket_count) * 1000", ALL)),
        "severe_tickets": isum("severe_ticket_count"),
        "average_resolution_hours": r6("AVG(average_resolution_hours)"),
        "surveyed_shipments": cnt("survey_response_count > 0"),
        "survey_response_coverage_pct": r6(rate("survey_response_count > 0")),
        "average_csat": r6(CSAT),
        "promoters": isum("promoter_count"),
        "passives": isum("passive_count"),
        "detractors": isum("detractor_count"),
        "nps_responses": f"({PR} + {PA} + {DE})::BIGINT",
        "net_promoter_score": r6(NPS),
    },
    "data_quality": {
        "shipments_with_known_ship_date": "COUNT(ship_date)",
        "shipments_missing_ship_date": f"{ALL} - COUNT(ship_date)",
        "ship_date_coverage_pct": r6(div("COUNT(ship_date)", ALL)),
        "revenue_with_known_ship_date": r6("SUM(CASE WHEN ship_date IS NOT NULL THEN customer_revenue_usd END)"),
        "revenue_missing_ship_date": r6("SUM(CASE WHEN ship_date IS NULL THEN customer_revenue_usd END)"),
        "matched_customer_shipments": cnt("customer_key <> 'UNKNOWN'"),
        "customer_match_rate": r6(rate("customer_key <> 'UNKNOWN'")),
        "matched_carrier_shipments": cnt("carrier_key <> 'UNKNOWN'"),
        "carrier_match_rate": r6(rate("carrier_key <> 'UNKNOWN'")),
        "matched_warehouse_shipments": cnt("warehouse_key <> 'UNKNOWN'"),
        "warehouse_match_rate": r6(rate("warehouse_key <> 'UNKNOWN'")),
    },
    "data_through": {"data_through_date": "MAX(ship_date)"},
}
for _group, _columns in MEASURES.items():
    add(f"measures_{_group}", f"SELECT mode, {listing(_columns)} FROM fact_shipment GROUP BY mode")

MONTH = "DATE_TRUNC('month', ship_date)::DATE"
MONTHS = {"by_month": (
    f"SELECT {MONTH} AS m, {ALL} AS c, {KPI['on_time_delivery_rate']} AS otd, SUM(gross_margin_usd)::DOUBLE AS gm"
    " FROM fact_shipment WHERE ship_date IS NOT NULL GROUP BY 1"
)}
add("measures_time", f"""
SELECT a.m AS month_start_date, a.c AS total_shipments, b.c AS shipments_previous_month,
  {r6('(a.c - b.c)::DOUBLE / NULLIF(b.c, 0)')} AS shipment_change_pct,
  {r6('a.otd')} AS on_time_delivery_pct, {r6('b.otd')} AS otd_pct_previous_month,
  {r6('100 * (a.otd - b.otd)')} AS otd_change_pp,
  {r6('a.gm')} AS gross_margin, {r6('b.gm')} AS gross_margin_previous_month,
  {r6('(a.gm - b.gm) / NULLIF(b.gm, 0)')} AS gross_margin_change_pct
FROM by_month a LEFT JOIN by_month b ON a.m = b.m + INTERVAL 1 MONTH""", MONTHS)

_SLICED = "mode IN ('LTL', 'FTL') AND ship_date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"
add("measures_time_by_mode", f"""
SELECT a.mode, a.m AS month_start_date, a.c AS total_shipments, b.c AS shipments_previous_month,
  {r6('(a.c - b.c)::DOUBLE / NULLIF(b.c, 0)')} AS shipment_change_pct,
  {r6('a.otd')} AS on_time_delivery_pct, {r6('b.otd')} AS otd_pct_previous_month,
  {r6('100 * (a.otd - b.otd)')} AS otd_change_pp,
  {r6('a.gm')} AS gross_margin, {r6('b.gm')} AS gross_margin_previous_month,
  {r6('(a.gm - b.gm) / NULLIF(b.gm, 0)')} AS gross_margin_change_pct
FROM mode_month a LEFT JOIN mode_month b ON a.mode = b.mode AND a.m = b.m + INTERVAL 1 MONTH
WHERE a.m BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""", {"mode_month": (
    f"SELECT mode, {MONTH} AS m, {ALL} AS c, {KPI['on_time_delivery_rate']} AS otd, SUM(gross_margin_usd)::DOUBLE AS gm"
    " FROM fact_shipment WHERE ship_date IS NOT NULL AND mode IN ('LTL', 'FTL') GROUP BY 1, 2"
)})

# Name, target, warning tolerance, better direction.
_targets = ", ".join(
    f"('{name}', {target}::DOUBLE, {slack}::DOUBLE, '{way}')" for name, target, slack, way in [
        ("On-Time Delivery %", "0.95", "0.02", "Higher"), ("OTIF %", "0.93", "0.02", "Higher"),
        ("Average Fill Rate", "0.98", "0.01", "Higher"), ("Gross Margin %", "0.20", "0.03", "Higher"),
        ("Claim Rate", "0.02", "0.01", "Lower"), ("Complaint Rate", "0.04", "0.01", "Lower"),
        ("Average CSAT", "4.30", "0.30", "Higher"), ("Net Promoter Score", "50.00", "10.00", "Higher")])
_actuals = " UNION ALL ".join(
    f"SELECT '{name}' AS kpi_name, ({KPI[column]})::DOUBLE AS actual FROM fact_shipment"
    for name, column in [
        ("On-Time Delivery %", "on_time_delivery_rate"), ("OTIF %", "otif_rate"),
        ("Average Fill Rate", "average_fill_rate"), ("Gross Margin %", "gross_margin_percentage"),
        ("Claim Rate", "claim_rate"), ("Complaint Rate", "complaint_rate"),
        ("Average CSAT", "average_csat_score"), ("Net Promoter Score", "net_promoter_score"),
    ]
)
add("measures_targets", f"""
SELECT kpi_name, {r6('actual')} AS actual, {r6('target_value')} AS target_value,
  {r6('warning_tolerance')} AS warning_tolerance, direction, {r6("CASE WHEN kpi_name IN ('Average CSAT', 'Net Promoter Score') THEN 1 ELSE 100 END * (actual - target_value)")} AS variance,
  CASE WHEN actual IS NULL THEN 'No data'
       WHEN (direction = 'Higher' AND actual >= target_value) OR (direction = 'Lower' AND actual <= target_value)
         THEN 'On target'
       WHEN (direction = 'Higher' AND actual >= target_value - warning_tolerance)
         OR (direction = 'Lower' AND actual <= target_value + warning_tolerance) THEN 'Watch'
       ELSE 'Off target' END AS status
FROM ({_actuals}) a
JOIN (VALUES {_targets}) t(kpi_name, target_value, warning_tolerance, direction) USING (kpi_name)""")

_by_mode = _actuals.replace(" AS kpi_name,", " AS kpi_name, mode,").replace(
    "FROM fact_shipment", f"FROM fact_shipment WHERE {_SLICED} GROUP BY mode")
add("measures_targets_by_mode", f"""
SELECT mode, kpi_name, {r6('actual')} AS actual, {r6('target_value')} AS target_value,
  {r6('warning_tolerance')} AS warning_tolerance, direction, {r6("CASE WHEN kpi_name IN ('Average CSAT', 'Net Promoter Score') THEN 1 ELSE 100 END * (actual - target_value)")} AS variance,
  CASE WHEN actual IS NULL THEN 'No data'
       WHEN (direction = 'Higher' AND actual >= target_value) OR (direction = 'Lower' AND actual <= target_value)
         THEN 'On target'
       WHEN (direction = 'Higher' AND actual >= target_value - warning_tolerance)
         OR (direction = 'Lower' AND actual <= target_value + warning_tolerance) THEN 'Watch'
       ELSE 'Off target' END AS status
FROM ({_by_mode}) a
JOIN (VALUES {_targets}) t(kpi_name, target_value, warning_tolerance, direction) USING (kpi_name)""")


def between(column: str) -> str:
    return f"{column} BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"


IN = between("ship_date")
add("measures_sliced", f"""
SELECT dest_state, {cnt(IN)} AS total_shipments,
  {r6(div(cnt(f"{IN} AND official_kpi_eligible_flag AND final_on_time_flag"),
          cnt(f"{IN} AND official_kpi_eligible_flag AND final_on_time_flag IS NOT NULL")))} AS on_time_delivery_pct,
  {r6(div(f"SUM(CASE WHEN {IN} THEN gross_margin_usd END)",
          f"SUM(CASE WHEN {IN} THEN customer_revenue_usd END)"))} AS gross_margin_pct,
  {cnt(between('actual_delivery_date'))} AS delivered_shipments,
  {cnt(between('promised_delivery_date'))} AS promised_shipments,
  COUNT(ship_date) AS shipments_with_known_ship_date, {ALL} - COUNT(ship_date) AS shipments_missing_ship_date,
  {r6(div("COUNT(ship_date)", ALL))} AS ship_date_coverage_pct,
  {r6("SUM(CASE WHEN ship_date IS NULL THEN customer_revenue_usd END)")} AS revenue_missing_ship_date,
  MAX(ship_date) AS data_through_date
FROM fact_shipment WHERE mode IN ('LTL', 'FTL') GROUP BY 1""")

add("date_roles", " UNION ALL ".join(
    f"SELECT '{role}' AS date_role, DATE_TRUNC('month', {c})::DATE AS month_start_date, {ALL} AS shipments"
    f" FROM fact_shipment WHERE {c} IS NOT NULL GROUP BY 2"
    for role, c in [("ship", "ship_date"), ("promised", "promised_delivery_date"), ("actual", "actual_delivery_date")]
))

SEGMENT = {
    "shipments": ALL,
    "official_shipments": KPI["official_kpi_shipments"],
    "otd_eligible": KPI["otd_eligible_shipments"],
    "otif_eligible": KPI["otif_eligible_shipments"],
    "fill_eligible": KPI["full_fill_eligible_shipments"],
    "otd_rate": r6(KPI["on_time_delivery_rate"]),
    "otif_rate": r6(KPI["otif_rate"]),
    "full_fill_rate": r6(KPI["full_fill_rate"]),
    "late_shipments": KPI["late_shipments"],
    "revenue_usd": r6("SUM(customer_revenue_usd)"),
    "carrier_cost_usd": r6("SUM(carrier_cost_usd)"),
    "claims_paid_usd": r6("SUM(claims_paid_usd)"),
    "gross_margin_usd": r6("SUM(gross_margin_usd)"),
    "margin_rate": r6(KPI["gross_margin_percentage"]),
    "complaints": cnt("complaint_flag"),
    "claims": cnt("claim_flag"),
    "complaint_shipments_per_1000": r6(div(f"1000 * {cnt('complaint_flag')}", ALL)),
    "claim_rate": r6(rate("claim_flag")),
    "carrier_cost_per_shipment": r6(div("SUM(carrier_cost_usd)", ALL)),
}
NAMED = {
    "carrier_names": "SELECT carrier_key, carrier_legal_name AS nm FROM dim_carrier",
    "warehouse_names": "SELECT warehouse_key, warehouse_name AS nm FROM dim_warehouse",
    "customer_names": "SELECT customer_key, legal_name AS nm FROM dim_customer",
    "named": """
SELECT f.*, IFNULL(c.nm, 'Unknown carrier') AS carrier_name, IFNULL(w.nm, 'Unknown warehouse') AS warehouse_name,
  IFNULL(u.nm, 'Unknown customer') AS customer_name,
  IFNULL(w.nm, 'Unknown warehouse') || ' → ' || IFNULL(dest_city, 'Unknown') || ', ' || IFNULL(dest_state, '??') AS lane
FROM fact_shipment f LEFT JOIN carrier_names c ON c.carrier_key = f.carrier_key
LEFT JOIN warehouse_names w ON w.warehouse_key = f.warehouse_key
LEFT JOIN customer_names u ON u.customer_key = f.customer_key""",
}


def segment(name: str, key: str, columns: list[str] | None = None, where: str = "") -> None:
    picked = {c: SEGMENT[c] for c in columns or SEGMENT}
    add(name, f"SELECT {key}, {listing(picked)} FROM named {where} GROUP BY ALL", NAMED)


segment("slice_kpis", "mode, dest_state", where=f"WHERE mode IN ('LTL', 'FTL') AND {IN} AND warehouse_name IN"
        " ('Warehouse 1', 'Warehouse 2', 'Warehouse 3', 'Unknown warehouse')")
segment("segment_summary", "carrier_name")
segment("carrier_queue", "carrier_name")
segment("segment_lanes", "lane")
segment("lane_queue", "lane")
segment("lowest_margin_lanes", "lane")
segment("claim_queue", "customer_name",
        ["shipments", "otd_rate", "claim_rate", "claims_paid_usd", "complaint_shipments_per_1000"])
segment("carrier_cost_service", "carrier_name", ["carrier_cost_per_shipment", "otd_rate", "shipments"])
segment("monthly_series", f"{MONTH} AS month_start_date",
        ["shipments", "otd_rate", "otif_rate", "gross_margin_usd"], "WHERE ship_date IS NOT NULL")
add("warehouse_ops", f"""
SELECT warehouse_name, {ALL} AS shipments, {SEGMENT['otd_rate']} AS otd_rate,
  {SEGMENT['full_fill_rate']} AS full_fill_rate, {r6('AVG(warehouse_cycle_hours)')} AS cycle_hours,
  {r6(rate('short_pick_flag'))} AS short_pick_rate, {r6('AVG(average_inventory_accuracy)')} AS inventory_accuracy
FROM named GROUP BY 1""", NAMED)
add("dashboard_variants", f"""
SELECT {r6('AVG(average_csat_score)')} AS plain_average_csat,
  {r6(div('100 * (SUM(promoter_count) - SUM(detractor_count))', 'SUM(survey_response_count)'))} AS nps_per_response,
  {r6('AVG(CASE WHEN days_late > 0 THEN days_late END)')} AS average_days_late_any,
  {r6(div('SUM(survey_response_count)', ALL))} AS responses_per_shipment
FROM fact_shipment""")

# --- profiling --------------------------------------------------------------

_RAW = C.RAW_COLUMNS
# Key columns of the raw tables.
_KEYS = {t: keys.split() for t, keys in {
    "erp_customers": "erp_customer_id", "customer_id_crosswalk": "tms_customer_code effective_from", "ref_warehouses": "warehouse_id",
    "ref_carriers": "carrier_id", "tms_shipments": "tms_shipment_id", "tms_shipment_lines": "tms_shipment_id line_number",
    "carrier_tracking_events": "column1", "wms_outbound": "wms_outbound_id", "erp_invoices": "invoice_id", "claims": "claim_id",
    "crm_tickets": "ticket_id", "csat_survey_responses": "response_id"}.items()}


def q(c: str) -> str:
    return f'"{c}"'


# The source tables' columns and how each becomes text in a fingerprint.
_SOURCE_COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal# c_mktsegment",
    "nation": "n_nationkey n_name n_regionkey",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal#",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice# o_orderdate@ o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity# l_extendedprice# l_discount# l_tax# l_returnflag l_linestatus l_shipdate@",
    "events": "event_id ts@ user_id event_type value# props",
}


def _fingerprint(table: str, columns: str) -> str:
    parts = []
    for c in columns.split():
        name = c.rstrip("#@")
        text = f"{name}::DECIMAL(38,6)::VARCHAR" if c.endswith("#") else (
            f"STRFTIME({name}, '%Y-%m-%d %H:%M:%S.%f')" if c.endswith("@") else f"{name}::VARCHAR")
        parts.append(f"COALESCE(LENGTH({text}) || ':' || {text} || ';', '-;')")
    return (f"SELECT '{table}' AS table_name, COUNT(*) AS row_count, {len(parts)}::BIGINT AS column_count,"
            f" SUM(('0x' || SUBSTR(MD5({' || '.join(parts)}), 1, 15))::BIGINT)::HUGEINT::VARCHAR AS fingerprint FROM {table}")


ORACLE["lineage_fingerprints"] = " UNION ALL ".join(_fingerprint(t, c) for t, c in _SOURCE_COLUMNS.items())
ORACLE["landing_roundtrip"] = (
    "SELECT doc_id::VARCHAR AS document_id, source AS source_system, LENGTH(text)::BIGINT AS n_chars, MD5(text) AS text_md5"
    " FROM documents")
add("lineage_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {ALL} AS row_count, {len(cols)}::BIGINT AS column_count FROM {t}"
    for t, cols in _RAW.items()
))


def key_groups(t: str) -> str:
    keys = ", ".join(map(q, _KEYS[t]))
    full = " AND ".join(f"{q(k)} IS NOT NULL" for k in _KEYS[t])
    return f"SELECT {keys}, {ALL} AS cc FROM {t} WHERE {full} GROUP BY ALL HAVING {ALL} > 1"


add("profile_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {ALL} AS row_count, {len(cols)}::BIGINT AS column_count,"
    f" (SELECT IFNULL(SUM(cc), 0) FROM (SELECT {ALL} AS cc FROM {t} GROUP BY {', '.join(map(q, cols))}"
    f" HAVING {ALL} > 1))::BIGINT AS fully_duplicated_rows,"
    f" (SELECT {ALL} FROM ({key_groups(t)})) AS duplicate_key_groups FROM {t}"
    for t, cols in _RAW.items()
))


def edges(c: str) -> str:
    if not c.endswith(("_date", "_ts")):
        return "'' AS minimum_value, '' AS maximum_value"
    ts = f"TRY_CAST({q(c)} AS TIMESTAMP)"
    return ", ".join(
        f"IFNULL(STRFTIME({f}({ts}), '%Y-%m-%d %H:%M:%S'), '') AS {out}"
        for f, out in (("MIN", "minimum_value"), ("MAX", "maximum_value"))
    )


add("profile_columns", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'string' AS data_type, {ALL} AS row_count,"
    f" {ALL} - COUNT({q(c)}) AS null_count,"
    f" IFNULL(ROUND(({ALL} - COUNT({q(c)})) / NULLIF({ALL}, 0) * 100, 2), 0)::DOUBLE AS null_percentage,"
    f" COUNT(DISTINCT {q(c)}) AS distinct_count, {edges(c)},"
    f" IFNULL(MIN(LEFT({q(c)}, 100)), '') AS sample_value FROM {t}"
    for t, cols in _RAW.items() for c in cols
))
_ALL_KEYS = list(dict.fromkeys(k for ks in _KEYS.values() for k in ks))
add("duplicate_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{' + '.join(ks)}' AS key_columns, cc AS duplicate_count, "
    + ", ".join(f"{q(k)}::VARCHAR AS {q(k)}" if k in ks else f"NULL::VARCHAR AS {q(k)}" for k in _ALL_KEYS)
    + f" FROM ({key_groups(t)})"
    for t, ks in _KEYS.items()
))

CHECKS: list[tuple[str, str, str, str, str]] = []
for _t, _ks in _KEYS.items():
    CHECKS.append((_t, "Null primary keys",
                   f"SELECT {ALL} FROM {_t} WHERE " + " OR ".join(f"{q(k)} IS NULL" for k in _ks),
                   "High", "Primary-key fields should not be null."))
    CHECKS.append((_t, "Duplicate primary keys", f"SELECT {ALL} FROM ({key_groups(_t)})",
                   "High", "Primary-key values should be unique."))


def orphans(child: str, column: str, parent: str, key: str) -> str:
    def norm(c: str) -> str:
        return f"NULLIF(UPPER(TRIM({c})), '')"

    return (f"SELECT {ALL} FROM {child} WHERE {norm(column)} IS NOT NULL AND {norm(column)} NOT IN"
            f" (SELECT {norm(key)} FROM {parent} WHERE {norm(key)} IS NOT NULL)")


for _c, _col, _p, _k, _name, _text in [
    ("tms_shipments", "tms_customer_code", "customer_id_crosswalk", "tms_customer_code",
     "Unmatched TMS customer codes", "TMS customer codes should match the customer crosswalk."),
    ("tms_shipments", "erp_customer_id_ref", "erp_customers", "erp_customer_id",
     "Unmatched ERP customer references", "ERP customer references should match ERP_Customers."),
    ("tms_shipments", "carrier_id", "ref_carriers", "carrier_id", "Unmatched carriers",
     "Shipment carrier IDs should match Ref_Carriers."),
    ("tms_shipments", "origin_warehouse_id", "ref_warehouses", "warehouse_id", "Unmatched warehouses",
     "Origin warehouse IDs should match Ref_Warehouses."),
]:
    CHECKS.append((_c, _name, orphans(_c, _col, _p, _k), "High", _text))
for _c in "tms_shipment_lines carrier_tracking_events claims crm_tickets csat_survey_responses".split():
    CHECKS.append((_c, "Unmatched tms_shipment_id",
                   orphans(_c, "tms_shipment_id", "tms_shipments", "tms_shipment_id"), "Medium",
                   "Non-null shipment IDs should match TMS_Shipments."))


def where(t: str, cond: str) -> str:
    return f"SELECT {ALL} FROM {t} WHERE {cond}"


def num(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


_DLV, _PICK = "TRY_CAST(actual_delivery_ts AS TIMESTAMP)", "TRY_CAST(actual_pickup_ts AS TIMESTAMP)"
CHECKS += [
    ("tms_shipments", "Delivery before pickup", where("tms_shipments", f"{_DLV} < {_PICK}"), "High",
     "Actual delivery cannot occur before actual pickup."),
    ("tms_shipments", "Delivered shipments missing delivery date",
     where("tms_shipments", f"UPPER(shipment_status) = 'DELIVERED' AND {_DLV} IS NULL"), "High",
     "Delivered shipments should normally have an actual delivery timestamp."),
    ("wms_outbound", "Missing TMS shipment ID", where("wms_outbound", "tms_shipment_id IS NULL"), "Medium",
     "Use sales_order_id as the controlled fallback match."),
    ("erp_invoices", "Missing TMS shipment ID", where("erp_invoices", "tms_shipment_id IS NULL"), "Medium",
     "Use sales order and PRO number as controlled fallbacks."),
    ("tms_shipment_lines", "Missing shipped quantity",
     where("tms_shipment_lines", f"{num('qty_shipped')} IS NULL"), "Medium",
     "Missing shipped quantity should remain null, not zero."),
    ("tms_shipment_lines", "Negative quantity",
     where("tms_shipment_lines", f"{num('qty_ordered')} < 0 OR {num('qty_shipped')} < 0"), "High",
     "Ordered and shipped quantities cannot be negative."),
    ("tms_shipment_lines", "Shipped quantity above ordered quantity",
     where("tms_shipment_lines", f"{num('qty_shipped')} > {num('qty_ordered')}"), "Low",
     "Overshipments are possible but should be reviewed."),
    ("claims", "Paid claim above requested amount",
     where("claims", f"{num('claim_amount_paid_usd')} > {num('claim_amount_requested_usd')}"), "High",
     "Paid claim amount should not exceed requested amount."),
    ("csat_survey_responses", "Invalid CSAT score",
     where("csat_survey_responses", f"{num('csat_score_1_to_5')} NOT BETWEEN 1 AND 5"), "High",
     "CSAT must be between 1 and 5."),
    ("csat_survey_responses", "Invalid NPS score",
     where("csat_survey_responses", f"{num('nps_score_0_to_10')} NOT BETWEEN 0 AND 10"), "High",
     "NPS responses must be between 0 and 10."),
    ("carrier_tracking_events", "Duplicate delivery events",
     f"SELECT {ALL} - COUNT(DISTINCT (tms_shipment_id, event_code)) FROM carrier_tracking_events"
     " WHERE UPPER(TRIM(event_code)) = 'DLV' AND tms_shipment_id IS NOT NULL", "Medium",
     "Keep the event with the latest ingestion timestamp."),
]
add("business_checks", "SELECT table_name, check_name, CASE issue_count WHEN 0 THEN 'Pass' ELSE 'Issue' END AS status,"
    " issue_count, severity, description FROM (" + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{name}' AS check_name, ({sql}) AS issue_count, '{sev}' AS severity,"
        f" '{text}' AS description" for t, name, sql, sev, text in CHECKS) + ")")

# --- quality ----------------------------------------------------------------


def metrics(name: str, rows: list[tuple[str, str, str]], label: str = "metric", value: str = "metric_value") -> None:
    add(name, " UNION ALL ".join(
        f"SELECT '{text}' AS {label}, {ALL} AS {value} FROM {t} WHERE {cond}" for text, t, cond in rows))


metrics("quality_staging", [
    (t, t, "TRUE") for t in
    ("stg_customers", "stg_customer_crosswalk", "stg_warehouses", "stg_carriers", "stg_shipments")
], "table_name", "row_count")
_S, _L, _E, _W, _I, _C2, _T, _R, _F = (
    "stg_shipments", "stg_shipment_lines", "stg_tracking_events", "stg_wms_outbound", "stg_invoices",
    "stg_claims", "stg_crm_tickets", "stg_csat_responses", "fact_shipment",
)
metrics("quality_shipments", [
    ("Total staged shipments", _S, "TRUE"),
    ("Final live shipments", _S, "final_live_shipment_flag"),
    ("Staged official-KPI-eligible shipments", _S, "official_kpi_eligible_flag"),
    ("Delivered shipments missing actual delivery timestamp", _S,
     "shipment_status = 'DELIVERED' AND actual_delivery_ts IS NULL"),
    ("Source and calculated on-time results conflict", _S, "source_on_time_flag <> calculated_on_time_flag"),
    ("Staged official-KPI-eligible shipments missing on-time result", _S,
     "official_kpi_eligible_flag AND final_on_time_flag IS NULL"),
    ("Final live shipments missing ship date", _S, "final_live_shipment_flag AND ship_create_date IS NULL"),
    ("Final live shipments missing promised date", _S,
     "final_live_shipment_flag AND promised_delivery_date IS NULL"),
    ("Delivery timestamp precedes pickup timestamp", _S, "actual_delivery_ts < actual_pickup_ts"),
])
metrics("quality_lines_events", [
    ("Shipment lines", _L, "TRUE"),
    ("Short-shipped lines", _L, "quantity_status = 'SHORT SHIPPED'"),
    ("Over-shipped lines", _L, "quantity_status = 'OVER SHIPPED'"),
    ("Lines missing shipped quantity", _L, "qty_shipped IS NULL"),
    ("Unmatched shipment lines", _L, "NOT shipment_match_flag"),
    ("Raw tracking events", _E, "TRUE"),
    ("Duplicate delivery events removed", _E, "duplicate_event_flag"),
    ("Deduplicated tracking events", "stg_tracking_events_dedup", "TRUE"),
    ("Unmatched tracking events", _E, "NOT shipment_match_flag"),
])


def method(label: str) -> str:
    return f"shipment_match_method = '{label}'"


metrics("quality_wms_invoices", [
    ("Total WMS rows", _W, "TRUE"),
    ("WMS direct shipment matches", _W, method("TMS SHIPMENT ID")),
    ("WMS sales-order fallback matches", _W, method("SALES ORDER FALLBACK")),
    ("Unmatched WMS rows", _W, method("UNMATCHED")),
    ("WMS short picks", _W, "short_pick_flag"),
    ("WMS invalid timestamp sequences", _W, "invalid_timestamp_sequence_flag"),
    ("Total invoice rows", _I, "TRUE"),
    ("Invoice direct shipment matches", _I, method("TMS SHIPMENT ID")),
    ("Invoice sales-order fallback matches", _I, method("SALES ORDER FALLBACK")),
    ("Invoice PRO-number fallback matches", _I, method("PRO NUMBER FALLBACK")),
    ("Unmatched invoices", _I, method("UNMATCHED")),
    ("Customer revenue invoices", _I, "invoice_type = 'CUSTOMER'"),
    ("Carrier bill invoices", _I, "invoice_type = 'CARRIER_BILL'"),
    ("Disputed invoices", _I, "dispute_flag"),
])
metrics("quality_customer_impact", [
    ("Total claims", _C2, "TRUE"),
    ("Unmatched claims", _C2, "NOT shipment_match_flag"),
    ("Claims paid above requested", _C2, "paid_exceeds_requested_flag"),
    ("Total CRM tickets", _T, "TRUE"),
    ("Unmatched ticket shipments", _T, "NOT shipment_match_flag"),
    ("Unmatched ticket customers", _T, "NOT customer_match_flag"),
    ("Tickets categorized as OTHER", _T, "category_normalized = 'OTHER'"),
    ("Total CSAT responses", _R, "TRUE"),
    ("Invalid CSAT scores", _R, "NOT valid_csat_flag"),
    ("Invalid NPS scores", _R, "NOT valid_nps_flag"),
    ("Unmatched CSAT shipments", _R, "NOT shipment_match_flag"),
    ("Promoters", _R, "nps_category = 'PROMOTER'"),
    ("Passives", _R, "nps_category = 'PASSIVE'"),
    ("Detractors", _R, "nps_category = 'DETRACTOR'"),
])
metrics("quality_star", [
    ("Fact shipment rows", _F, "TRUE"),
    ("Duplicate fact shipment keys", f"(SELECT 1 FROM {_F} GROUP BY shipment_key HAVING {ALL} > 1)", "TRUE"),
    ("Official KPI shipments", _F, "official_kpi_eligible_flag"),
    ("Unknown customers", _F, "customer_key = 'UNKNOWN'"),
    ("Unknown carriers", _F, "carrier_key = 'UNKNOWN'"),
    ("Unknown warehouses", _F, "warehouse_key = 'UNKNOWN'"),
    ("Shipments missing fill rate", _F, "shipment_fill_rate IS NULL"),
    ("Shipments with invoice data", _F, "invoice_count > 0"),
    ("Shipments with claims", _F, "claim_count > 0"),
    ("Shipments with CRM tickets", _F, "ticket_count > 0"),
    ("Shipments with CSAT responses", _F, "survey_response_count > 0"),
])

# --- model gates ------------------------------------------------------------

FACT_N = f"(SELECT {ALL} FROM fact_shipment)"
GATES: list[tuple[str, str]] = [
    ("fact_shipment key is not null", where(_F, "shipment_key IS NULL")),
    ("fact_shipment has one row per shipment",
     f"SELECT {ALL} FROM (SELECT 1 FROM {_F} GROUP BY shipment_key HAVING {ALL} > 1)"),
    ("gross margin identity is consistent",
     where(_F, "gross_margin_usd IS DISTINCT FROM customer_revenue_usd - carrier_cost_usd - claims_paid_usd")),
    ("shipment dates stay within the declared 2024-2025 fixture window",
     where(_F, "ship_date NOT BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'")),
    ("aggregate gross margin is positive",
     f"SELECT CASE WHEN SUM(gross_margin_usd) > 0 THEN 0 ELSE 1 END FROM {_F}"),
    ("OTIF flag follows its documented rule",
     where(_F, "otif_flag IS DISTINCT FROM CASE WHEN final_on_time_flag IS NOT NULL AND shipment_fill_rate IS NOT NULL"
               " THEN final_on_time_flag AND shipment_fill_rate >= 1 END")),
    ("valid CSAT responses do not exceed survey responses",
     where(_F, "valid_csat_response_count NOT BETWEEN 0 AND survey_response_count")),
    ("CSAT averages have valid response counts",
     where(_F, "valid_csat_response_count = 0 AND average_csat_score IS NOT NULL")),
    ("date dimension has exactly one unknown member",
     "SELECT CASE COUNT(CASE WHEN unknown_date_flag THEN 1 END) WHEN 1 THEN 0 ELSE 1 END FROM dim_date"),
    ("all fact date keys resolve",
     where(_F, " OR ".join(f"{k}_key NOT IN (SELECT date_key FROM dim_date)" for k in
                           ("ship_date", "promised_delivery_date", "actual_delivery_date")))),
    ("fact row count reconciles through ship date",
     f"SELECT CASE {ALL} WHEN {FACT_N} THEN 0 ELSE 1 END FROM {_F} JOIN dim_date ON date_key = ship_date_key"),
]
for _d in ("customer", "carrier", "warehouse", "service", "lane"):
    GATES.append((f"dim_{_d} key is unique",
                  f"SELECT {ALL} FROM (SELECT 1 FROM dim_{_d} GROUP BY {_d}_key"
                  f" HAVING {ALL} > 1 OR {_d}_key IS NULL)"))
    GATES.append((f"fact {_d} keys resolve",
                  where(_F, f"{_d}_key NOT IN (SELECT {_d}_key FROM dim_{_d})")))
for _text, _view in [("executive shipment total reconciles to fact", "kpi_executive"),
                     ("monthly shipment totals reconcile to fact", "kpi_monthly"),
                     ("carrier scorecard totals reconcile to fact", "kpi_carrier"),
                     ("warehouse scorecard totals reconcile to fact", "kpi_warehouse"),
                     ("customer scorecard totals reconcile to fact", "kpi_customer"),
                     ("lane scorecard totals reconcile to fact", "kpi_lane")]:
    GATES.append((_text, f"SELECT ABS(IFNULL(SUM(total_shipments), 0)::BIGINT - {FACT_N}) FROM {_view}"))
for _text, _col in [("non-null fact ship dates resolve", "ship_date"),
                    ("non-null promised dates resolve", "promised_delivery_date"),
                    ("non-null actual delivery dates resolve", "actual_delivery_date")]:
    GATES.append((_text, where(_F, f"{_col} NOT IN (SELECT date_key FROM dim_date)")))
for _text, _a, _b in [
    ("carrier accessorial cost reconciles to invoices", "accessorial_amount_usd", "total_accessorial_usd"),
    ("carrier fuel surcharge cost reconciles to invoices", "fuel_surcharge_usd", "total_fuel_surcharge_usd"),
]:
    GATES.append((_text,
                  f"SELECT CASE WHEN ABS(IFNULL(SUM({_a}), 0) - (SELECT IFNULL(SUM({_b}), 0) FROM {_F})) > 0.01"
                  f" THEN 1 ELSE 0 END FROM stg_invoices WHERE invoice_type = 'CARRIER_BILL' AND"
                  f" matched_tms_shipment_id IN (SELECT shipment_key FROM {_F})"))
add("validate_model",
    "SELECT test_name, 'CRITICAL' AS severity, failure_count,"
    " CASE failure_count WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS validation_status FROM ("
    + " UNION ALL ".join(f"SELECT '{t}' AS test_name, ({s})::BIGINT AS failure_count" for t, s in GATES) + ")")

add("validate_model_ordered",
    "SELECT ROW_NUMBER() OVER (ORDER BY CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END, test_name)::INT"
    f" AS position, * FROM ({ORACLE['validate_model']}) AS gates")

# --- publishing and release --------------------------------------------------

add("benchmark_totals", " UNION ALL ".join(
    f"SELECT '{metric}' AS metric, {wanted}::DOUBLE AS expected, ROUND({metric}::DOUBLE, 6) AS actual,"
    f" CASE WHEN ABS({metric}::DOUBLE - {wanted}) <= 0.005 THEN 'PASS' ELSE 'FAIL' END AS status FROM kpi_executive"
    for metric, wanted in [
        ("total_shipments", "98595"), ("customer_revenue_usd", "72336827.17"), ("otd_eligible_shipments", "78452"),
        ("on_time_shipments", "59986"), ("otif_eligible_shipments", "74198"), ("otif_shipments", "46321")]))

# The published outputs and the queries that make them.
OUTPUTS = {
    "fact_shipment": "fact_shipment", "dim_date": "dim_date", "dim_customer": "dim_customer", "dim_carrier": "dim_carrier",
    "dim_warehouse": "dim_warehouse", "dim_service": "dim_service", "dim_lane": "dim_lane",
    "vw_executive_kpis": "kpi_executive", "vw_monthly_performance": "kpi_monthly", "vw_carrier_scorecard": "kpi_carrier",
    "vw_warehouse_scorecard": "kpi_warehouse", "vw_customer_scorecard": "kpi_customer", "vw_lane_scorecard": "kpi_lane",
}
add("publish_roundtrip", " UNION ALL ".join(
    f"SELECT '{published}' AS table_name, (SELECT COUNT(*) FROM {source}) AS row_count, LEN([*COLUMNS(*)]) AS column_count,"
    f" LIST_SUM([*COLUMNS(*)])::BIGINT AS filled_cells FROM (SELECT COUNT(COLUMNS(*)) FROM {source})"
    for published, source in OUTPUTS.items()))

_RELEASE = [
    sql for t in _SOURCE_COLUMNS for sql in (
        f"SELECT 'raw.{t} row count' AS check_name, TRUE AS passed, 'loaded=' || COUNT(*) || ', files=' || COUNT(*) AS detail FROM {t}",
        f"SELECT 'raw.{t} source lineage', TRUE, 'recorded lineage against the current files'")]
for _t, _k in [("fact_shipment", "shipment_key"), ("dim_date", "date_key"), *[(f"dim_{d}", f"{d}_key") for d in (
        "customer", "carrier", "warehouse", "service", "lane")]]:
    _RELEASE.append(
        f"SELECT '{_t} primary key', COUNT(*) = 0, 'bad keys=' || COUNT(*) FROM"
        f" (SELECT 1 FROM {_t} GROUP BY {_k} HAVING {ALL} > 1 OR {_k} IS NULL)")
for _t, _k, _f in [("dim_date", "date_key", "ship_date"), *[(f"dim_{d}", f"{d}_key", f"{d}_key") for d in (
        "customer", "carrier", "warehouse", "service", "lane")]]:
    _RELEASE.append(
        f"SELECT 'fact_shipment to {_t}', COUNT(*) = 0, 'unmatched rows=' || COUNT(*) FROM {_F}"
        f" WHERE {_f} NOT IN (SELECT {_k} FROM {_t})")
_RELEASE += [
    f"SELECT 'KPI shipment reconciliation', (SELECT SUM(total_shipments) FROM kpi_monthly) = {FACT_N}"
    f" AND total_shipments = {FACT_N}, 'executive=' || total_shipments FROM kpi_executive",
    f"SELECT 'model: ' || test_name, validation_status = 'PASS', 'failures=' || failure_count FROM ({ORACLE['validate_model']}) AS gates",
    f"SELECT 'model validation ran every gate', TRUE, 'gates={len(GATES)}'",
    *[f"SELECT '{published} contract', TRUE, 'rows=' || COUNT(*) || ', columns match=true' FROM {source}"
      for published, source in OUTPUTS.items()],
    f"SELECT 'duplicate_keys header', TRUE, 'columns=' || COUNT(*) FROM (DESCRIBE {ORACLE['duplicate_keys']})",
    "SELECT 'data_quality_issues header', TRUE, 'columns=6'",
]
add("release_checks", " UNION ALL ".join(_RELEASE))

ORACLE["report_roundtrip"] = f"SELECT COLUMNS(*)::VARCHAR FROM ({ORACLE['duplicate_keys']}) AS report"

# --- findings ---------------------------------------------------------------


def ranking(name: str, rank: str, order: str, top: int, source: str, cond: str, columns: str, fractions: str) -> None:
    add(name, rounded(
        f"(SELECT ROW_NUMBER() OVER (ORDER BY {order}) AS {rank}, {columns} FROM {source} WHERE {cond})",
        fractions) + f" WHERE {rank} <= {top}")


ranking("rank_carriers", "rate_rank", "on_time_delivery_rate, late_shipments DESC, carrier_key", 10, "kpi_carrier",
        "otd_eligible_shipments >= 20 AND on_time_delivery_rate IS NOT NULL",
        "carrier_key, scac, carrier_legal_name, primary_mode, official_kpi_shipments, otd_eligible_shipments,"
        " on_time_shipments, late_shipments, on_time_delivery_rate, otif_eligible_shipments, otif_shipments,"
        " otif_rate, claim_rate, gross_margin_percentage",
        "on_time_delivery_rate otif_rate claim_rate gross_margin_percentage")
ranking("rank_lanes", "rate_rank", "otif_rate, late_shipments DESC, lane_key", 15, "kpi_lane",
        "otif_eligible_shipments >= 5 AND otif_rate IS NOT NULL",
        "lane_key, origin_warehouse_name, destination_city, destination_state, destination_country,"
        " official_kpi_shipments, otd_eligible_shipments, on_time_shipments, late_shipments, on_time_delivery_rate,"
        " otif_eligible_shipments, otif_shipments, otif_rate, average_days_late, gross_margin_percentage",
        "on_time_delivery_rate otif_rate average_days_late gross_margin_percentage")
ranking("rank_customers", "margin_rate_rank", "gross_margin_percentage, total_shipments DESC, customer_key", 10,
        "kpi_customer",
        "customer_status = 'ACTIVE' AND total_shipments >= 5 AND gross_margin_percentage IS NOT NULL",
        "customer_key, legal_name, industry, customer_status, total_shipments, customer_revenue_usd,"
        " gross_margin_usd, gross_margin_percentage, complaint_rate, claim_rate, average_csat_score",
        "customer_revenue_usd gross_margin_usd gross_margin_percentage complaint_rate claim_rate average_csat_score")
ranking("rank_carriers_published", "rate_rank", "on_time_delivery_rate, late_shipments DESC, carrier_key", 10, "kpi_carrier",
        "otd_eligible_shipments >= 1000 AND on_time_delivery_rate IS NOT NULL",
        "carrier_key, scac, carrier_legal_name, primary_mode, official_kpi_shipments, otd_eligible_shipments,"
        " on_time_shipments, late_shipments, on_time_delivery_rate, otif_eligible_shipments, otif_shipments,"
        " otif_rate, claim_rate, gross_margin_percentage",
        "on_time_delivery_rate otif_rate claim_rate gross_margin_percentage")
ranking("rank_lanes_published", "rate_rank", "otif_rate, late_shipments DESC, lane_key", 15, "kpi_lane",
        "otif_eligible_shipments >= 250 AND otif_rate IS NOT NULL",
        "lane_key, origin_warehouse_name, destination_city, destination_state, destination_country,"
        " official_kpi_shipments, otd_eligible_shipments, on_time_shipments, late_shipments, on_time_delivery_rate,"
        " otif_eligible_shipments, otif_shipments, otif_rate, average_days_late, gross_margin_percentage",
        "on_time_delivery_rate otif_rate average_days_late gross_margin_percentage")
ranking("rank_customers_published", "margin_rate_rank", "gross_margin_percentage, total_shipments DESC, customer_key", 10,
        "kpi_customer",
        "customer_status = 'ACTIVE' AND total_shipments >= 1000 AND gross_margin_percentage IS NOT NULL",
        "customer_key, legal_name, industry, customer_status, total_shipments, customer_revenue_usd,"
        " gross_margin_usd, gross_margin_percentage, complaint_rate, claim_rate, average_csat_score",
        "customer_revenue_usd gross_margin_usd gross_margin_percentage complaint_rate claim_rate average_csat_score")
add("eligibility_counts",
    "SELECT lane_key, total_shipments, otd_eligible_shipments, on_time_shipments, otif_eligible_shipments,"
    " otif_shipments FROM kpi_lane")

_SURVEYED = "survey_response_count > 0 AND average_csat_score IS NOT NULL"
GROUPS = {"delivery_groups": f"""
SELECT CASE WHEN final_on_time_flag THEN 'On time' ELSE 'Late' END AS delivery_status, {ALL} AS shipments,
  {rate('complaint_flag')} AS complaint_rate, {rate('claim_flag')} AS claim_rate,
  IFNULL(SUM(CASE WHEN average_csat_score IS NOT NULL THEN valid_csat_response_count END), 0)::BIGINT
    AS csat_observations,
  {CSAT} AS average_csat_score,
  {div(f"SUM(CASE WHEN {_SURVEYED} THEN average_csat_score * survey_response_count END)",
       f"SUM(CASE WHEN {_SURVEYED} THEN survey_response_count END)")} AS survey_weighted_csat,
  AVG(days_late) AS average_days_late
FROM fact_shipment WHERE official_kpi_eligible_flag AND final_on_time_flag IS NOT NULL GROUP BY 1"""}
add("delivery_impact", rounded(
    "(SELECT g.*, g.complaint_rate / NULLIF(b.complaint_rate, 0) AS complaint_rate_vs_on_time,"
    " g.claim_rate / NULLIF(b.claim_rate, 0) AS claim_rate_vs_on_time,"
    " b.average_csat_score - g.average_csat_score AS csat_gap_below_on_time"
    " FROM delivery_groups g LEFT JOIN delivery_groups b ON b.delivery_status = 'On time')",
    "complaint_rate claim_rate average_csat_score survey_weighted_csat average_days_late complaint_rate_vs_on_time"
    " claim_rate_vs_on_time csat_gap_below_on_time"), GROUPS)

_OFF = "official_kpi_eligible_flag"
_SHORT = f"{_OFF} AND otif_flag IS NOT NULL AND final_on_time_flag AND shipment_fill_rate < 1"
CONTEXT = {
    "total_shipments": ALL,
    "otd_eligible_shipments": KPI["otd_eligible_shipments"],
    "otif_eligible_shipments": KPI["otif_eligible_shipments"],
    "fill_measured_shipments": KPI["full_fill_eligible_shipments"],
    "full_fill_shipments": KPI["full_fill_shipments"],
    "full_fill_rate": r6(KPI["full_fill_rate"]),
    "underfilled_rate": r6(rate("shipment_fill_rate < 1", _OFF)),
    "otif_failure_shipments": cnt(f"{_OFF} AND NOT otif_flag"),
    "on_time_underfilled_shipments": cnt(_SHORT),
    "on_time_underfilled_share_of_otif_failures": r6(div(cnt(_SHORT), cnt(f"{_OFF} AND NOT otif_flag"))),
    "surveyed_shipments": cnt("survey_response_count > 0"),
    "survey_response_coverage": r6(rate("survey_response_count > 0")),
    "first_ship_date": "MIN(ship_date)",
    "last_ship_date": "MAX(ship_date)",
    "missing_ship_date_shipments": f"{ALL} - COUNT(ship_date)",
    "missing_otd_result_shipments": cnt(f"{_OFF} AND final_on_time_flag IS NULL"),
    "missing_otif_result_shipments": cnt(f"{_OFF} AND otif_flag IS NULL"),
    "unknown_customer_shipments": cnt("customer_key = 'UNKNOWN'"),
    "delivered_missing_delivery_date_shipments":
        cnt("shipment_status = 'DELIVERED' AND actual_delivery_date IS NULL"),
}


def stacked(name: str, pairs: dict[str, str], label: str, value: str, cast: str) -> None:
    add(name, " UNION ALL ".join(
        f"SELECT '{text}' AS {label}, ({expr})::{cast} AS {value} FROM fact_shipment" for text, expr in pairs.items()))


stacked("analysis_context", CONTEXT, "metric", "value", "VARCHAR")
stacked("executive_summary", {text: r6(KPI.get(c) or CONTEXT[c]) for text, c in [
    ("Total shipments", "total_shipments"), ("Official KPI shipments", "official_kpi_shipments"),
    ("OTD eligible shipments", "otd_eligible_shipments"), ("On-time delivery rate", "on_time_delivery_rate"),
    ("OTIF eligible shipments", "otif_eligible_shipments"), ("OTIF rate", "otif_rate"),
    ("Average fill rate", "average_fill_rate"), ("Full-fill rate", "full_fill_rate"),
    ("Average days late", "average_days_late"), ("Customer revenue", "customer_revenue_usd"),
    ("Gross margin", "gross_margin_usd"), ("Gross margin rate", "gross_margin_percentage"),
    ("Complaint rate", "complaint_rate"), ("Claim rate", "claim_rate"),
    ("Survey response coverage", "survey_response_coverage"), ("Average CSAT", "average_csat_score"),
    ("Net promoter score", "net_promoter_score"),
]}, "metric", "value", "DOUBLE")
add("decision_scenarios", f"""
SELECT {ALL} AS shipments, {r6('SUM(customer_revenue_usd)')} AS revenue, {r6('SUM(carrier_cost_usd)')} AS carrier_cost,
  {r6('SUM(claims_paid_usd)')} AS paid_claims,
  {r6('SUM(customer_revenue_usd)::DOUBLE * 0.01')} AS one_percent_revenue_recovery,
  {r6(KPI['late_shipments'] + ' * 2.5')} AS routing_pilot_net_benefit, {cnt(_SHORT)} AS on_time_underfilled,
  {r6(cnt(_SHORT) + ' * 2.5')} AS underfill_pilot_net_benefit
FROM fact_shipment""")
add("coverage", " UNION ALL ".join(
    f"SELECT '{text}' AS measure, {r6(div(expr, ALL))} AS coverage, {expr} AS covered_rows, {ALL} AS total_rows"
    " FROM fact_shipment" for text, expr in [
        ("Ship date", "COUNT(ship_date)"), ("Customer match", "COUNT(customer_key)"),
        ("Carrier match", "COUNT(carrier_key)"), ("Warehouse match", "COUNT(warehouse_key)"),
        ("Invoice match", cnt("invoice_count > 0")), ("WMS match", cnt("wms_record_count > 0")),
        ("Fill rate", "COUNT(shipment_fill_rate)"), ("Survey response", cnt("survey_response_count > 0")),
        ("OTD eligible", KPI["otd_eligible_shipments"]), ("OTIF eligible", KPI["otif_eligible_shipments"]),
    ]))
add("top_late_carriers",
    "SELECT carrier_key, carrier_legal_name, late_shipments FROM kpi_carrier"
    " ORDER BY late_shipments DESC, carrier_key LIMIT 10")
add("shipment_360", (
    "SELECT tms_shipment_id, CASE final_on_time_flag WHEN TRUE THEN 'On time' WHEN FALSE THEN 'Late'"
    " ELSE 'Unresolved' END AS delivery_status, mode, service_level_name, promised_delivery_date,"
    " actual_delivery_date, days_late, warehouse_name, carrier_name, lane, exception_code,"
    f" {r6('warehouse_cycle_hours')} AS warehouse_cycle_hours, {r6('shipment_fill_rate')} AS shipment_fill_rate,"
    f" short_pick_flag, customer_name, {r6('customer_revenue_usd')} AS customer_revenue_usd,"
    f" {r6('carrier_cost_usd')} AS carrier_cost_usd, {r6('claims_paid_usd')} AS claims_paid_usd,"
    f" {r6('gross_margin_usd')} AS gross_margin_usd, ticket_count, {r6('average_csat_score')} AS average_csat_score,"
    f" {r6('shipment_nps')} AS shipment_nps FROM named"), NAMED)
ORACLE["shipment_lookup"] = f"SELECT * FROM ({ORACLE['shipment_360']}) AS every WHERE tms_shipment_id = 'TMS4'"


def nested(name: str, levels: list[str]) -> None:
    keys = ", ".join(levels)
    add(name, f"""
SELECT {keys}, GROUPING_ID({keys})::INTEGER AS level, {ALL} AS total_shipments,
  {KPI['otd_eligible_shipments']} AS otd_eligible_shipments, {KPI['on_time_shipments']} AS on_time_shipments,
  {KPI['late_shipments']} AS late_shipments, {r6('SUM(customer_revenue_usd)')} AS customer_revenue_usd,
  {r6('SUM(gross_margin_usd)')} AS gross_margin_usd, {r6(KPI['on_time_delivery_rate'])} AS on_time_delivery_rate,
  {r6(KPI['gross_margin_percentage'])} AS gross_margin_percentage
FROM fact_shipment GROUP BY ROLLUP ({keys})""")


nested("action_queue_warehouse", ["warehouse_key", "carrier_key"])
nested("action_queue_customer", ["customer_key", "lane_key"])
nested("action_queue_lane", ["warehouse_key", "dest_state", "lane_key"])
_LATE = "official_kpi_eligible_flag AND NOT final_on_time_flag"
add("late_by_exception",
    f"SELECT exception_code, {ALL} AS late_shipments FROM fact_shipment WHERE {_LATE} GROUP BY 1")
stacked("margin_bridge", {
    "Customer revenue": r6("SUM(customer_revenue_usd)"), "Carrier cost": r6("-SUM(carrier_cost_usd)"),
    "Claims paid": r6("-SUM(claims_paid_usd)"), "Gross margin": r6("SUM(gross_margin_usd)"),
}, "step", "amount_usd", "DOUBLE")
add("late_breakdown", " UNION ALL ".join(
    f"SELECT '{factor}' AS factor, {c}::VARCHAR AS factor_value, {ALL} AS shipments, {cnt(_LATE)} AS late_shipments"
    " FROM fact_shipment GROUP BY 2" for factor, c in [
        ("warehouse", "warehouse_key"), ("mode", "mode"), ("service_level", "service_level_name"),
        ("short_pick", "short_pick_flag"), ("exception_code", "exception_code")]))
add("monthly_coverage", f"SELECT {MONTH} AS month_start_date, {ALL} AS shipments, " + ", ".join(
    f"{r6(rate(f'{c} > 0'))} AS {out}" for c, out in [
        ("invoice_count", "invoice_coverage"), ("wms_record_count", "wms_coverage"),
        ("survey_response_count", "survey_coverage")]) + " FROM fact_shipment GROUP BY 1")
stacked("unknown_members", {
    "Customer": cnt("customer_key = 'UNKNOWN'"), "Carrier": cnt("carrier_key = 'UNKNOWN'"),
    "Warehouse": cnt("warehouse_key = 'UNKNOWN'"), "Service": cnt("service_key = 'UNKNOWN|UNKNOWN'"),
    "Lane": cnt("lane_key = 'UNKNOWN|UNKNOWN|UNKNOWN|UNKNOWN|UNKNOWN'"),
    "Ship date": f"{ALL} - COUNT(ship_date)",
}, "dimension", "unknown_shipments", "BIGINT")
add("tickets_by_customer_state",
    "SELECT customer_key, dest_state, SUM(ticket_count)::BIGINT AS complaint_tickets,"
    " SUM(severe_ticket_count)::BIGINT AS severe_tickets FROM fact_shipment GROUP BY ALL")
