"""Staging, mart and scorecard CTEs in DuckDB SQL."""

import re

from haulgrain import contracts as C
from oracle.raw_tables import raw_ctes

CLEAN = {
    "text": "NULLIF(TRIM({0}), '')",
    "upper": "UPPER(NULLIF(TRIM({0}), ''))",
    "lower": "LOWER(NULLIF(TRIM({0}), ''))",
    "code": "UPPER(TRANSLATE(TRIM({0}), '- ', ''))",
    "country": "CASE WHEN UPPER(TRIM({0})) IN ('US', 'USA', 'UNITED STATES', 'UNITED STATES OF AMERICA')"
               " THEN 'US' ELSE UPPER(NULLIF(TRIM({0}), '')) END",
    "int": "TRY_CAST({0} AS INTEGER)",
    "double": "TRY_CAST({0} AS DOUBLE)",
    "money": "TRY_CAST({0} AS DECIMAL(18,2))",
    "date": "TRY_CAST({0} AS DATE)",
    "ts": "TRY_CAST({0} AS TIMESTAMP)",
    "tri": "TRY_CAST({0} AS BOOLEAN)",
    "flag": "IFNULL(TRY_CAST({0} AS BOOLEAN), FALSE)",
}


def cleaned(table: str) -> str:
    cols = ", ".join(
        f"{CLEAN[rule].format(chr(34) + src + chr(34))} AS {dst}"
        for dst, rule, src in C.staged_columns(table)
    )
    return f"SELECT {cols} FROM {C.RAW_OF_STAGED[table]}"


def names(table: str, alias: str, *, stop: str | None = None, start: str | None = None) -> str:
    """Contract columns of a staging table up to ``stop`` or from after ``start``."""
    cols = [dst for dst, _, _ in C.staged_columns(table)]
    if stop:
        cols = cols[: cols.index(stop) + 1]
    if start:
        cols = cols[cols.index(start) + 1 :]
    return ", ".join(f"{alias}.{c}" for c in cols)


def newest(key: str, value: str = "tms_shipment_id") -> str:
    """One live shipment per key, the last updated."""
    return (
        f"SELECT {key}, FIRST({value} ORDER BY last_update_ts DESC NULLS LAST, tms_shipment_id DESC) AS hit,"
        " FIRST(actual_delivery_ts ORDER BY last_update_ts DESC NULLS LAST, tms_shipment_id DESC) AS hit_ts"
        f" FROM stg_shipments WHERE final_live_shipment_flag AND {key} IS NOT NULL GROUP BY {key}"
    )


def hours(a: str, b: str) -> str:
    return f"IF({b} >= {a}, DATE_DIFF('minute', {a}, {b}) / 60.0::DOUBLE, NULL)"


def first_label(column: str, buckets, otherwise: str) -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"CONTAINS({column}, '{w}')" for w in words) + f" THEN '{label}'"
        for label, words in buckets
    )
    return f"CASE {arms} ELSE {otherwise} END"


# Fixed values, written apart from the library's: label and the words that give it, first match wins.
CLAIM_WORDS = [("CONCEALED DAMAGE", ["CONCEALED"]), ("DAMAGE", ["DAMAGE"]), ("SHORTAGE", ["SHORT"]), ("LOSS", ["LOSS", "LOST"])]
TICKET_WORDS = [
    ("DAMAGE", ["DAMAGE"]), ("LATE DELIVERY", ["LATE", "DELAY"]), ("SHORTAGE / PARTIAL DELIVERY", ["PARTIAL", "SHORT", "MISSING"]),
    ("LOST SHIPMENT", ["LOST", "LOSS"]), ("DRIVER BEHAVIOR", ["DRIVER"]), ("BILLING", ["BILL", "INVOICE"])]

FREIGHT = "IFNULL(line_amount_usd, 0) + IFNULL(accessorial_amount_usd, 0) + IFNULL(fuel_surcharge_usd, 0)"
DLV_DAY = "CAST(actual_delivery_ts AS DATE)"
SERVICE_KEY = (
    "IFNULL(mode, 'UNKNOWN') || '|' || IFNULL('CODE:' || service_level_code,"
    " IFNULL('NAME:' || service_level_name, 'UNKNOWN'))"
)
LANE_PARTS = ["origin_warehouse_id", "dest_country", "dest_state", "dest_city", "dest_postal"]
LANE_KEY = " || '|' || ".join(f"IFNULL({p}, 'UNKNOWN')" for p in LANE_PARTS)

CTES: dict[str, str] = raw_ctes()

for _t in ("stg_customers", "stg_customer_crosswalk", "stg_warehouses", "stg_carriers"):
    CTES[_t] = cleaned(_t)

CTES["ship_clean"] = (
    "SELECT *, IFNULL(NOT is_void AND shipment_status NOT IN ('VOID', 'CANCELLED', 'CANCELED', 'REPLACED'), FALSE)"
    f" AS base_eligible_flag FROM ({cleaned('stg_shipments')})"
)
CTES["ship_dated"] = f"""
SELECT s.*,
  IF(shipment_status = 'DELIVERED', {DLV_DAY} <= promised_delivery_date, NULL) AS calculated_on_time_flag,
  IF(shipment_status = 'DELIVERED',
     CASE WHEN {DLV_DAY} > promised_delivery_date THEN {DLV_DAY} - promised_delivery_date
          WHEN {DLV_DAY} <= promised_delivery_date THEN 0 END, NULL)::BIGINT AS days_late,
  base_eligible_flag AND tms_shipment_id NOT IN (
    SELECT parent_tms_shipment_id FROM ship_clean
    WHERE base_eligible_flag AND parent_tms_shipment_id IS NOT NULL) AS final_live_shipment_flag
FROM ship_clean s"""
CTES["stg_shipments"] = """
SELECT *, IFNULL(source_on_time_flag, calculated_on_time_flag) AS final_on_time_flag,
  IFNULL(final_live_shipment_flag AND ship_create_date <= (SELECT MAX(ship_create_date) - 3 FROM ship_dated), FALSE)
    AS official_kpi_eligible_flag
FROM ship_dated"""
CTES["ship_ids"] = "SELECT DISTINCT tms_shipment_id FROM stg_shipments WHERE tms_shipment_id IS NOT NULL"
CTES["ship_by_id"] = (
    "SELECT tms_shipment_id, MAX(actual_delivery_ts) AS hit_ts FROM stg_shipments GROUP BY 1"
)
CTES["by_sales_order"] = newest("sales_order_id")
CTES["by_pro"] = newest("pro_number")
CTES["by_tracking"] = newest("tracking_number")
CTES["by_code"] = (
    "SELECT tms_customer_code_normalized AS code, FIRST(erp_customer_id ORDER BY is_primary_mapping DESC,"
    " effective_from DESC NULLS LAST, erp_customer_id DESC) AS hit FROM stg_customer_crosswalk GROUP BY 1"
)

CTES["stg_shipment_lines"] = f"""
SELECT *, IF(qty_ordered > 0, qty_shipped / qty_ordered, NULL) AS line_fill_rate,
  CASE WHEN qty_shipped IS NULL THEN 'INCOMPLETE EXTRACT'
       WHEN LEAST(qty_shipped, qty_ordered) < 0 THEN 'INVALID QUANTITY'
       WHEN qty_ordered IS NULL THEN 'UNKNOWN'
       ELSE ['SHORT SHIPPED', 'FULLY SHIPPED', 'OVER SHIPPED'][SIGN(qty_shipped - qty_ordered) + 2] END
    AS quantity_status,
  qty_shipped * unit_weight_lb AS calculated_line_weight_lb,
  IFNULL(tms_shipment_id IN (SELECT tms_shipment_id FROM ship_ids), FALSE) AS shipment_match_flag
FROM ({cleaned('stg_shipment_lines')})"""

CTES["stg_tracking_events"] = f"""
SELECT *, duplicate_rank = 1 AS keep_event_flag, duplicate_rank > 1 AS duplicate_event_flag,
  IFNULL(tms_shipment_id IN (SELECT tms_shipment_id FROM ship_ids), FALSE) AS shipment_match_flag
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY IF(event_code = 'DLV', tms_shipment_id || '|DLV', tracking_event_id)
        ORDER BY ingested_ts DESC NULLS LAST, event_ts_utc DESC NULLS LAST, tracking_event_id DESC NULLS LAST)
        AS duplicate_rank
      FROM ({cleaned('stg_tracking_events')}))"""
CTES["stg_tracking_events_dedup"] = "SELECT * FROM stg_tracking_events WHERE keep_event_flag"

CTES["match_wms"] = f"""
SELECT w.*, IFNULL(i.tms_shipment_id, so.hit) AS matched_tms_shipment_id,
  CASE WHEN i.tms_shipment_id IS NOT NULL THEN 'TMS SHIPMENT ID'
       WHEN so.hit IS NOT NULL THEN 'SALES ORDER FALLBACK' ELSE 'UNMATCHED' END AS shipment_match_method
FROM ({cleaned('stg_wms_outbound')}) w
LEFT JOIN ship_ids i ON i.tms_shipment_id = w.source_tms_shipment_id
LEFT JOIN by_sales_order so ON so.sales_order_id = w.sales_order_id"""
CTES["stg_wms_outbound"] = f"""
SELECT {names('stg_wms_outbound', 'w', stop='source_tms_shipment_id')},
  matched_tms_shipment_id, shipment_match_method,
  {names('stg_wms_outbound', 'w', start='source_tms_shipment_id')},
  {hours('pick_start_ts', 'pack_complete_ts')} AS pick_to_pack_hours,
  {hours('pack_complete_ts', 'ship_confirm_ts')} AS pack_to_ship_hours,
  {hours('pick_start_ts', 'ship_confirm_ts')} AS total_warehouse_cycle_hours,
  IFNULL(pick_start_ts > pack_complete_ts, FALSE) OR IFNULL(pack_complete_ts > ship_confirm_ts, FALSE)
    AS invalid_timestamp_sequence_flag,
  shipment_match_method <> 'UNMATCHED' AS shipment_match_flag
FROM match_wms w"""

CTES["match_invoices"] = f"""
SELECT v.*, COALESCE(i.tms_shipment_id, so.hit, pro.hit) AS matched_tms_shipment_id,
  CASE WHEN i.tms_shipment_id IS NOT NULL THEN 'TMS SHIPMENT ID'
       WHEN so.hit IS NOT NULL THEN 'SALES ORDER FALLBACK'
       WHEN pro.hit IS NOT NULL THEN 'PRO NUMBER FALLBACK' ELSE 'UNMATCHED' END AS shipment_match_method
FROM ({cleaned('stg_invoices')}) v
LEFT JOIN ship_ids i ON i.tms_shipment_id = v.source_tms_shipment_id
LEFT JOIN by_sales_order so ON so.sales_order_id = v.sales_order_id
LEFT JOIN by_pro pro ON pro.pro_number = v.pro_number"""
CTES["stg_invoices"] = f"""
SELECT {names('stg_invoices', 'v', stop='pro_number')}, matched_tms_shipment_id, shipment_match_method,
  {names('stg_invoices', 'v', start='pro_number')},
  ({FREIGHT})::DECIMAL(18,2) AS net_freight_amount_usd,
  ({FREIGHT} + IFNULL(tax_usd, 0))::DECIMAL(18,2) AS invoice_total_usd,
  (CASE invoice_type WHEN 'CUSTOMER' THEN {FREIGHT} ELSE 0 END)::DECIMAL(18,2) AS customer_revenue_usd,
  (CASE invoice_type WHEN 'CARRIER_BILL' THEN {FREIGHT} ELSE 0 END)::DECIMAL(18,2) AS carrier_cost_usd,
  shipment_match_method <> 'UNMATCHED' AS shipment_match_flag
FROM match_invoices v"""

CTES["match_claims"] = f"""
SELECT q.*, IFNULL(i.tms_shipment_id, pro.hit) AS matched_tms_shipment_id,
  CASE WHEN i.tms_shipment_id IS NOT NULL THEN 'TMS SHIPMENT ID'
       WHEN pro.hit IS NOT NULL THEN 'PRO NUMBER FALLBACK' ELSE 'UNMATCHED' END AS shipment_match_method,
  IF(i.tms_shipment_id IS NULL, pro.hit_ts, i.hit_ts) AS actual_delivery_ts
FROM ({cleaned('stg_claims')}) q
LEFT JOIN ship_by_id i ON i.tms_shipment_id = q.source_tms_shipment_id
LEFT JOIN by_pro pro ON pro.pro_number = q.pro_number"""
CTES["stg_claims"] = f"""
SELECT {names('stg_claims', 'q', stop='pro_number')}, matched_tms_shipment_id, shipment_match_method,
  {first_label('claim_type', CLAIM_WORDS, "IFNULL(claim_type, 'OTHER')")} AS claim_type,
  {names('stg_claims', 'q', start='claim_type')},
  IFNULL(claim_amount_paid_usd > claim_amount_requested_usd, FALSE) AS paid_exceeds_requested_flag,
  (filed_date - {DLV_DAY})::BIGINT AS days_delivery_to_claim,
  shipment_match_method <> 'UNMATCHED' AS shipment_match_flag
FROM match_claims q"""

CTES["match_tickets"] = f"""
SELECT t.*,
  IFNULL(cu.erp_customer_id, x.hit) AS matched_erp_customer_id,
  CASE WHEN cu.erp_customer_id IS NOT NULL THEN 'ERP CUSTOMER ID'
       WHEN x.hit IS NOT NULL THEN 'CUSTOMER CROSSWALK' ELSE 'UNMATCHED' END AS customer_match_method,
  IFNULL(i.tms_shipment_id, tr.hit) AS matched_tms_shipment_id,
  CASE WHEN i.tms_shipment_id IS NOT NULL THEN 'TMS SHIPMENT ID'
       WHEN tr.hit IS NOT NULL THEN 'TRACKING NUMBER FALLBACK' ELSE 'UNMATCHED' END AS shipment_match_method
FROM ({cleaned('stg_crm_tickets')}) t
LEFT JOIN ship_ids i ON i.tms_shipment_id = t.source_tms_shipment_id
LEFT JOIN by_tracking tr ON tr.tracking_number = t.tracking_number
LEFT JOIN (SELECT DISTINCT erp_customer_id FROM stg_customers) cu ON cu.erp_customer_id = t.source_erp_customer_id
LEFT JOIN by_code x ON x.code = t.tms_customer_code_normalized"""
CTES["stg_crm_tickets"] = f"""
SELECT ticket_id, opened_ts, source_erp_customer_id, tms_customer_code_raw, tms_customer_code_normalized,
  matched_erp_customer_id, customer_match_method, source_tms_shipment_id, tracking_number,
  matched_tms_shipment_id, shipment_match_method, channel, category_raw,
  {first_label('UPPER(category_raw)', TICKET_WORDS, "'OTHER'")} AS category_normalized,
  {names('stg_crm_tickets', 't', start='category_raw')},
  IFNULL(resolution_hours >= 0, FALSE) AS valid_resolution_time_flag,
  shipment_match_method <> 'UNMATCHED' AS shipment_match_flag,
  customer_match_method <> 'UNMATCHED' AS customer_match_flag
FROM match_tickets t"""

CTES["stg_csat_responses"] = f"""
SELECT *, IFNULL(csat_score IN (1, 2, 3, 4, 5), FALSE) AS valid_csat_flag,
  IFNULL(nps_score >= 0 AND nps_score <= 10, FALSE) AS valid_nps_flag,
  CASE WHEN nps_score > 10 THEN 'INVALID' WHEN nps_score > 8 THEN 'PROMOTER' WHEN nps_score > 6 THEN 'PASSIVE'
       WHEN nps_score >= 0 THEN 'DETRACTOR' ELSE 'INVALID' END AS nps_category,
  IF(response_ts >= survey_sent_ts, response_ts::DATE - survey_sent_ts::DATE, NULL)::BIGINT AS response_days,
  IFNULL(tms_shipment_id IN (SELECT tms_shipment_id FROM ship_ids), FALSE) AS shipment_match_flag,
  IFNULL(erp_customer_id IN (SELECT erp_customer_id FROM stg_customers WHERE erp_customer_id IS NOT NULL), FALSE)
    AS customer_match_flag
FROM ({cleaned('stg_csat_responses')})"""

# --- child totals -----------------------------------------------------------


def n(cond: str | None = None) -> str:
    return f"COUNT(CASE WHEN {cond} THEN 1 END)" if cond else "COUNT(*)"


CTES["agg_lines"] = f"""
SELECT tms_shipment_id, {n()} AS shipment_line_count, SUM(qty_ordered)::BIGINT AS total_quantity_ordered,
  SUM(qty_shipped)::BIGINT AS total_quantity_shipped,
  {n()} - COUNT(qty_shipped) AS missing_shipped_quantity_lines,
  {n("quantity_status = 'SHORT SHIPPED'")} AS short_shipped_lines,
  {n("quantity_status = 'OVER SHIPPED'")} AS over_shipped_lines,
  SUM(calculated_line_weight_lb) AS calculated_line_weight_lb,
  BOOL_OR(hazardous_flag) AS hazardous_shipment_flag,
  IF({n()} = COUNT(qty_shipped) AND SUM(qty_ordered) > 0,
     SUM(qty_shipped)::DOUBLE / SUM(qty_ordered)::DOUBLE, NULL) AS shipment_fill_rate
FROM stg_shipment_lines GROUP BY 1"""
CTES["agg_events"] = f"""
SELECT tms_shipment_id, {n()} AS tracking_event_count,
  MIN(IF(event_code = 'PU', event_ts_local, NULL)) AS first_pickup_event_ts,
  MAX(IF(event_code = 'DLV', event_ts_local, NULL)) AS final_delivery_event_ts,
  {n("exception_reason IS NOT NULL OR event_code IN ('EXC', 'DELAY', 'LATE')")} AS tracking_exception_count
FROM stg_tracking_events_dedup GROUP BY 1"""
CTES["agg_wms"] = f"""
SELECT matched_tms_shipment_id AS tms_shipment_id, {n()} AS wms_record_count,
  MAX(total_warehouse_cycle_hours) AS warehouse_cycle_hours, MAX(pick_to_pack_hours) AS pick_to_pack_hours,
  MAX(pack_to_ship_hours) AS pack_to_ship_hours, BOOL_OR(short_pick_flag) AS short_pick_flag,
  AVG(inventory_accuracy_snapshot) AS average_inventory_accuracy
FROM stg_wms_outbound WHERE shipment_match_flag GROUP BY 1"""
CTES["agg_invoices"] = f"""
SELECT matched_tms_shipment_id AS tms_shipment_id, {n()} AS invoice_count,
  SUM(customer_revenue_usd) AS customer_revenue_usd, SUM(carrier_cost_usd) AS carrier_cost_usd,
  SUM(IF(invoice_type = 'CARRIER_BILL', accessorial_amount_usd, NULL)) AS total_accessorial_usd,
  SUM(IF(invoice_type = 'CARRIER_BILL', fuel_surcharge_usd, NULL)) AS total_fuel_surcharge_usd,
  {n('dispute_flag')} AS disputed_invoice_count
FROM stg_invoices WHERE shipment_match_flag GROUP BY 1"""
CTES["agg_claims"] = f"""
SELECT matched_tms_shipment_id AS tms_shipment_id, {n()} AS claim_count,
  SUM(claim_amount_requested_usd) AS claims_requested_usd,
  SUM(IFNULL(claim_amount_paid_usd, 0)) AS claims_paid_usd
FROM stg_claims WHERE shipment_match_flag GROUP BY 1"""
CTES["agg_tickets"] = f"""
SELECT matched_tms_shipment_id AS tms_shipment_id, {n()} AS ticket_count,
  {n("severity IN ('HIGH', 'CRITICAL')")} AS severe_ticket_count,
  AVG(IF(valid_resolution_time_flag, resolution_hours, NULL)) AS average_resolution_hours,
  {n("category_normalized = 'LATE DELIVERY'")} AS late_delivery_ticket_count,
  {n("category_normalized = 'DAMAGE'")} AS damage_ticket_count
FROM stg_crm_tickets WHERE shipment_match_flag GROUP BY 1"""
CTES["agg_surveys"] = f"""
SELECT tms_shipment_id, {n()} AS survey_response_count, {n('valid_csat_flag')} AS valid_csat_response_count,
  AVG(IF(valid_csat_flag, csat_score, NULL)) AS average_csat_score,
  {n("nps_category = 'PROMOTER'")} AS promoter_count, {n("nps_category = 'PASSIVE'")} AS passive_count,
  {n("nps_category = 'DETRACTOR'")} AS detractor_count,
  100.0::DOUBLE * SUM(CASE nps_category WHEN 'PROMOTER' THEN 1 WHEN 'DETRACTOR' THEN -1 ELSE 0 END)::DOUBLE
    / NULLIF({n('valid_nps_flag')}, 0) AS shipment_nps
FROM stg_csat_responses WHERE shipment_match_flag GROUP BY 1"""

# --- dimensions -------------------------------------------------------------

CTES["dim_customer"] = """
SELECT erp_customer_id AS customer_key, erp_customer_id, legal_name, dba_name, parent_erp_customer_id, industry,
  customer_status, payment_terms, credit_limit_usd, primary_bill_to_state, account_owner_email, annual_volume_tier
FROM stg_customers WHERE NOT is_test_account
UNION ALL VALUES ('UNKNOWN', 'UNKNOWN', 'Unknown Customer', NULL, NULL, 'UNKNOWN', 'UNKNOWN', NULL, NULL, NULL,
  NULL, 'UNKNOWN')"""
CTES["dim_carrier"] = """
SELECT carrier_id AS carrier_key, carrier_id, scac, carrier_legal_name, mode AS primary_mode, carrier_status
FROM stg_carriers
UNION ALL VALUES ('UNKNOWN', 'UNKNOWN', NULL, 'Unknown Carrier', 'UNKNOWN', 'UNKNOWN')"""
CTES["dim_warehouse"] = """
SELECT warehouse_id AS warehouse_key, * EXCLUDE (source_system) FROM stg_warehouses
UNION ALL VALUES ('UNKNOWN', 'UNKNOWN', NULL, 'Unknown Warehouse', NULL, NULL, NULL, NULL, NULL, NULL, NULL, FALSE)"""
CTES["service_rows"] = f"""
SELECT {SERVICE_KEY} AS service_key, IFNULL(mode, 'UNKNOWN') AS mode,
  IFNULL(service_level_code, 'UNKNOWN') AS code, IFNULL(service_level_name, 'UNKNOWN') AS label, planned_transit_days
FROM stg_shipments WHERE final_live_shipment_flag"""
CTES["dim_service"] = """
SELECT service_key, mode, c.code AS service_level_code, l.label AS service_level_name,
  ROUND(m.days)::INTEGER AS planned_transit_days
FROM (SELECT service_key, mode, MEDIAN(planned_transit_days) AS days FROM service_rows GROUP BY ALL) m
JOIN (SELECT service_key, mode, FIRST(code ORDER BY cnt DESC, code) AS code
      FROM (SELECT service_key, mode, code, COUNT(*) AS cnt FROM service_rows GROUP BY ALL) GROUP BY ALL) c
  USING (service_key, mode)
JOIN (SELECT service_key, mode, FIRST(label ORDER BY cnt DESC, label) AS label
      FROM (SELECT service_key, mode, label, COUNT(*) AS cnt FROM service_rows GROUP BY ALL) GROUP BY ALL) l
  USING (service_key, mode)
WHERE service_key <> 'UNKNOWN|UNKNOWN'
UNION ALL VALUES ('UNKNOWN|UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', NULL)"""
CTES["dim_lane"] = f"""
SELECT {LANE_KEY} AS lane_key, IFNULL(origin_warehouse_id, 'UNKNOWN') AS origin_warehouse_id,
  IFNULL(dest_state, 'UNKNOWN') AS destination_state, IFNULL(dest_city, 'UNKNOWN') AS destination_city,
  IFNULL(dest_postal, 'UNKNOWN') AS destination_postal, IFNULL(dest_country, 'UNKNOWN') AS destination_country
FROM stg_shipments WHERE final_live_shipment_flag GROUP BY ALL"""
CTES["dim_date"] = f"""
SELECT date_key, CASE WHEN z THEN 'Unknown' WHEN date_key < lo THEN 'Filler' ELSE 'Actual' END AS date_type,
  z AS unknown_date_flag, YEAR(date_key)::INTEGER AS year, QUARTER(date_key)::INTEGER AS quarter,
  MONTH(date_key)::INTEGER AS month_number, IF(z, 'Unknown', MONTHNAME(date_key)) AS month_name,
  IF(z, 'Unknown', LEFT(date_key::VARCHAR, 7)) AS year_month, WEEKOFYEAR(date_key)::INTEGER AS week_number,
  DAY(date_key)::INTEGER AS day_of_month, DAYOFWEEK(date_key)::INTEGER AS day_of_week_number,
  DAYNAME(date_key) AS day_name, DAYOFWEEK(date_key) % 6 = 0 AS weekend_flag
FROM (SELECT g.day::DATE AS date_key, lo, g.day = DATE '1900-01-01' AS z
      FROM (SELECT MIN(ship_create_date) AS lo,
              MAX(GREATEST(ship_create_date, promised_delivery_date, {DLV_DAY})) AS hi FROM stg_shipments),
        LATERAL (SELECT UNNEST(GENERATE_SERIES(DATE '1900-01-01', hi, INTERVAL 1 DAY)) AS day) g)"""

# --- fact -------------------------------------------------------------------

CTES["resolved"] = """
SELECT s.*, COALESCE(d.erp_customer_id, x.hit, 'UNKNOWN') AS resolved_customer_key,
  CASE WHEN d.erp_customer_id IS NOT NULL THEN 'ERP CUSTOMER ID' WHEN x.hit IS NOT NULL THEN 'CUSTOMER CROSSWALK'
       ELSE 'UNMATCHED' END AS customer_match_method,
  IFNULL(r.is_test_account, FALSE) AS resolved_test_account_flag
FROM stg_shipments s
LEFT JOIN stg_customers d ON d.erp_customer_id = s.erp_customer_id_ref
LEFT JOIN by_code x ON x.code = s.tms_customer_code_normalized
LEFT JOIN stg_customers r ON r.erp_customer_id = IFNULL(d.erp_customer_id, x.hit)"""

_ZERO = {
    "li": ["shipment_line_count"],
    "ev": ["tracking_event_count", "tracking_exception_count"],
    "wm": ["wms_record_count"],
    "iv": ["invoice_count", "customer_revenue_usd", "carrier_cost_usd", "total_accessorial_usd",
           "total_fuel_surcharge_usd", "disputed_invoice_count"],
    "cl": ["claim_count", "claims_requested_usd", "claims_paid_usd"],
    "ti": ["ticket_count", "severe_ticket_count", "late_delivery_ticket_count", "damage_ticket_count"],
    "su": ["survey_response_count", "valid_csat_response_count"],
}
_CHILDREN = {"li": "agg_lines", "ev": "agg_events", "wm": "agg_wms", "iv": "agg_invoices",
             "cl": "agg_claims", "ti": "agg_tickets", "su": "agg_surveys"}
_child_cols = ",\n  ".join(
    f"{a}.* EXCLUDE (tms_shipment_id) REPLACE ("
    + ", ".join(f"IFNULL({a}.{c}, 0) AS {c}" for c in _ZERO[a]) + ")"
    for a in _CHILDREN
)
_child_joins = "\n".join(
    f"LEFT JOIN {t} {a} ON {a}.tms_shipment_id = s.tms_shipment_id" for a, t in _CHILDREN.items()
)
_attrs = ", ".join(f"s.{c}" for c in (
    "sales_order_id customer_po bol_number pro_number tracking_number dest_city dest_state dest_postal"
    " dest_country mode service_level_code service_level_name shipment_status exception_code"
    " planned_transit_days lane_miles_est weight_lb pieces final_on_time_flag days_late"
    " official_kpi_eligible_flag"
).split())
CTES["fact_shipment"] = f"""
SELECT f.*, customer_revenue_usd - carrier_cost_usd - claims_paid_usd AS gross_margin_usd,
  (customer_revenue_usd - carrier_cost_usd - claims_paid_usd)::DOUBLE / NULLIF(customer_revenue_usd, 0)::DOUBLE
    AS gross_margin_percentage,
  IF(final_on_time_flag IS NULL OR shipment_fill_rate IS NULL, NULL,
     final_on_time_flag AND shipment_fill_rate >= 1) AS otif_flag,
  ticket_count > 0 AS complaint_flag, claim_count > 0 AS claim_flag
FROM (
SELECT s.tms_shipment_id AS shipment_key, s.tms_shipment_id, resolved_customer_key AS customer_key,
  IFNULL(carrier_id, 'UNKNOWN') AS carrier_key, IFNULL(origin_warehouse_id, 'UNKNOWN') AS warehouse_key,
  {SERVICE_KEY} AS service_key, {LANE_KEY} AS lane_key,
  ship_create_date AS ship_date, IFNULL(ship_create_date, DATE '1900-01-01') AS ship_date_key,
  promised_delivery_date, IFNULL(promised_delivery_date, DATE '1900-01-01') AS promised_delivery_date_key,
  {DLV_DAY} AS actual_delivery_date, IFNULL({DLV_DAY}, DATE '1900-01-01') AS actual_delivery_date_key,
  {_attrs},
  {_child_cols}
FROM resolved s
{_child_joins}
WHERE final_live_shipment_flag AND NOT resolved_test_account_flag) f"""

# --- scorecards -------------------------------------------------------------

O = "official_kpi_eligible_flag"


def rate(flag: str, cond: str | None = None) -> str:
    """True share among rows where the flag is known."""
    c = f"{cond} AND " if cond else ""
    return f"{n(c + flag)}::DOUBLE / NULLIF({n(f'{c}({flag}) IS NOT NULL')}, 0)"


def div(a: str, b: str) -> str:
    return f"({a})::DOUBLE / NULLIF(({b})::DOUBLE, 0)"


CSAT_OK = "valid_csat_response_count > 0 AND average_csat_score IS NOT NULL"
CSAT = div(
    f"SUM(IF({CSAT_OK}, average_csat_score * valid_csat_response_count, NULL))",
    f"SUM(IF({CSAT_OK}, valid_csat_response_count, NULL))",
)
_P, _A, _D = (f"SUM(IFNULL({c}_count, 0))" for c in ("promoter", "passive", "detractor"))
NPS = div(f"100 * ({_P} - {_D})", f"{_P} + {_A} + {_D}")

KPI = {
    "total_shipments": n(),
    "official_kpi_shipments": n(O),
    "otd_eligible_shipments": n(f"{O} AND final_on_time_flag IS NOT NULL"),
    "on_time_shipments": n(f"{O} AND final_on_time_flag"),
    "late_shipments": n(f"{O} AND NOT final_on_time_flag"),
    "on_time_delivery_rate": rate("final_on_time_flag", O),
    "otif_eligible_shipments": n(f"{O} AND otif_flag IS NOT NULL"),
    "otif_shipments": n(f"{O} AND otif_flag"),
    "otif_rate": rate("otif_flag", O),
    "average_fill_rate": f"AVG(IF({O}, shipment_fill_rate, NULL))",
    "full_fill_eligible_shipments": n(f"{O} AND shipment_fill_rate IS NOT NULL"),
    "full_fill_shipments": n(f"{O} AND shipment_fill_rate >= 1"),
    "full_fill_rate": rate("shipment_fill_rate >= 1", O),
    "average_days_late": f"AVG(IF({O} AND NOT final_on_time_flag, days_late, NULL))",
    "average_tracking_exceptions": "AVG(tracking_exception_count)",
    "average_warehouse_cycle_hours": "AVG(warehouse_cycle_hours)",
    "average_pick_to_pack_hours": "AVG(pick_to_pack_hours)",
    "average_pack_to_ship_hours": "AVG(pack_to_ship_hours)",
    "short_pick_rate": rate("short_pick_flag", "wms_record_count > 0"),
    "average_inventory_accuracy": "AVG(average_inventory_accuracy)",
    "average_lane_miles": "AVG(lane_miles_est)",
    "customer_revenue_usd": "SUM(customer_revenue_usd)",
    "carrier_cost_usd": "SUM(carrier_cost_usd)",
    "accessorial_cost_usd": "SUM(total_accessorial_usd)",
    "claims_paid_usd": "SUM(claims_paid_usd)",
    "gross_margin_usd": "SUM(gross_margin_usd)",
    "gross_margin_percentage": div("SUM(gross_margin_usd)", "SUM(customer_revenue_usd)"),
    "carrier_cost_per_shipment": div("SUM(carrier_cost_usd)", "COUNT(*)"),
    "shipments_with_complaints": n("complaint_flag"),
    "complaint_rate": rate("complaint_flag"),
    "shipments_with_claims": n("claim_flag"),
    "claim_rate": rate("claim_flag"),
    "average_csat_score": CSAT,
    "net_promoter_score": NPS,
}
_SERVICE = list(KPI)[:13]


def kpis(columns: str) -> str:
    listed = [*_SERVICE, *columns.split()]
    return ", ".join(f"{KPI[c]} AS {c}" for c in listed)


CTES["kpi_executive"] = "SELECT " + kpis(
    "average_days_late average_warehouse_cycle_hours customer_revenue_usd carrier_cost_usd accessorial_cost_usd"
    " claims_paid_usd gross_margin_usd gross_margin_percentage shipments_with_complaints complaint_rate"
    " shipments_with_claims claim_rate average_csat_score net_promoter_score"
) + " FROM fact_shipment"
CTES["kpi_monthly"] = "SELECT DATE_TRUNC('month', ship_date)::DATE AS month_start_date," \
    " STRFTIME(ship_date, '%Y-%m') AS year_month, " + kpis(
    "average_days_late average_warehouse_cycle_hours customer_revenue_usd carrier_cost_usd claims_paid_usd"
    " gross_margin_usd gross_margin_percentage complaint_rate claim_rate average_csat_score net_promoter_score"
) + " FROM fact_shipment GROUP BY ALL"
CTES["kpi_carrier"] = "SELECT carrier_key, ANY_VALUE(scac) AS scac, ANY_VALUE(carrier_legal_name) AS" \
    " carrier_legal_name, ANY_VALUE(primary_mode) AS primary_mode, ANY_VALUE(carrier_status) AS carrier_status, " + kpis(
    "average_days_late average_tracking_exceptions customer_revenue_usd carrier_cost_usd accessorial_cost_usd"
    " claims_paid_usd gross_margin_usd gross_margin_percentage carrier_cost_per_shipment complaint_rate claim_rate"
    " average_csat_score"
) + " FROM fact_shipment LEFT JOIN dim_carrier USING (carrier_key) GROUP BY carrier_key"
CTES["kpi_warehouse"] = "SELECT f.warehouse_key, w.warehouse_name, w.city, w.state, w.daily_outbound_capacity," \
    " w.is_active, " + kpis(
    "average_warehouse_cycle_hours average_pick_to_pack_hours average_pack_to_ship_hours short_pick_rate"
    " average_inventory_accuracy customer_revenue_usd carrier_cost_usd claims_paid_usd gross_margin_usd"
    " gross_margin_percentage complaint_rate claim_rate average_csat_score"
) + " FROM fact_shipment f LEFT JOIN dim_warehouse w ON w.warehouse_key = f.warehouse_key GROUP BY ALL"
CTES["kpi_customer"] = "SELECT f.customer_key, c.legal_name, c.dba_name, c.industry, c.customer_status," \
    " c.annual_volume_tier, c.primary_bill_to_state, " + kpis(
    "customer_revenue_usd carrier_cost_usd claims_paid_usd gross_margin_usd gross_margin_percentage"
    " shipments_with_complaints complaint_rate shipments_with_claims claim_rate average_csat_score net_promoter_score"
) + " FROM fact_shipment f LEFT JOIN dim_customer c ON c.customer_key = f.customer_key GROUP BY ALL"
CTES["kpi_lane"] = "SELECT f.lane_key, l.origin_warehouse_id, w.warehouse_name AS origin_warehouse_name," \
    " l.destination_city, l.destination_state, l.destination_postal, l.destination_country, " + kpis(
    "average_days_late average_lane_miles customer_revenue_usd carrier_cost_usd accessorial_cost_usd claims_paid_usd"
    " gross_margin_usd gross_margin_percentage carrier_cost_per_shipment complaint_rate claim_rate average_csat_score"
) + " FROM fact_shipment f LEFT JOIN dim_lane l ON l.lane_key = f.lane_key" \
    " LEFT JOIN dim_warehouse w ON w.warehouse_key = l.origin_warehouse_id GROUP BY ALL"

_WORD = re.compile(r"[a-z_][a-z0-9_]*")
HEAVY = {"ship_clean", "ship_dated", "stg_shipments", "fact_shipment"}
_MENTIONS = {k: set(_WORD.findall(v)) for k, v in CTES.items()}


def with_query(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` preceded by the CTEs it needs, directly or not."""
    ctes = {**CTES, **(extra or {})}
    needed: set[str] = set()
    todo = set(_WORD.findall(final)) & set(ctes)
    while todo:
        name = todo.pop()
        needed.add(name)
        words = _MENTIONS.get(name) or set(_WORD.findall(ctes[name]))
        todo |= (words & set(ctes)) - needed - {name}
    parts = [
        f"{k} AS {'MATERIALIZED ' if k in HEAVY else ''}({v})" for k, v in ctes.items() if k in needed
    ]
    return f"WITH {', '.join(parts)} {final}" if parts else final
