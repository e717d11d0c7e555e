"""The shipment fact: one row per live, non-test shipment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.contracts import BY_CROSSWALK, BY_CUSTOMER_ID, UNKNOWN
from haulgrain.functions.measures import ratio
from haulgrain.operators.dimensions import date_key, known, lane_key, service_key
from haulgrain.operators.matching import Rule, cascade_match, left_lookup
from haulgrain.operators.staging import crosswalk_lookup

SHIPMENT_ATTRIBUTES = (
    "sales_order_id customer_po bol_number pro_number tracking_number dest_city dest_state "
    "dest_postal dest_country mode service_level_code service_level_name shipment_status "
    "exception_code planned_transit_days lane_miles_est weight_lb pieces "
    "final_on_time_flag days_late official_kpi_eligible_flag"
).split()

# Child columns in contract order; a star marks those that read zero, not null, on a
# shipment without such a child.
CHILD_COLUMNS = {
    "lines": "shipment_line_count* total_quantity_ordered total_quantity_shipped "
             "missing_shipped_quantity_lines short_shipped_lines over_shipped_lines "
             "shipment_fill_rate calculated_line_weight_lb hazardous_shipment_flag",
    "events": "tracking_event_count* first_pickup_event_ts final_delivery_event_ts "
              "tracking_exception_count*",
    "wms": "wms_record_count* warehouse_cycle_hours pick_to_pack_hours pack_to_ship_hours "
           "short_pick_flag average_inventory_accuracy",
    "invoices": "invoice_count* customer_revenue_usd* carrier_cost_usd* total_accessorial_usd* "
                "total_fuel_surcharge_usd* disputed_invoice_count*",
    "claims": "claim_count* claims_requested_usd* claims_paid_usd*",
    "tickets": "ticket_count* severe_ticket_count* average_resolution_hours "
               "late_delivery_ticket_count* damage_ticket_count*",
    "surveys": "survey_response_count* valid_csat_response_count* average_csat_score "
               "promoter_count passive_count detractor_count shipment_nps",
}


def resolve_customers(
    ships: DataFrame, customers: DataFrame, crosswalk: DataFrame
) -> DataFrame:
    """Customer of each shipment: its own reference, else the crosswalk, else UNKNOWN.

    The test-account flag rides along in the lookups, so shipments need no third join.
    """
    accounts = (
        customers.where(F.col("erp_customer_id").isNotNull())
        .groupBy("erp_customer_id")
        .agg(F.bool_or("is_test_account").alias("is_test_account"))
    )
    code = "tms_customer_code_normalized"
    by_code = crosswalk_lookup(crosswalk).join(accounts, "erp_customer_id", "left")
    matched = cascade_match(
        ships,
        [
            Rule(BY_CUSTOMER_ID, "erp_customer_id_ref", accounts, "erp_customer_id", "erp_customer_id"),
            Rule(BY_CROSSWALK, code, by_code, code, "erp_customer_id"),
        ],
        "_customer", "customer_match_method", payload=["is_test_account"],
    )
    return matched.withColumns({
        "resolved_customer_key": F.coalesce("_customer", F.lit(UNKNOWN)),
        "resolved_test_account_flag": F.coalesce("is_test_account", F.lit(False)),
    }).drop("_customer", "is_test_account")


def otif(on_time: Column, fill: Column) -> Column:
    """On time in full; unknown when either part is unknown."""
    return F.when(on_time.isNotNull() & fill.isNotNull(), on_time & (fill >= 1))


def margin() -> Column:
    return F.col("customer_revenue_usd") - F.col("carrier_cost_usd") - F.col("claims_paid_usd")


def child_bundle(ids: DataFrame, children: dict[str, DataFrame]) -> DataFrame:
    """All child measures of each shipment id.

    The ids are unique and every child arrives from its own aggregate partitioned by id, so
    the seven joins shuffle the ids once and move only narrow rows.
    """
    for name in CHILD_COLUMNS:
        child = children[name].where("tms_shipment_id IS NOT NULL")
        ids = ids.join(child, "tms_shipment_id", "left")
    return ids


def fact_shipment(
    resolved: DataFrame, ids: DataFrame, children: dict[str, DataFrame]
) -> DataFrame:
    """One lookup of the child bundle per shipment; ``ids`` are the live shipment ids.

    Shipments without an id, or many copies of one id, are spread or split by the lookup
    instead of piling up in the task of one id.
    """
    ship_day, promised = F.col("ship_create_date"), F.col("promised_delivery_date")
    delivered = F.col("_delivered")
    # Keys and labels made of other columns are made after the lookup, so its shuffle does not carry them.
    df = resolved.where(
        F.col("final_live_shipment_flag") & ~F.col("resolved_test_account_flag")
    ).select(
        "tms_shipment_id", "resolved_customer_key", "carrier_id", "origin_warehouse_id",
        ship_day, promised, F.col("actual_delivery_ts").cast("date").alias("_delivered"),
        *SHIPMENT_ATTRIBUTES,
    )
    columns = [c.rstrip("*") for listed in CHILD_COLUMNS.values() for c in listed.split()]
    df = left_lookup(
        # A merge leaves the rows in the order of their ids, in which the fact is written.
        df, "tms_shipment_id", child_bundle(ids, children), "tms_shipment_id", strategy="merge",
        **{c: c for c in columns},
    )
    measures = [
        F.expr(f"coalesce({c[:-1]}, 0) AS {c[:-1]}" if c.endswith("*") else c)
        for listed in CHILD_COLUMNS.values() for c in listed.split()
    ]
    df = df.select(
        F.col("tms_shipment_id").alias("shipment_key"),
        "tms_shipment_id",
        F.col("resolved_customer_key").alias("customer_key"),
        known("carrier_id").alias("carrier_key"),
        known("origin_warehouse_id").alias("warehouse_key"),
        service_key().alias("service_key"),
        lane_key().alias("lane_key"),
        ship_day.alias("ship_date"),
        date_key(ship_day).alias("ship_date_key"),
        promised,
        date_key(promised).alias("promised_delivery_date_key"),
        delivered.alias("actual_delivery_date"),
        date_key(delivered).alias("actual_delivery_date_key"),
        *SHIPMENT_ATTRIBUTES,
        *measures,
    )
    return df.withColumns({
        "gross_margin_usd": margin(),
        "gross_margin_percentage": ratio(margin(), F.col("customer_revenue_usd")),
        "otif_flag": otif(F.col("final_on_time_flag"), F.col("shipment_fill_rate")),
        "complaint_flag": F.col("ticket_count") > 0,
        "claim_flag": F.col("claim_count") > 0,
    })
