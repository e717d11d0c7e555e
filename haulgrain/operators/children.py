"""Child tables reduced to one row per shipment before anything is joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain import contracts as C
from haulgrain.functions.measures import count_where, mean_where, ratio, sum_where


def _rows() -> Column:
    return F.count(F.lit(1))


def _per_shipment(df: DataFrame, key: str, **aggs: Column) -> DataFrame:
    return df.groupBy(F.col(key).alias("tms_shipment_id")).agg(
        *[c.alias(name) for name, c in aggs.items()]
    )


def line_totals(lines: DataFrame) -> DataFrame:
    ordered, shipped = F.sum("qty_ordered"), F.sum("qty_shipped")
    missing = count_where(F.col("qty_shipped").isNull())
    return _per_shipment(
        lines,
        "tms_shipment_id",
        shipment_line_count=_rows(),
        total_quantity_ordered=ordered,
        total_quantity_shipped=shipped,
        missing_shipped_quantity_lines=missing,
        short_shipped_lines=count_where(F.col("quantity_status") == "SHORT SHIPPED"),
        over_shipped_lines=count_where(F.col("quantity_status") == "OVER SHIPPED"),
        calculated_line_weight_lb=F.sum("calculated_line_weight_lb"),
        hazardous_shipment_flag=F.bool_or("hazardous_flag"),
        # One unknown line makes the whole shipment's fill unknown.
        shipment_fill_rate=F.when((missing == 0) & (ordered > 0), ratio(shipped, ordered)),
    )


def event_totals(kept: DataFrame) -> DataFrame:
    code, local = F.col("event_code"), F.col("event_ts_local")
    return _per_shipment(
        kept,
        "tms_shipment_id",
        tracking_event_count=_rows(),
        first_pickup_event_ts=F.min(F.when(code == "PU", local)),
        final_delivery_event_ts=F.max(F.when(code == "DLV", local)),
        tracking_exception_count=count_where(
            F.col("exception_reason").isNotNull() | code.isin(C.EXCEPTION_EVENT_CODES)
        ),
    )


def wms_totals(wms: DataFrame) -> DataFrame:
    return _per_shipment(
        wms.where("shipment_match_flag"),
        "matched_tms_shipment_id",
        wms_record_count=_rows(),
        warehouse_cycle_hours=F.max("total_warehouse_cycle_hours"),
        pick_to_pack_hours=F.max("pick_to_pack_hours"),
        pack_to_ship_hours=F.max("pack_to_ship_hours"),
        short_pick_flag=F.bool_or("short_pick_flag"),
        average_inventory_accuracy=F.avg("inventory_accuracy_snapshot"),
    )


def invoice_totals(invoices: DataFrame) -> DataFrame:
    bill = F.col("invoice_type") == "CARRIER_BILL"
    return _per_shipment(
        invoices.where("shipment_match_flag"),
        "matched_tms_shipment_id",
        invoice_count=_rows(),
        customer_revenue_usd=F.sum("customer_revenue_usd"),
        carrier_cost_usd=F.sum("carrier_cost_usd"),
        # Customer accessorials are part of revenue already; only bills are cost.
        total_accessorial_usd=sum_where(F.col("accessorial_amount_usd"), bill),
        total_fuel_surcharge_usd=sum_where(F.col("fuel_surcharge_usd"), bill),
        disputed_invoice_count=count_where(F.col("dispute_flag")),
    )


def claim_totals(claims: DataFrame) -> DataFrame:
    paid = F.coalesce(F.col("claim_amount_paid_usd"), F.lit(0).cast("decimal(18,2)"))
    return _per_shipment(
        claims.where("shipment_match_flag"),
        "matched_tms_shipment_id",
        claim_count=_rows(),
        claims_requested_usd=F.sum("claim_amount_requested_usd"),
        claims_paid_usd=F.sum(paid),
    )


def ticket_totals(tickets: DataFrame) -> DataFrame:
    category = F.col("category_normalized")
    return _per_shipment(
        tickets.where("shipment_match_flag"),
        "matched_tms_shipment_id",
        ticket_count=_rows(),
        severe_ticket_count=count_where(F.col("severity").isin(C.SEVERE_LEVELS)),
        average_resolution_hours=mean_where(
            F.col("resolution_hours"), F.col("valid_resolution_time_flag")
        ),
        late_delivery_ticket_count=count_where(category == "LATE DELIVERY"),
        damage_ticket_count=count_where(category == "DAMAGE"),
    )


def survey_totals(surveys: DataFrame) -> DataFrame:
    """Survey counts per shipment; rows whose shipment is unknown drop out in the fact join."""
    def category(name: str) -> Column:
        return count_where(F.col("nps_category") == name)

    return _per_shipment(
        surveys,
        "tms_shipment_id",
        survey_response_count=_rows(),
        valid_csat_response_count=count_where(F.col("valid_csat_flag")),
        average_csat_score=mean_where(F.col("csat_score"), F.col("valid_csat_flag")),
        promoter_count=category("PROMOTER"),
        passive_count=category("PASSIVE"),
        detractor_count=category("DETRACTOR"),
        shipment_nps=ratio(
            F.lit(100) * (category("PROMOTER") - category("DETRACTOR")),
            count_where(F.col("valid_nps_flag")),
        ),
    )
