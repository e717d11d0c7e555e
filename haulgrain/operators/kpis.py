"""KPI definitions, each written once, and the six scorecards made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.functions.measures import month_start, year_month

_OFFICIAL = "official_kpi_eligible_flag"
_CSAT = "valid_csat_response_count > 0 AND average_csat_score IS NOT NULL"
_NPS = [f"sum(coalesce({c}_count, 0))" for c in ("promoter", "passive", "detractor")]


def _mean(value: str, where: str) -> str:
    return f"avg(CASE WHEN {where} THEN {value} END)"


def _share(flag: str, where: str = "true") -> str:
    """Share of true among rows whose flag is known."""
    return _mean(f"int({flag})", where)


def _ratio(a: str, b: str) -> str:
    return f"try_divide(double({a}), double({b}))"


# Every KPI as an aggregate over the fact; each rate has its own denominator.
KPI: dict[str, str] = {
    "total_shipments": "count(1)",
    "official_kpi_shipments": f"count_if({_OFFICIAL})",
    "otd_eligible_shipments": f"count_if({_OFFICIAL} AND final_on_time_flag IS NOT NULL)",
    "on_time_shipments": f"count_if({_OFFICIAL} AND final_on_time_flag)",
    "late_shipments": f"count_if({_OFFICIAL} AND NOT final_on_time_flag)",
    "on_time_delivery_rate": _share("final_on_time_flag", _OFFICIAL),
    "otif_eligible_shipments": f"count_if({_OFFICIAL} AND otif_flag IS NOT NULL)",
    "otif_shipments": f"count_if({_OFFICIAL} AND otif_flag)",
    "otif_rate": _share("otif_flag", _OFFICIAL),
    "average_fill_rate": _mean("shipment_fill_rate", _OFFICIAL),
    "full_fill_eligible_shipments": f"count_if({_OFFICIAL} AND shipment_fill_rate IS NOT NULL)",
    "full_fill_shipments": f"count_if({_OFFICIAL} AND shipment_fill_rate >= 1)",
    "full_fill_rate": _share("shipment_fill_rate >= 1", _OFFICIAL),
    "average_days_late": _mean("days_late", f"{_OFFICIAL} AND NOT final_on_time_flag"),
    "average_tracking_exceptions": "avg(tracking_exception_count)",
    "average_warehouse_cycle_hours": "avg(warehouse_cycle_hours)",
    "average_pick_to_pack_hours": "avg(pick_to_pack_hours)",
    "average_pack_to_ship_hours": "avg(pack_to_ship_hours)",
    "short_pick_rate": _share("short_pick_flag", "wms_record_count > 0"),
    "average_inventory_accuracy": "avg(average_inventory_accuracy)",
    "average_lane_miles": "avg(lane_miles_est)",
    "customer_revenue_usd": "sum(customer_revenue_usd)",
    "carrier_cost_usd": "sum(carrier_cost_usd)",
    "accessorial_cost_usd": "sum(total_accessorial_usd)",
    "claims_paid_usd": "sum(claims_paid_usd)",
    "gross_margin_usd": "sum(gross_margin_usd)",
    "gross_margin_percentage": _ratio("sum(gross_margin_usd)", "sum(customer_revenue_usd)"),
    "carrier_cost_per_shipment": _ratio("sum(carrier_cost_usd)", "count(1)"),
    "shipments_with_complaints": "count_if(complaint_flag)",
    "complaint_rate": _share("complaint_flag"),
    "shipments_with_claims": "count_if(claim_flag)",
    "claim_rate": _share("claim_flag"),
    "average_csat_score": _ratio(
        f"sum(CASE WHEN {_CSAT} THEN average_csat_score * valid_csat_response_count END)",
        f"sum(CASE WHEN {_CSAT} THEN valid_csat_response_count END)",
    ),
    "net_promoter_score": _ratio(
        f"100 * ({_NPS[0]} - {_NPS[2]})", f"{_NPS[0]} + {_NPS[1]} + {_NPS[2]}"
    ),
}


def definitions() -> dict[str, Column]:
    return {name: F.expr(sql) for name, sql in KPI.items()}


SERVICE = (
    "total_shipments official_kpi_shipments otd_eligible_shipments on_time_shipments "
    "late_shipments on_time_delivery_rate otif_eligible_shipments otif_shipments otif_rate "
    "average_fill_rate full_fill_eligible_shipments full_fill_shipments full_fill_rate"
).split()
MONEY = "customer_revenue_usd carrier_cost_usd claims_paid_usd".split()
MONEY_X = "customer_revenue_usd carrier_cost_usd accessorial_cost_usd claims_paid_usd".split()
MARGINS = "gross_margin_usd gross_margin_percentage".split()

# view -> (KPI columns, fact key, [(dimension, its key, {output: dimension column})])
SCORECARDS = {
    "vw_carrier_scorecard": (
        [*SERVICE, "average_days_late", "average_tracking_exceptions", *MONEY_X, *MARGINS,
         "carrier_cost_per_shipment", "complaint_rate", "claim_rate", "average_csat_score"],
        "carrier_key",
        "dim_carrier",
        "scac carrier_legal_name primary_mode carrier_status".split(),
    ),
    "vw_warehouse_scorecard": (
        [*SERVICE, "average_warehouse_cycle_hours", "average_pick_to_pack_hours",
         "average_pack_to_ship_hours", "short_pick_rate", "average_inventory_accuracy",
         *MONEY, *MARGINS, "complaint_rate", "claim_rate", "average_csat_score"],
        "warehouse_key",
        "dim_warehouse",
        "warehouse_name city state daily_outbound_capacity is_active".split(),
    ),
    "vw_customer_scorecard": (
        [*SERVICE, *MONEY, *MARGINS, "shipments_with_complaints", "complaint_rate",
         "shipments_with_claims", "claim_rate", "average_csat_score", "net_promoter_score"],
        "customer_key",
        "dim_customer",
        "legal_name dba_name industry customer_status annual_volume_tier "
        "primary_bill_to_state".split(),
    ),
    "vw_lane_scorecard": (
        [*SERVICE, "average_days_late", "average_lane_miles", *MONEY_X, *MARGINS,
         "carrier_cost_per_shipment", "complaint_rate", "claim_rate", "average_csat_score"],
        "lane_key",
        "dim_lane",
        "origin_warehouse_id destination_city destination_state destination_postal "
        "destination_country".split(),
    ),
}

EXECUTIVE = [
    *SERVICE, "average_days_late", "average_warehouse_cycle_hours", *MONEY_X, *MARGINS,
    "shipments_with_complaints", "complaint_rate", "shipments_with_claims", "claim_rate",
    "average_csat_score", "net_promoter_score",
]
MONTHLY = [
    *SERVICE, "average_days_late", "average_warehouse_cycle_hours", *MONEY, *MARGINS,
    "complaint_rate", "claim_rate", "average_csat_score", "net_promoter_score",
]


def kpi_columns(names) -> list[Column]:
    return [F.expr(f"{KPI[n]} AS {n}") for n in names]


def executive(fact: DataFrame) -> DataFrame:
    """Always exactly one row."""
    return fact.agg(*kpi_columns(EXECUTIVE))


def monthly(fact: DataFrame) -> DataFrame:
    """One row per ship month; undated shipments form a null month."""
    grouped = fact.groupBy(month_start(F.col("ship_date")).alias("month_start_date")).agg(
        *kpi_columns(MONTHLY)
    )
    return grouped.select(
        "month_start_date", year_month(F.col("month_start_date")).alias("year_month"), *MONTHLY
    )


def card_labels(name: str, tables) -> DataFrame:
    """The key and labels that a scorecard shows, a row for each key of its dimension."""
    _, key, dim_name, labels = SCORECARDS[name]
    dim = tables[dim_name].groupBy(key).agg(F.min(F.struct(*labels)).alias("_labels")).select(
        key, *[F.col("_labels")[c].alias(c) for c in labels]
    )
    if name != "vw_lane_scorecard":
        return dim
    origin = tables["dim_warehouse"].select(
        F.col("warehouse_key").alias("origin_warehouse_id"),
        F.col("warehouse_name").alias("origin_warehouse_name"),
    )
    return dim.join(origin, "origin_warehouse_id", "left").select(
        key, labels[0], "origin_warehouse_name", *labels[1:]
    )


def scorecard(name: str, tables) -> DataFrame:
    """Aggregate by the fact's key first, then label the few result rows."""
    names, key, _, _ = SCORECARDS[name]
    grouped = tables["fact_shipment"].groupBy(key).agg(*kpi_columns(names))
    labels = card_labels(name, tables)
    return grouped.join(labels, key, "left").select(*labels.columns, *names)


def view(name: str, tables) -> DataFrame:
    if name == "vw_executive_kpis":
        return executive(tables["fact_shipment"])
    if name == "vw_monthly_performance":
        return monthly(tables["fact_shipment"])
    return scorecard(name, tables)
