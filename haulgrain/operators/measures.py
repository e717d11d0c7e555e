"""Slice-aware measures: one conditional aggregate per base measure, then arithmetic.

A slice has ordinary filters and an optional date range. Most measures see both; the data
quality measures ignore the date range, and the date-role measures apply it to another date
column. All of them come out of one pass over the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.contracts import KPI_TARGETS, UNKNOWN
from haulgrain.functions.measures import month_start, ratio
from haulgrain.operators.kpis import KPI

ROLES = {
    "ship": "ship_date",
    "promised": "promised_delivery_date",
    "actual": "actual_delivery_date",
}


@dataclass(frozen=True)
class Slice:
    """``keep`` maps a column to its allowed values (empty means all)."""

    keep: dict[str, Sequence] = field(default_factory=dict)
    start: date | str | None = None
    end: date | str | None = None

    @property
    def dated(self) -> bool:
        return self.start is not None or self.end is not None

    def in_range(self, column: str) -> str:
        """SQL: is the date inside the range? Undated rows are outside any range."""
        parts = [f"{column} IS NOT NULL"]
        if self.start is not None:
            parts.append(f"{column} >= DATE'{self.start}'")
        if self.end is not None:
            parts.append(f"{column} <= DATE'{self.end}'")
        return " AND ".join(parts)


def apply_filters(fact: DataFrame, s: Slice) -> DataFrame:
    for column, values in s.keep.items():
        if values:
            fact = fact.where(F.col(column).isin(list(values)))
    return fact


def apply_slice(fact: DataFrame, s: Slice, role: str = "ship") -> DataFrame:
    """Rows in the slice; simple comparisons, so they reach the Parquet scan."""
    fact = apply_filters(fact, s)
    return fact.where(s.in_range(ROLES[role])) if s.dated else fact


@dataclass(frozen=True)
class Base:
    """An aggregate of ``value`` (SQL; None counts rows) where ``when`` (SQL) holds.

    ``role`` names the date column a date range applies to; None ignores the range.
    """

    how: str
    value: str | None = None
    when: str | None = None
    role: str | None = "ship"


def _count(when: str | None = None, role: str | None = "ship") -> Base:
    return Base("count", None, when, role)


_OFFICIAL = "official_kpi_eligible_flag"
_WMS = "wms_record_count > 0"
_CSAT = "valid_csat_response_count > 0 AND average_csat_score IS NOT NULL"

BASES: dict[str, Base] = {
    "total_shipments": _count(),
    "official_kpi_shipments": _count(_OFFICIAL),
    "shipment_lines": Base("sum", "shipment_line_count"),
    "quantity_ordered": Base("sum", "total_quantity_ordered"),
    "quantity_shipped": Base("sum", "total_quantity_shipped"),
    "delivered_shipments": _count("actual_delivery_date IS NOT NULL", "actual"),
    "promised_shipments": _count("promised_delivery_date IS NOT NULL", "promised"),
    "otd_eligible_shipments": _count(f"{_OFFICIAL} AND final_on_time_flag IS NOT NULL"),
    "on_time_shipments": _count(f"{_OFFICIAL} AND final_on_time_flag"),
    "late_shipments": _count(f"{_OFFICIAL} AND NOT final_on_time_flag"),
    "otif_eligible_shipments": _count(f"{_OFFICIAL} AND otif_flag IS NOT NULL"),
    "otif_shipments": _count(f"{_OFFICIAL} AND otif_flag"),
    "average_fill_rate": Base("avg", "shipment_fill_rate", _OFFICIAL),
    "full_fill_eligible_shipments": _count(f"{_OFFICIAL} AND shipment_fill_rate IS NOT NULL"),
    "full_fill_shipments": _count(f"{_OFFICIAL} AND shipment_fill_rate >= 1"),
    "average_days_late": Base("avg", "days_late", f"{_OFFICIAL} AND NOT final_on_time_flag"),
    "tracking_exceptions": Base("sum", "tracking_exception_count"),
    "average_warehouse_cycle_hours": Base("avg", "warehouse_cycle_hours"),
    "average_pick_to_pack_hours": Base("avg", "pick_to_pack_hours"),
    "average_pack_to_ship_hours": Base("avg", "pack_to_ship_hours"),
    "wms_matched_shipments": _count(_WMS),
    "short_pick_shipments": _count(f"{_WMS} AND short_pick_flag"),
    "short_pick_eligible_shipments": _count(f"{_WMS} AND short_pick_flag IS NOT NULL"),
    "average_inventory_accuracy": Base("avg", "average_inventory_accuracy"),
    "customer_revenue": Base("sum", "customer_revenue_usd"),
    "carrier_cost": Base("sum", "carrier_cost_usd"),
    "accessorial_cost": Base("sum", "total_accessorial_usd"),
    "fuel_surcharge": Base("sum", "total_fuel_surcharge_usd"),
    "claims_paid": Base("sum", "claims_paid_usd"),
    "gross_margin": Base("sum", "gross_margin_usd"),
    "invoice_matched_shipments": _count("invoice_count > 0"),
    "claim_count": Base("sum", "claim_count"),
    "shipments_with_claims": _count("claim_flag"),
    "complaint_tickets": Base("sum", "ticket_count"),
    "shipments_with_complaints": _count("complaint_flag"),
    "severe_tickets": Base("sum", "severe_ticket_count"),
    "average_resolution_hours": Base("avg", "average_resolution_hours"),
    "surveyed_shipments": _count("survey_response_count > 0"),
    "_csat_points": Base("sum", "average_csat_score * valid_csat_response_count", _CSAT),
    "_csat_responses": Base("sum", "valid_csat_response_count", _CSAT),
    "promoters": Base("sum", "promoter_count"),
    "passives": Base("sum", "passive_count"),
    "detractors": Base("sum", "detractor_count"),
    "shipments_with_known_ship_date": _count("ship_date IS NOT NULL", None),
    "shipments_missing_ship_date": _count("ship_date IS NULL", None),
    "revenue_with_known_ship_date": Base(
        "sum", "customer_revenue_usd", "ship_date IS NOT NULL", None
    ),
    "revenue_missing_ship_date": Base("sum", "customer_revenue_usd", "ship_date IS NULL", None),
    "matched_customer_shipments": _count(f"customer_key <> '{UNKNOWN}'"),
    "matched_carrier_shipments": _count(f"carrier_key <> '{UNKNOWN}'"),
    "matched_warehouse_shipments": _count(f"warehouse_key <> '{UNKNOWN}'"),
    "data_through_date": Base("max", "ship_date", role=None),
}

# derived -> (numerator, denominator, factor)
RATIOS: dict[str, tuple[str, str, int]] = {
    "on_time_delivery_pct": ("on_time_shipments", "otd_eligible_shipments", 1),
    "otif_pct": ("otif_shipments", "otif_eligible_shipments", 1),
    "full_fill_rate": ("full_fill_shipments", "full_fill_eligible_shipments", 1),
    "fill_rate_coverage_pct": ("full_fill_eligible_shipments", "official_kpi_shipments", 1),
    "tracking_exceptions_per_shipment": ("tracking_exceptions", "total_shipments", 1),
    "wms_match_rate": ("wms_matched_shipments", "total_shipments", 1),
    "short_pick_rate": ("short_pick_shipments", "short_pick_eligible_shipments", 1),
    "gross_margin_pct": ("gross_margin", "customer_revenue", 1),
    "revenue_per_shipment": ("customer_revenue", "total_shipments", 1),
    "carrier_cost_per_shipment": ("carrier_cost", "total_shipments", 1),
    "margin_per_shipment": ("gross_margin", "total_shipments", 1),
    "accessorial_cost_pct": ("accessorial_cost", "carrier_cost", 1),
    "invoice_match_rate": ("invoice_matched_shipments", "total_shipments", 1),
    "claim_rate": ("shipments_with_claims", "total_shipments", 1),
    "claims_paid_per_shipment": ("claims_paid", "total_shipments", 1),
    "complaint_rate": ("shipments_with_complaints", "total_shipments", 1),
    "complaints_per_1000": ("complaint_tickets", "total_shipments", 1000),
    "survey_response_coverage_pct": ("surveyed_shipments", "total_shipments", 1),
    "average_csat": ("_csat_points", "_csat_responses", 1),
    "customer_match_rate": ("matched_customer_shipments", "total_shipments", 1),
    "carrier_match_rate": ("matched_carrier_shipments", "total_shipments", 1),
    "warehouse_match_rate": ("matched_warehouse_shipments", "total_shipments", 1),
}

_NPS_N = "coalesce(promoters, 0) + coalesce(passives, 0) + coalesce(detractors, 0)"

# derived -> (bases it needs, SQL over their columns)
FORMULAS: dict[str, tuple[list[str], str]] = {
    "nps_responses": (["promoters", "passives", "detractors"], _NPS_N),
    "net_promoter_score": (
        ["promoters", "passives", "detractors"],
        "try_divide(double(100 * (coalesce(promoters, 0) - coalesce(detractors, 0))),"
        f" double({_NPS_N}))",
    ),
    "ship_date_coverage_pct": (
        ["shipments_with_known_ship_date", "shipments_missing_ship_date"],
        "try_divide(double(shipments_with_known_ship_date),"
        " double(shipments_with_known_ship_date + shipments_missing_ship_date))",
    ),
}

GROUPS: dict[str, list[str]] = {
    "volume": (
        "total_shipments official_kpi_shipments shipment_lines quantity_ordered "
        "quantity_shipped delivered_shipments promised_shipments"
    ).split(),
    "service": (
        "otd_eligible_shipments on_time_shipments late_shipments on_time_delivery_pct "
        "otif_eligible_shipments otif_shipments otif_pct average_fill_rate "
        "full_fill_eligible_shipments full_fill_shipments full_fill_rate "
        "fill_rate_coverage_pct average_days_late tracking_exceptions "
        "tracking_exceptions_per_shipment"
    ).split(),
    "warehouse": (
        "average_warehouse_cycle_hours average_pick_to_pack_hours average_pack_to_ship_hours "
        "wms_matched_shipments wms_match_rate short_pick_shipments "
        "short_pick_eligible_shipments short_pick_rate average_inventory_accuracy"
    ).split(),
    "financial": (
        "customer_revenue carrier_cost accessorial_cost fuel_surcharge claims_paid "
        "gross_margin gross_margin_pct revenue_per_shipment carrier_cost_per_shipment "
        "margin_per_shipment accessorial_cost_pct invoice_matched_shipments invoice_match_rate"
    ).split(),
    "customer": (
        "claim_count shipments_with_claims claim_rate claims_paid_per_shipment "
        "complaint_tickets shipments_with_complaints complaint_rate complaints_per_1000 "
        "severe_tickets average_resolution_hours surveyed_shipments "
        "survey_response_coverage_pct average_csat promoters passives detractors "
        "nps_responses net_promoter_score"
    ).split(),
    "data_quality": (
        "shipments_with_known_ship_date shipments_missing_ship_date ship_date_coverage_pct "
        "revenue_with_known_ship_date revenue_missing_ship_date matched_customer_shipments "
        "customer_match_rate matched_carrier_shipments carrier_match_rate "
        "matched_warehouse_shipments warehouse_match_rate"
    ).split(),
    "data_through": ["data_through_date"],
}


def _parts(name: str) -> list[str]:
    if name in BASES:
        return [name]
    if name in RATIOS:
        return list(RATIOS[name][:2])
    if name in FORMULAS:
        return FORMULAS[name][0]
    raise KeyError(f"no measure named {name}")


def _aggregate(base: Base, s: Slice, pushed: bool) -> str:
    conds = [base.when] if base.when else []
    if s.dated and base.role and not pushed:
        conds.append(s.in_range(ROLES[base.role]))
    where = " AND ".join(f"({c})" for c in conds)
    if base.how == "count":
        return f"count_if({where})" if where else "count(1)"
    value = f"CASE WHEN {where} THEN {base.value} END" if where else base.value
    return f"{base.how}({value})"


def _derive(name: str) -> str:
    if name in RATIOS:
        a, b, factor = RATIOS[name]
        top = a if factor == 1 else f"{factor} * {a}"
        return f"try_divide(double({top}), double({b}))"
    if name in FORMULAS:
        return FORMULAS[name][1]
    return name


def evaluate(
    fact: DataFrame, names: Sequence[str], by: Sequence[str | Column] = (), s: Slice = Slice()
) -> DataFrame:
    """Measures of a sliced fact, per group or overall, in one aggregation.

    If every measure asked for respects the ship-date range, the range becomes a filter on
    the scan; otherwise it turns into conditions inside the aggregates.
    """
    bases = list(dict.fromkeys(p for n in names for p in _parts(n)))
    pushed = s.dated and all(BASES[b].role == "ship" for b in bases)
    df = apply_slice(fact, s) if pushed else apply_filters(fact, s)
    out = df.groupBy(*by).agg(
        *[F.expr(f"{_aggregate(BASES[b], s, pushed)} AS {b}") for b in bases]
    )
    labels = out.columns[: len(by)]
    return out.selectExpr(*labels, *[f"{_derive(n)} AS {n}" for n in names])


def shipments_by_role(fact: DataFrame) -> DataFrame:
    """Monthly shipment counts on each of the three date roles, from one scan."""
    pairs = F.array(
        *[F.struct(F.lit(r).alias("date_role"), F.col(c).alias("day")) for r, c in ROLES.items()]
    )
    return (
        fact.select(F.inline(pairs))
        .where(F.col("day").isNotNull())
        .groupBy("date_role", month_start(F.col("day")).alias("month_start_date"))
        .agg(F.count(F.lit(1)).alias("shipments"))
    )


def previous_month(fact: DataFrame, by: Sequence[str] = (), slice_: Slice | None = None) -> DataFrame:
    """Monthly volume, service and margin beside the month before, for each group of ``by``.

    A slice narrows both months by its columns; its dates pick the months shown, not those before.

    Joined on the shifted month, not lagged: a month missing from the data gives null. The
    join is between monthly totals, so its size is the number of months.
    """
    if slice_:
        fact = apply_filters(fact, slice_)
    names = ["total_shipments", "on_time_delivery_pct", "gross_margin"]
    now = evaluate(
        fact.where(F.col("ship_date").isNotNull()), names,
        [*by, month_start(F.col("ship_date")).alias("month_start_date")],
    )
    before = now.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.add_months("month_start_date", 1).alias("_month"),
        F.col("total_shipments").alias("shipments_previous_month"),
        F.col("on_time_delivery_pct").alias("otd_pct_previous_month"),
        F.col("gross_margin").alias("gross_margin_previous_month"),
    )

    def change(a: str, b: str) -> Column:
        return ratio(F.col(a) - F.col(b), F.col(b))

    same = F.col("month_start_date") == F.col("_month")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = now.join(before, same, "left")
    if slice_ and slice_.start:
        out = out.where(F.col("month_start_date") >= month_start(F.lit(slice_.start).cast("date")))
    if slice_ and slice_.end:
        out = out.where(F.col("month_start_date") <= F.lit(slice_.end).cast("date"))
    return out.select(
        *by, "month_start_date",
        "total_shipments",
        "shipments_previous_month",
        change("total_shipments", "shipments_previous_month").alias("shipment_change_pct"),
        "on_time_delivery_pct",
        "otd_pct_previous_month",
        (100 * (F.col("on_time_delivery_pct") - F.col("otd_pct_previous_month"))).alias("otd_change_pp"),
        "gross_margin",
        "gross_margin_previous_month",
        change("gross_margin", "gross_margin_previous_month").alias("gross_margin_change_pct"),
    )


def kpi_targets(spark) -> DataFrame:
    return spark.createDataFrame(
        KPI_TARGETS, "kpi_name string, target_value double, warning_tolerance double, direction string"
    )


TARGETED = {
    "On-Time Delivery %": "on_time_delivery_rate",
    "OTIF %": "otif_rate",
    "Average Fill Rate": "average_fill_rate",
    "Gross Margin %": "gross_margin_percentage",
    "Claim Rate": "claim_rate",
    "Complaint Rate": "complaint_rate",
    "Average CSAT": "average_csat_score",
    "Net Promoter Score": "net_promoter_score",
}


# Shares, whose variance is in percentage points.
RATES = [n for n in TARGETED if n not in ("Average CSAT", "Net Promoter Score")]


def target_status(fact: DataFrame, by: Sequence[str] = (), slice_: Slice | None = None) -> DataFrame:
    """Each targeted KPI against its target: On target, Watch, Off target or No data.

    For the whole fact or each group of ``by``, over a slice if one is given. The variance of shares is in
    percentage points.
    """
    fact = apply_slice(fact, slice_) if slice_ else fact
    rows = ", ".join(f"struct('{n}' AS kpi_name, double({KPI[c]}) AS actual)" for n, c in TARGETED.items())
    groups = [f"`{c}`" for c in by]
    actuals = fact.groupBy(*by).agg(F.expr(f"array({rows}) AS rows")).selectExpr(*groups, "inline(rows)")
    actual, target, slack = (F.col(c) for c in ("actual", "target_value", "warning_tolerance"))
    higher = F.col("direction") == "Higher"
    status = (
        F.when(actual.isNull(), "No data")
        .when(F.when(higher, actual >= target).otherwise(actual <= target), "On target")
        .when(
            F.when(higher, actual >= target - slack).otherwise(actual <= target + slack), "Watch"
        )
        .otherwise("Off target")
    )
    # Eight rows on each side.
    return actuals.join(F.broadcast(kpi_targets(fact.sparkSession)), "kpi_name").select(
        *by, "kpi_name", "actual", "target_value", "warning_tolerance", "direction",
        (F.when(F.col("kpi_name").isin(*RATES), 100.0).otherwise(1.0) * (actual - target)).alias("variance"),
        status.alias("status"),
    )
