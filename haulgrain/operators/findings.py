"""Ranked findings, decision numbers and report tables over the fact and its scorecards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulgrain import contracts as C
from haulgrain.functions.measures import (
    count_where,
    is_false,
    is_true,
    month_start,
    rate_where,
    ratio,
    weighted_csat,
)
from haulgrain.operators.kpis import EXECUTIVE, definitions
from haulgrain.operators.matching import merge_one_to_one
from haulgrain.operators.segments import label, lane_text, summary_by_label, summary_by_lane


def ranked(df: DataFrame, order: Sequence[Column], top: int, rank: str) -> DataFrame:
    """The first ``top`` rows, numbered. Only those rows reach the numbering step."""
    best = df.orderBy(*order).limit(top)
    return best.select(F.row_number().over(Window.orderBy(*order)).alias(rank), *df.columns)


def rank_carriers(card: DataFrame, minimum: int = C.MIN_CARRIER_OTD, top: int = C.TOP_CARRIERS):
    """Lowest on-time rate among carriers with enough eligible shipments."""
    df = card.where(
        (F.col("otd_eligible_shipments") >= minimum) & F.col("on_time_delivery_rate").isNotNull()
    ).select(
        "carrier_key", "scac", "carrier_legal_name", "primary_mode", "official_kpi_shipments",
        "otd_eligible_shipments", "on_time_shipments", "late_shipments", "on_time_delivery_rate",
        "otif_eligible_shipments", "otif_shipments", "otif_rate", "claim_rate",
        "gross_margin_percentage",
    )
    order = [F.asc("on_time_delivery_rate"), F.desc("late_shipments"), F.asc("carrier_key")]
    return ranked(df, order, top, "rate_rank")


def rank_lanes(card: DataFrame, minimum: int = C.MIN_LANE_OTIF, top: int = C.TOP_LANES):
    """Lowest OTIF rate among lanes with enough eligible shipments."""
    df = card.where(
        (F.col("otif_eligible_shipments") >= minimum) & F.col("otif_rate").isNotNull()
    ).select(
        "lane_key", "origin_warehouse_name", "destination_city", "destination_state",
        "destination_country", "official_kpi_shipments", "otd_eligible_shipments",
        "on_time_shipments", "late_shipments", "on_time_delivery_rate",
        "otif_eligible_shipments", "otif_shipments", "otif_rate", "average_days_late",
        "gross_margin_percentage",
    )
    order = [F.asc("otif_rate"), F.desc("late_shipments"), F.asc("lane_key")]
    return ranked(df, order, top, "rate_rank")


def rank_customers(
    card: DataFrame, minimum: int = C.MIN_CUSTOMER_SHIPMENTS, top: int = C.TOP_CUSTOMERS
):
    """Lowest margin among active customers with enough shipments."""
    df = card.where(
        (F.col("customer_status") == "ACTIVE")
        & (F.col("total_shipments") >= minimum)
        & F.col("gross_margin_percentage").isNotNull()
    ).select(
        "customer_key", "legal_name", "industry", "customer_status", "total_shipments",
        "customer_revenue_usd", "gross_margin_usd", "gross_margin_percentage", "complaint_rate",
        "claim_rate", "average_csat_score",
    )
    order = [F.asc("gross_margin_percentage"), F.desc("total_shipments"), F.asc("customer_key")]
    return ranked(df, order, top, "margin_rate_rank")


def delivery_impact(fact: DataFrame) -> DataFrame:
    """Complaints, claims and CSAT of late against on-time shipments.

    CSAT is weighted by valid responses; ``survey_weighted_csat`` is the variant weighted by
    all responses. Two rows come out of the grouping, so the baseline is a tiny join.
    """
    known = fact.where(is_true("official_kpi_eligible_flag") & F.col("final_on_time_flag").isNotNull())
    answered = (F.col("survey_response_count") > 0) & F.col("average_csat_score").isNotNull()
    n = F.col("survey_response_count")
    groups = known.groupBy(
        F.when(F.col("final_on_time_flag"), "On time").otherwise("Late").alias("delivery_status")
    ).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.avg(F.col("complaint_flag").cast("int")).alias("complaint_rate"),
        F.avg(F.col("claim_flag").cast("int")).alias("claim_rate"),
        F.coalesce(
            F.sum(F.when(F.col("average_csat_score").isNotNull(), F.col("valid_csat_response_count"))),
            F.lit(0),
        ).alias("csat_observations"),
        weighted_csat().alias("average_csat_score"),
        ratio(
            F.sum(F.when(answered, F.col("average_csat_score") * n)), F.sum(F.when(answered, n))
        ).alias("survey_weighted_csat"),
        F.avg("days_late").alias("average_days_late"),
    )
    # The whole frame is two rows by now.
    on_time = F.col("delivery_status") == "On time"
    everything = Window.partitionBy(F.lit(1))

    def baseline(name: str) -> Column:
        return F.max(F.when(on_time, F.col(name))).over(everything)

    return groups.select(
        *groups.columns,
        ratio(F.col("complaint_rate"), baseline("complaint_rate")).alias("complaint_rate_vs_on_time"),
        ratio(F.col("claim_rate"), baseline("claim_rate")).alias("claim_rate_vs_on_time"),
        (baseline("average_csat_score") - F.col("average_csat_score")).alias("csat_gap_below_on_time"),
    )


def eligibility_counts(card: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """A scorecard with its rate numerators and denominators recounted from the fact, merged one to one."""
    kpi = definitions()
    names = "otd_eligible_shipments on_time_shipments otif_eligible_shipments otif_shipments".split()
    counts = fact.groupBy(key).agg(*[kpi[n].alias(n) for n in names])
    return merge_one_to_one(card.drop(*names), counts, [key])


def as_rows(one_row: DataFrame, name: str = "metric", value: str = "metric_value") -> DataFrame:
    """Turn a one-row frame into (name, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in one_row.columns]
    )
    return one_row.select(F.inline(pairs))


def _context_columns() -> dict[str, Column]:
    kpi = definitions()
    official = is_true("official_kpi_eligible_flag")
    fill = F.col("shipment_fill_rate")
    otif_known = official & F.col("otif_flag").isNotNull()
    failures = count_where(official & is_false("otif_flag"))
    on_time_short = count_where(otif_known & is_true("final_on_time_flag") & (fill < 1))
    surveyed = count_where(F.col("survey_response_count") > 0)
    rows = F.count(F.lit(1))
    measured = kpi["full_fill_eligible_shipments"]
    return {
        "total_shipments": rows,
        "otd_eligible_shipments": kpi["otd_eligible_shipments"],
        "otif_eligible_shipments": kpi["otif_eligible_shipments"],
        "fill_measured_shipments": measured,
        "full_fill_shipments": kpi["full_fill_shipments"],
        "full_fill_rate": ratio(kpi["full_fill_shipments"], measured),
        "underfilled_rate": ratio(count_where(official & (fill < 1)), measured),
        "otif_failure_shipments": failures,
        "on_time_underfilled_shipments": on_time_short,
        "on_time_underfilled_share_of_otif_failures": ratio(on_time_short, failures),
        "surveyed_shipments": surveyed,
        "survey_response_coverage": ratio(surveyed, rows),
        "first_ship_date": F.min("ship_date"),
        "last_ship_date": F.max("ship_date"),
        "missing_ship_date_shipments": count_where(F.col("ship_date").isNull()),
        "missing_otd_result_shipments": count_where(official & F.col("final_on_time_flag").isNull()),
        "missing_otif_result_shipments": count_where(official & F.col("otif_flag").isNull()),
        "unknown_customer_shipments": count_where(
            F.col("customer_key").isNull() | (F.upper("customer_key") == C.UNKNOWN)
        ),
        "delivered_missing_delivery_date_shipments": count_where(
            (F.upper("shipment_status") == "DELIVERED") & F.col("actual_delivery_date").isNull()
        ),
    }


def analysis_context(fact: DataFrame) -> DataFrame:
    """Nineteen denominators and coverage numbers as (metric, value) text rows."""
    one = fact.agg(
        *[
            F.round(c, 6).cast("string").alias(n)
            if n.endswith(("_rate", "_share_of_otif_failures", "_coverage"))
            else c.cast("string").alias(n)
            for n, c in _context_columns().items()
        ]
    )
    return as_rows(one, value="value")


# Metric names.
SUMMARY_METRICS = [
    ("Total shipments", "total_shipments"),
    ("Official KPI shipments", "official_kpi_shipments"),
    ("OTD eligible shipments", "otd_eligible_shipments"),
    ("On-time delivery rate", "on_time_delivery_rate"),
    ("OTIF eligible shipments", "otif_eligible_shipments"),
    ("OTIF rate", "otif_rate"),
    ("Average fill rate", "average_fill_rate"),
    ("Full-fill rate", "full_fill_rate"),
    ("Average days late", "average_days_late"),
    ("Customer revenue", "customer_revenue_usd"),
    ("Gross margin", "gross_margin_usd"),
    ("Gross margin rate", "gross_margin_percentage"),
    ("Complaint rate", "complaint_rate"),
    ("Claim rate", "claim_rate"),
    ("Survey response coverage", "survey_response_coverage"),
    ("Average CSAT", "average_csat_score"),
    ("Net promoter score", "net_promoter_score"),
]


def executive_summary(fact: DataFrame) -> DataFrame:
    """The seventeen headline numbers as (metric, value) rows."""
    kpi, context = definitions(), _context_columns()
    one = fact.agg(
        *[
            (kpi[c] if c in EXECUTIVE else context[c]).cast("double").alias(name)
            for name, c in SUMMARY_METRICS
        ]
    )
    return as_rows(one, value="value")


def decision_scenarios(
    fact: DataFrame, recovery: float = 0.01, pilot_share: float = 0.10, benefit_usd: float = 25.0
) -> DataFrame:
    """What a revenue recovery, a routing pilot and an underfill pilot would be worth."""
    official = is_true("official_kpi_eligible_flag")
    late = count_where(official & is_false("final_on_time_flag"))
    short = count_where(
        official & F.col("otif_flag").isNotNull() & is_true("final_on_time_flag")
        & (F.col("shipment_fill_rate") < 1)
    )
    revenue = F.sum("customer_revenue_usd")
    return fact.agg(
        F.count(F.lit(1)).alias("shipments"),
        revenue.alias("revenue"),
        F.sum("carrier_cost_usd").alias("carrier_cost"),
        F.sum("claims_paid_usd").alias("paid_claims"),
        (revenue.cast("double") * recovery).alias("one_percent_revenue_recovery"),
        (late * pilot_share * benefit_usd).alias("routing_pilot_net_benefit"),
        short.alias("on_time_underfilled"),
        (short * pilot_share * benefit_usd).alias("underfill_pilot_net_benefit"),
    )


def coverage(fact: DataFrame) -> DataFrame:
    """Share of shipments each part of the analysis can speak for."""
    kpi = definitions()
    covered = {
        "Ship date": F.count("ship_date"),
        "Customer match": F.count("customer_key"),
        "Carrier match": F.count("carrier_key"),
        "Warehouse match": F.count("warehouse_key"),
        "Invoice match": count_where(F.col("invoice_count") > 0),
        "WMS match": count_where(F.col("wms_record_count") > 0),
        "Fill rate": F.count("shipment_fill_rate"),
        "Survey response": count_where(F.col("survey_response_count") > 0),
        "OTD eligible": kpi["otd_eligible_shipments"],
        "OTIF eligible": kpi["otif_eligible_shipments"],
    }
    one = fact.agg(F.count(F.lit(1)).alias("_all"), *[c.alias(n) for n, c in covered.items()])
    rows = F.array(
        *[F.struct(F.lit(n).alias("measure"), F.col(f"`{n}`").alias("covered_rows")) for n in covered]
    )
    return one.select(F.inline(rows), F.col("_all").alias("total_rows")).select(
        "measure", ratio(F.col("covered_rows"), F.col("total_rows")).alias("coverage"),
        "covered_rows", "total_rows",
    )


# --- risk queues ------------------------------------------------------------


def carrier_queue(fact: DataFrame, tables) -> DataFrame:
    return summary_by_label(fact, tables, "carrier_name").orderBy(
        F.desc("late_shipments"), "carrier_name"
    )


def lane_queue(fact: DataFrame, tables) -> DataFrame:
    return summary_by_lane(fact, tables).orderBy(
        F.desc("late_shipments"), F.desc("shipments"), "lane"
    )


def lowest_margin_lanes(fact: DataFrame, tables) -> DataFrame:
    return summary_by_lane(fact, tables).orderBy(F.asc("gross_margin_usd"), "lane")


def claim_queue(fact: DataFrame, tables) -> DataFrame:
    return summary_by_label(
        fact, tables, "customer_name",
        ["shipments", "otd_rate", "claim_rate", "claims_paid_usd", "complaint_shipments_per_1000"],
    ).orderBy(
        F.desc("claims_paid_usd"), F.desc("complaint_shipments_per_1000"), "customer_name"
    )


def carrier_cost_service(fact: DataFrame, tables) -> DataFrame:
    return summary_by_label(
        fact, tables, "carrier_name", ["carrier_cost_per_shipment", "otd_rate", "shipments"]
    )


def top_carriers_by_late(card: DataFrame, top: int = 10) -> DataFrame:
    return card.select("carrier_key", "carrier_legal_name", "late_shipments").orderBy(
        F.desc("late_shipments"), F.asc("carrier_key")
    ).limit(top)


SHIPMENT_360 = (
    "tms_shipment_id delivery_status mode service_level_name promised_delivery_date "
    "actual_delivery_date days_late warehouse_name carrier_name lane exception_code "
    "warehouse_cycle_hours shipment_fill_rate short_pick_flag customer_name "
    "customer_revenue_usd carrier_cost_usd claims_paid_usd gross_margin_usd ticket_count "
    "average_csat_score shipment_nps"
).split()


def shipment_360(fact: DataFrame, tables, shipment_id: str | None = None) -> DataFrame:
    """Operations, money and customer signals of one shipment, or of all."""
    if shipment_id is not None:
        fact = fact.where(F.col("tms_shipment_id") == shipment_id)
    for name in ("warehouse_name", "carrier_name", "customer_name"):
        fact = label(fact, tables, name)
    status = (
        F.when(F.col("final_on_time_flag").isNull(), "Unresolved")
        .when(F.col("final_on_time_flag"), "On time")
        .otherwise("Late")
    )
    return fact.withColumns({"delivery_status": status, "lane": lane_text()}).select(*SHIPMENT_360)


# --- tables the report pages ask for ----------------------------------------


def action_queue(fact: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Nested totals, such as warehouse > carrier: each innermost group and every subtotal.

    Innermost groups are aggregated first and the rollup works on that result. ``level`` has
    a bit set for each level rolled up: 0 for innermost groups, all bits for the grand total.
    """
    kpi = definitions()
    names = (
        "total_shipments otd_eligible_shipments on_time_shipments late_shipments "
        "customer_revenue_usd gross_margin_usd"
    ).split()
    inner = fact.groupBy(*levels).agg(*[kpi[n].alias(n) for n in names])
    return (
        inner.rollup(*levels)
        .agg(F.grouping_id().cast("int").alias("level"), *[F.sum(n).alias(n) for n in names])
        .withColumns({
            "on_time_delivery_rate": ratio(
                F.col("on_time_shipments"), F.col("otd_eligible_shipments")
            ),
            "gross_margin_percentage": ratio(
                F.col("gross_margin_usd"), F.col("customer_revenue_usd")
            ),
        })
    )


def late_by_exception(fact: DataFrame) -> DataFrame:
    return (
        fact.where(is_true("official_kpi_eligible_flag") & is_false("final_on_time_flag"))
        .groupBy("exception_code")
        .agg(F.count(F.lit(1)).alias("late_shipments"))
    )


def margin_bridge(fact: DataFrame) -> DataFrame:
    """Revenue, less carrier cost, less claims, to margin."""
    one = fact.agg(
        F.sum("customer_revenue_usd").cast("double").alias("Customer revenue"),
        (-F.sum("carrier_cost_usd").cast("double")).alias("Carrier cost"),
        (-F.sum("claims_paid_usd").cast("double")).alias("Claims paid"),
        F.sum("gross_margin_usd").cast("double").alias("Gross margin"),
    )
    return as_rows(one, "step", "amount_usd")


def late_breakdown(fact: DataFrame) -> DataFrame:
    """Late shipments split by each explaining factor on its own, from one scan.

    Rows are first counted per combination of factors, so the split multiplies that result
    and not the shipments.
    """
    factors = {
        "warehouse": F.col("warehouse_key"),
        "mode": F.col("mode"),
        "service_level": F.col("service_level_name"),
        "short_pick": F.col("short_pick_flag").cast("string"),
        "exception_code": F.col("exception_code"),
    }
    late = is_true("official_kpi_eligible_flag") & is_false("final_on_time_flag")
    combos = (
        fact.select(*[c.alias(n) for n, c in factors.items()], late.alias("_late"))
        .groupBy(*factors)
        .agg(F.count(F.lit(1)).alias("_n"), count_where(F.col("_late")).alias("_l"))
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("factor"), F.col(n).alias("factor_value")) for n in factors]
    )
    return (
        combos.select(F.inline(pairs), "_n", "_l")
        .groupBy("factor", "factor_value")
        .agg(F.sum("_n").alias("shipments"), F.sum("_l").alias("late_shipments"))
    )


def monthly_coverage(fact: DataFrame) -> DataFrame:
    def share(name: str) -> Column:
        return rate_where(F.col(name) > 0, F.lit(True))

    return fact.groupBy(month_start(F.col("ship_date")).alias("month_start_date")).agg(
        F.count(F.lit(1)).alias("shipments"),
        share("invoice_count").alias("invoice_coverage"),
        share("wms_record_count").alias("wms_coverage"),
        share("survey_response_count").alias("survey_coverage"),
    )


def unknown_members(fact: DataFrame) -> DataFrame:
    one = fact.agg(
        count_where(F.col("customer_key") == C.UNKNOWN).alias("Customer"),
        count_where(F.col("carrier_key") == C.UNKNOWN).alias("Carrier"),
        count_where(F.col("warehouse_key") == C.UNKNOWN).alias("Warehouse"),
        count_where(F.col("service_key") == f"{C.UNKNOWN}|{C.UNKNOWN}").alias("Service"),
        count_where(F.col("lane_key") == "|".join([C.UNKNOWN] * 5)).alias("Lane"),
        count_where(F.col("ship_date").isNull()).alias("Ship date"),
    )
    return as_rows(one, "dimension", "unknown_shipments")


def tickets_by_customer_state(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_key", "dest_state").agg(
        F.sum("ticket_count").alias("complaint_tickets"),
        F.sum("severe_ticket_count").alias("severe_tickets"),
    )
