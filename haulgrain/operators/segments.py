"""Dashboard tables: summaries of a sliced fact by any column or by a dimension's label.

Totals are sums and counts only, so they are taken by key first and regrouped by label on
the few rows left; the fact itself is never joined to a dimension to be summarised.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.functions.measures import mean_where, month_start, ratio

# label -> (dimension, key, label column, text for a missing label)
NAMES = {
    "carrier_name": ("dim_carrier", "carrier_key", "carrier_legal_name", "Unknown carrier"),
    "warehouse_name": ("dim_warehouse", "warehouse_key", "warehouse_name", "Unknown warehouse"),
    "customer_name": ("dim_customer", "customer_key", "legal_name", "Unknown customer"),
}


def _labels(tables, out: str) -> DataFrame:
    """(key, _label), one row a key even if the dimension repeats one."""
    dim, key, column, _ = NAMES[out]
    return tables[dim].groupBy(key).agg(F.min(column).alias("_label"))


def label(df: DataFrame, tables, out: str) -> DataFrame:
    """Left join a dimension's label by its key; no row is multiplied."""
    _, key, _, unknown = NAMES[out]
    names = _labels(tables, out)
    return df.join(names, key, "left").withColumn(
        out, F.coalesce("_label", F.lit(unknown))
    ).drop("_label")


def lane_text() -> Column:
    return F.concat(
        F.col("warehouse_name"), F.lit(" → "), F.coalesce("dest_city", F.lit("Unknown")),
        F.lit(", "), F.coalesce("dest_state", F.lit("??")),
    )


def with_names(fact: DataFrame, tables) -> DataFrame:
    """Add carrier, warehouse and customer names and a readable lane to each row."""
    for out in NAMES:
        fact = label(fact, tables, out)
    return fact.withColumn("lane", lane_text())


def pick_names(fact: DataFrame, tables, wanted: dict[str, Sequence[str]]) -> DataFrame:
    """Keep rows whose dimension label is among the wanted ones.

    The keys are picked in the dimension, so the fact meets only a list of keys. Rows without a
    label are wanted as its text for a missing one: then the unwanted keys are taken away.
    """
    for out, values in wanted.items():
        if values:
            _, key, _, unknown = NAMES[out]
            names, among = _labels(tables, out), F.col("_label").isin(list(values))
            if unknown in values:
                fact = fact.join(names.where(F.col("_label").isNotNull() & ~among).select(key), key, "left_anti")
            else:
                fact = fact.join(names.where(among).select(key), key, "left_semi")
    return fact


_OFFICIAL = "official_kpi_eligible_flag"

TOTALS: dict[str, str] = {
    "shipments": "count(1)",
    "official_shipments": f"count_if({_OFFICIAL})",
    "otd_eligible": f"count_if({_OFFICIAL} AND final_on_time_flag IS NOT NULL)",
    "on_time_shipments": f"count_if({_OFFICIAL} AND final_on_time_flag)",
    "late_shipments": f"count_if({_OFFICIAL} AND NOT final_on_time_flag)",
    "otif_eligible": f"count_if({_OFFICIAL} AND otif_flag IS NOT NULL)",
    "otif_shipments": f"count_if({_OFFICIAL} AND otif_flag)",
    "fill_eligible": f"count_if({_OFFICIAL} AND shipment_fill_rate IS NOT NULL)",
    "full_fill_shipments": f"count_if({_OFFICIAL} AND shipment_fill_rate >= 1)",
    "revenue_usd": "coalesce(sum(customer_revenue_usd), 0)",
    "carrier_cost_usd": "coalesce(sum(carrier_cost_usd), 0)",
    "claims_paid_usd": "coalesce(sum(claims_paid_usd), 0)",
    "gross_margin_usd": "coalesce(sum(gross_margin_usd), 0)",
    "complaints": "count_if(complaint_flag)",
    "claims": "count_if(claim_flag)",
    "_cycle_sum": "sum(warehouse_cycle_hours)",
    "_cycle_n": "count(warehouse_cycle_hours)",
    "_short_sum": "sum(int(short_pick_flag))",
    "_short_n": "count(short_pick_flag)",
    "_accuracy_sum": "sum(average_inventory_accuracy)",
    "_accuracy_n": "count(average_inventory_accuracy)",
}

# derived -> (numerator, denominator, factor)
_RATES = {
    "otd_rate": ("on_time_shipments", "otd_eligible", 1),
    "otif_rate": ("otif_shipments", "otif_eligible", 1),
    "full_fill_rate": ("full_fill_shipments", "fill_eligible", 1),
    "margin_rate": ("gross_margin_usd", "revenue_usd", 1),
    "complaint_shipments_per_1000": ("complaints", "shipments", 1000),
    "claim_rate": ("claims", "shipments", 1),
    "carrier_cost_per_shipment": ("carrier_cost_usd", "shipments", 1),
    "cycle_hours": ("_cycle_sum", "_cycle_n", 1),
    "short_pick_rate": ("_short_sum", "_short_n", 1),
    "inventory_accuracy": ("_accuracy_sum", "_accuracy_n", 1),
}
SUMMARY = (
    "shipments official_shipments otd_eligible otif_eligible fill_eligible otd_rate otif_rate "
    "full_fill_rate late_shipments revenue_usd carrier_cost_usd claims_paid_usd "
    "gross_margin_usd margin_rate complaints claims complaint_shipments_per_1000 claim_rate "
    "carrier_cost_per_shipment"
).split()


def _needed(columns: Sequence[str]) -> list[str]:
    parts = [p for c in columns for p in (_RATES[c][:2] if c in _RATES else (c,))]
    return list(dict.fromkeys(parts))


def _finish(totals: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def value(name: str) -> str:
        if name not in _RATES:
            return name
        a, b, factor = _RATES[name]
        return f"try_divide(double({factor} * {a}), double({b})) AS {name}"

    return totals.selectExpr(*keys, *[value(c) for c in columns])


def _by(fact: DataFrame, keys: Sequence, columns: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(*[F.expr(f"{TOTALS[n]} AS {n}") for n in _needed(columns)])


def _regroup(totals: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return totals.groupBy(key).agg(*[F.expr(f"sum({n}) AS {n}") for n in _needed(columns)])


def kpi_summary(
    fact: DataFrame, by: Sequence[str] = (), columns: Sequence[str] = tuple(SUMMARY)
) -> DataFrame:
    """Summary for any grouping columns of the fact; nulls are a group."""
    return _finish(_by(fact, by, columns), by, columns)


def summary_by_label(
    fact: DataFrame, tables, out: str, columns: Sequence[str] = tuple(SUMMARY)
) -> DataFrame:
    """Summary by carrier, warehouse or customer name."""
    totals = label(_by(fact, [NAMES[out][1]], columns), tables, out)
    return _finish(_regroup(totals, out, columns), [out], columns)


def summary_by_lane(
    fact: DataFrame, tables, columns: Sequence[str] = tuple(SUMMARY)
) -> DataFrame:
    totals = _by(fact, ["warehouse_key", "dest_city", "dest_state"], columns)
    named = label(totals, tables, "warehouse_name").withColumn("lane", lane_text())
    return _finish(_regroup(named, "lane", columns), ["lane"], columns)


def monthly_series(fact: DataFrame) -> DataFrame:
    """Service and margin by month; undated shipments are left out."""
    dated = fact.where(F.col("ship_date").isNotNull())
    columns = ["shipments", "otd_rate", "otif_rate", "gross_margin_usd"]
    totals = _by(dated, [month_start(F.col("ship_date")).alias("month_start_date")], columns)
    return _finish(totals, ["month_start_date"], columns)


def warehouse_operations(fact: DataFrame, tables) -> DataFrame:
    return summary_by_label(
        fact, tables, "warehouse_name",
        ["shipments", "otd_rate", "full_fill_rate", "cycle_hours", "short_pick_rate",
         "inventory_accuracy"],
    )


def dashboard_variants(fact: DataFrame) -> DataFrame:
    """The dashboard's own formulas where they differ from the governed KPIs."""
    responses, rows = F.sum("survey_response_count"), F.count(F.lit(1))
    return fact.agg(
        F.avg("average_csat_score").alias("plain_average_csat"),
        ratio(100 * (F.sum("promoter_count") - F.sum("detractor_count")), responses)
        .alias("nps_per_response"),
        mean_where(F.col("days_late"), F.col("days_late") > 0).alias("average_days_late_any"),
        ratio(responses, rows).alias("responses_per_shipment"),
    )
