"""Registered queries: name -> function of the layers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrain import contracts
from haulgrain.operators import (
    children,
    dimensions,
    findings,
    measures,
    profiling,
    quality,
    release,
    segments,
    staging,
)
from haulgrain.operators.matching import distinct_keys
from haulgrain.plans.layers import Layers
from haulgrain.sources.landing import LandedRaw, land_extracts, read_extract
from haulgrain.sources.lineage import file_digests, load_lineage, table_counts
from haulgrain.sources.publish import publish, published_summary, write_report

Query = Callable[[Layers], DataFrame]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(query_name: str, table: str) -> None:
    QUERIES[query_name] = lambda t: t[table]


for _q, _t in {
    "stg_customers": "stg_customers",
    "stg_crosswalk": "stg_customer_crosswalk",
    "stg_warehouses": "stg_warehouses",
    "stg_carriers": "stg_carriers",
    "stg_shipments": "stg_shipments",
    "stg_lines": "stg_shipment_lines",
    "stg_events": "stg_tracking_events",
    "stg_events_dedup": "stg_tracking_events_dedup",
    "stg_wms": "stg_wms_outbound",
    "stg_invoices": "stg_invoices",
    "stg_claims": "stg_claims",
    "stg_tickets": "stg_crm_tickets",
    "stg_surveys": "stg_csat_responses",
    "dim_customer": "dim_customer",
    "dim_carrier": "dim_carrier",
    "dim_warehouse": "dim_warehouse",
    "dim_service": "dim_service",
    "fact_shipment": "fact_shipment",
    "kpi_executive": "vw_executive_kpis",
    "kpi_monthly": "vw_monthly_performance",
    "kpi_carrier": "vw_carrier_scorecard",
    "kpi_warehouse": "vw_warehouse_scorecard",
    "kpi_customer": "vw_customer_scorecard",
    "kpi_lane": "vw_lane_scorecard",
}.items():
    _table(_q, _t)


# --- matching ---------------------------------------------------------------


@query
def match_wms(t):
    return staging.match_wms(t.raw["wms_outbound"], t["stg_shipments"], t.reread).select(
        "wms_outbound_id", "matched_tms_shipment_id", "shipment_match_method"
    )


@query
def match_invoices(t):
    return staging.match_invoices(t.raw["erp_invoices"], t["stg_shipments"], t.reread).select(
        "invoice_id", "matched_tms_shipment_id", "shipment_match_method"
    )


@query
def match_claims(t):
    return staging.match_claims(t.raw["claims"], t["stg_shipments"]).select(
        "claim_id", "matched_tms_shipment_id", "shipment_match_method", "actual_delivery_ts"
    )


def _tickets(t):
    return staging.match_tickets(
        t.raw["crm_tickets"], t["stg_shipments"], t["stg_customers"], t["stg_customer_crosswalk"], t.reread
    )


@query
def match_ticket_shipment(t):
    return _tickets(t).select("ticket_id", "matched_tms_shipment_id", "shipment_match_method")


@query
def match_ticket_customer(t):
    return _tickets(t).select("ticket_id", "matched_erp_customer_id", "customer_match_method")


@query
def resolve_customer(t):
    return t["resolved_shipments"].select(
        "tms_shipment_id", "resolved_customer_key", "customer_match_method",
        "resolved_test_account_flag",
    )


@query
def live_child_antijoin(t):
    return t["stg_shipments"].select(
        "tms_shipment_id", "parent_tms_shipment_id", "base_eligible_flag", "final_live_shipment_flag"
    )


@query
def latest_per_sales_order(t):
    return staging.live_lookup(t["stg_shipments"], "sales_order_id")


@query
def crosswalk_best(t):
    return staging.crosswalk_lookup(t["stg_customer_crosswalk"])


# --- child totals -----------------------------------------------------------


@query
def agg_lines(t):
    return t.child_totals("lines")


@query
def agg_events(t):
    return t.child_totals("events")


@query
def agg_wms(t):
    return t.child_totals("wms")


@query
def agg_invoices(t):
    return t.child_totals("invoices")


@query
def agg_claims(t):
    return t.child_totals("claims")


@query
def agg_tickets(t):
    return t.child_totals("tickets")


@query
def agg_surveys(t):
    ids = distinct_keys(t["stg_shipments"], "tms_shipment_id")
    return t.child_totals("surveys").join(ids, "tms_shipment_id", "left_semi")


# --- dimensions with labels -------------------------------------------------


@query
def dim_date(t):
    return dimensions.date_labels(t["dim_date"])


@query
def dim_lane(t):
    return dimensions.lane_labels(t["dim_lane"])


# --- measures and slices ----------------------------------------------------

SAMPLE_SLICE = measures.Slice(keep={"mode": ["LTL", "FTL"]}, start="1997-01-01", end="1999-12-31")


def _measure_group(group: str) -> None:
    QUERIES[f"measures_{group}"] = lambda t: measures.evaluate(
        t["fact_shipment"], measures.GROUPS[group], ["mode"]
    )


for _group in measures.GROUPS:
    _measure_group(_group)


@query
def measures_time(t):
    return measures.previous_month(t["fact_shipment"])


@query
def measures_time_by_mode(t):
    """Months of the slice by mode; the months before them may lie outside it."""
    return measures.previous_month(t["fact_shipment"], ["mode"], SAMPLE_SLICE)


@query
def measures_targets(t):
    return measures.target_status(t["fact_shipment"])


@query
def measures_targets_by_mode(t):
    return measures.target_status(t["fact_shipment"], ["mode"], SAMPLE_SLICE)


@query
def measures_sliced(t):
    """A date slice that the data-quality measures must ignore."""
    names = [
        "total_shipments", "on_time_delivery_pct", "gross_margin_pct", "delivered_shipments",
        "promised_shipments", "shipments_with_known_ship_date", "shipments_missing_ship_date",
        "ship_date_coverage_pct", "revenue_missing_ship_date", "data_through_date",
    ]
    return measures.evaluate(t["fact_shipment"], names, ["dest_state"], SAMPLE_SLICE)


@query
def date_roles(t):
    return measures.shipments_by_role(t["fact_shipment"])


@query
def slice_kpis(t):
    rows = segments.pick_names(
        measures.apply_slice(t["fact_shipment"], SAMPLE_SLICE), t,
        {"warehouse_name": ["Warehouse 1", "Warehouse 2", "Warehouse 3", "Unknown warehouse"]},
    )
    return segments.kpi_summary(rows, ["mode", "dest_state"])


@query
def segment_summary(t):
    return segments.summary_by_label(t["fact_shipment"], t, "carrier_name")


@query
def segment_lanes(t):
    return segments.summary_by_lane(t["fact_shipment"], t)


@query
def monthly_series(t):
    return segments.monthly_series(t["fact_shipment"])


@query
def dashboard_variants(t):
    return segments.dashboard_variants(t["fact_shipment"])


# --- profiling and quality --------------------------------------------------


@query
def profile_tables(t):
    return profiling.profile_tables(t.raw)


@query
def profile_columns(t):
    return profiling.profile_columns(t.raw)


@query
def duplicate_keys(t):
    return profiling.duplicate_keys(t.raw)


@query
def business_checks(t):
    return profiling.business_checks(t.raw)


QUERIES["quality_staging"] = quality.staging_counts
QUERIES["quality_shipments"] = quality.shipment_metrics
QUERIES["quality_lines_events"] = quality.line_event_metrics
QUERIES["quality_wms_invoices"] = quality.wms_invoice_metrics
QUERIES["quality_customer_impact"] = quality.customer_impact_metrics
QUERIES["quality_star"] = quality.star_metrics


FIRST_DAY, LAST_DAY = "1995-01-01", "2001-12-31"


@query
def validate_model(t):
    return quality.validate_model(t, FIRST_DAY, LAST_DAY)


@query
def validate_model_ordered(t):
    """The gates in the order of a report: by severity, then name."""
    return quality.numbered_by_severity(quality.validate_model(t, FIRST_DAY, LAST_DAY))


@query
def benchmark_totals(t):
    """The executive KPIs against the published totals; other data than the published must miss them."""
    return quality.check_targets(t["vw_executive_kpis"], contracts.BENCHMARK_TOTALS)


# --- findings ---------------------------------------------------------------
# The published volume guardrails leave small data empty, so the rankings also run with lower ones.


@query
def rank_carriers(t):
    return findings.rank_carriers(t["vw_carrier_scorecard"], minimum=20)


@query
def rank_lanes(t):
    return findings.rank_lanes(t["vw_lane_scorecard"], minimum=5)


@query
def rank_customers(t):
    return findings.rank_customers(t["vw_customer_scorecard"], minimum=5)


@query
def rank_carriers_published(t):
    return findings.rank_carriers(t["vw_carrier_scorecard"])


@query
def rank_lanes_published(t):
    return findings.rank_lanes(t["vw_lane_scorecard"])


@query
def rank_customers_published(t):
    return findings.rank_customers(t["vw_customer_scorecard"])


@query
def eligibility_counts(t):
    return findings.eligibility_counts(t["vw_lane_scorecard"], t["fact_shipment"], "lane_key").select(
        "lane_key", "total_shipments", "otd_eligible_shipments", "on_time_shipments",
        "otif_eligible_shipments", "otif_shipments",
    )


def _on_fact(name: str) -> None:
    fn = getattr(findings, name)
    QUERIES[name] = lambda t: fn(t["fact_shipment"])


def _on_fact_and_dims(name: str, as_name: str | None = None) -> None:
    fn = getattr(findings, name)
    QUERIES[as_name or name] = lambda t: fn(t["fact_shipment"], t)


for _name in (
    "delivery_impact analysis_context executive_summary decision_scenarios coverage "
    "late_by_exception margin_bridge late_breakdown monthly_coverage unknown_members "
    "tickets_by_customer_state"
).split():
    _on_fact(_name)
for _name in (
    "carrier_queue lane_queue lowest_margin_lanes claim_queue carrier_cost_service shipment_360"
).split():
    _on_fact_and_dims(_name)


@query
def shipment_lookup(t):
    """The signals of one shipment."""
    return findings.shipment_360(t["fact_shipment"], t, "TMS4")


@query
def warehouse_ops(t):
    return segments.warehouse_operations(t["fact_shipment"], t)


@query
def top_late_carriers(t):
    return findings.top_carriers_by_late(t["vw_carrier_scorecard"])


@query
def action_queue_warehouse(t):
    return findings.action_queue(t["fact_shipment"], ["warehouse_key", "carrier_key"])


@query
def action_queue_customer(t):
    return findings.action_queue(t["fact_shipment"], ["customer_key", "lane_key"])


@query
def action_queue_lane(t):
    return findings.action_queue(t["fact_shipment"], ["warehouse_key", "dest_state", "lane_key"])


# --- lineage ----------------------------------------------------------------


@query
def lineage_counts(t):
    return profiling.union_all([table_counts(t.raw[n], n) for n in contracts.RAW_COLUMNS])


SOURCES = "customer nation supplier orders lineitem events".split()


def _lineage(t) -> DataFrame:
    return load_lineage(t.spark, {n: f"{t.raw.sf_dir}/{n}.parquet" for n in SOURCES})


@query
def lineage_files(t):
    return _lineage(t)


@query
def lineage_fingerprints(t):
    """Content fingerprints of the source tables, whatever their files."""
    return _lineage(t).select("table_name", "row_count", "column_count", "fingerprint")


@query
def source_digests(t):
    """SHA-256 of each file of the source tables."""
    return profiling.union_all([
        file_digests(t.spark, f"{t.raw.sf_dir}/{n}.parquet").select(F.lit(n).alias("table_name"), "length", "sha256")
        for n in SOURCES
    ])


@query
def landing_roundtrip(t):
    """Documents written as a CSV extract, landed with normalised names, and read as a raw table.

    Texts hold quotes, commas and line breaks; identifiers come back as text.
    """
    folder = t.path("landing")
    docs = t.spark.read.parquet(f"{t.raw.sf_dir}/documents.parquet")
    docs.select(F.col("doc_id").alias("Document ID"), F.col("source").alias("sourceSystem"), F.col("text").alias("Full (Text)")).write.mode(
        "overwrite").options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                             ignoreTrailingWhiteSpace=False).csv(f"{folder}/in.csv")
    land_extracts(t.spark, {"documents": f"{folder}/in.csv"}, f"{folder}/raw")
    landed = LandedRaw(t.spark, f"{folder}/raw")["documents"]
    return landed.select("document_id", "source_system", F.length("full_text").cast("long").alias("n_chars"),
                         F.md5(F.col("full_text").cast("binary")).alias("text_md5"))


@query
def publish_roundtrip(t):
    """All outputs published as one run: rows, columns and filled cells as readers find them."""
    folder = t.path("published")
    publish(t, folder)
    return published_summary(t.spark, folder)


@query
def report_roundtrip(t):
    """The duplicate key list as a CSV report, as it is read back: all text, columns in order."""
    path = t.path("reports/duplicate_keys")
    duplicates = profiling.duplicate_keys(t.raw)
    write_report(duplicates, path, duplicates.columns)
    return read_extract(t.spark, path, "csv")


@query
def release_checks(t):
    """Every cross-layer check of a release: sources, model, published outputs and reports."""
    folder, lineage, reports = t.path("release"), t.path("release_lineage"), t.path("release_reports")
    paths = {n: f"{t.raw.sf_dir}/{n}.parquet" for n in SOURCES}
    _lineage(t).write.mode("overwrite").parquet(lineage)
    publish(t, folder)
    listed = {"duplicate_keys": profiling.duplicate_keys(t.raw), "data_quality_issues": profiling.business_checks(t.raw)}
    for name, df in listed.items():
        write_report(df, f"{reports}/{name}", df.columns)
    return profiling.union_all([
        release.source_checks({n: t.raw.source(n) for n in SOURCES}, t.spark.read.parquet(lineage), t.spark, paths),
        release.model_checks(t, FIRST_DAY, LAST_DAY),
        release.export_checks(t, t.spark, folder),
        release.report_checks(t.spark, [f"{reports}/{name}" for name in listed]),
    ])


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and doubles to six places, for comparison across engines."""
    return df.selectExpr(
        *[
            f"round(double(`{f.name}`), 6) AS `{f.name}`"
            if f.dataType.typeName() in ("decimal", "double", "float")
            else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )
