"""Quality metric tables and the model validation gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulgrain import contracts as C
from haulgrain.functions.measures import count_where, month_start
from haulgrain.operators.fact import margin, otif
from haulgrain.operators.findings import as_rows
from haulgrain.operators.kpis import KPI, SCORECARDS, card_labels
from haulgrain.operators.profiling import listed, union_all


def _rows() -> Column:
    return F.count(F.lit(1))


def _one_pass(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """All metrics of a table from one scan, as (metric, metric_value) rows."""
    return as_rows(df.agg(*[c.alias(label) for label, c in metrics.items()]))


def staging_counts(t) -> DataFrame:
    tables = "stg_customers stg_customer_crosswalk stg_warehouses stg_carriers stg_shipments".split()
    return union_all([
        t[n].agg(_rows().alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in tables
    ])


def shipment_metrics(t) -> DataFrame:
    live, official = F.col("final_live_shipment_flag"), F.col("official_kpi_eligible_flag")
    source, calculated = F.col("source_on_time_flag"), F.col("calculated_on_time_flag")
    picked, delivered = F.col("actual_pickup_ts"), F.col("actual_delivery_ts")
    return _one_pass(t["stg_shipments"], {
        "Total staged shipments": _rows(),
        "Final live shipments": count_where(live),
        "Staged official-KPI-eligible shipments": count_where(official),
        "Delivered shipments missing actual delivery timestamp": count_where(
            (F.col("shipment_status") == "DELIVERED") & delivered.isNull()
        ),
        "Source and calculated on-time results conflict": count_where(source != calculated),
        "Staged official-KPI-eligible shipments missing on-time result": count_where(
            official & F.col("final_on_time_flag").isNull()
        ),
        "Final live shipments missing ship date": count_where(live & F.col("ship_create_date").isNull()),
        "Final live shipments missing promised date": count_where(
            live & F.col("promised_delivery_date").isNull()
        ),
        "Delivery timestamp precedes pickup timestamp": count_where(delivered < picked),
    })


def line_event_metrics(t) -> DataFrame:
    status = F.col("quantity_status")
    lines = _one_pass(t["stg_shipment_lines"], {
        "Shipment lines": _rows(),
        "Short-shipped lines": count_where(status == "SHORT SHIPPED"),
        "Over-shipped lines": count_where(status == "OVER SHIPPED"),
        "Lines missing shipped quantity": count_where(F.col("qty_shipped").isNull()),
        "Unmatched shipment lines": count_where(~F.col("shipment_match_flag")),
    })
    events = _one_pass(t["stg_tracking_events"], {
        "Raw tracking events": _rows(),
        "Duplicate delivery events removed": count_where(F.col("duplicate_event_flag")),
        "Deduplicated tracking events": count_where(F.col("keep_event_flag")),
        "Unmatched tracking events": count_where(~F.col("shipment_match_flag")),
    })
    return lines.unionByName(events)


def _method(label: str) -> Column:
    return count_where(F.col("shipment_match_method") == label)


def wms_invoice_metrics(t) -> DataFrame:
    wms = _one_pass(t["stg_wms_outbound"], {
        "Total WMS rows": _rows(),
        "WMS direct shipment matches": _method(C.BY_SHIPMENT_ID),
        "WMS sales-order fallback matches": _method(C.BY_SALES_ORDER),
        "Unmatched WMS rows": _method(C.UNMATCHED),
        "WMS short picks": count_where(F.col("short_pick_flag")),
        "WMS invalid timestamp sequences": count_where(F.col("invalid_timestamp_sequence_flag")),
    })
    invoices = _one_pass(t["stg_invoices"], {
        "Total invoice rows": _rows(),
        "Invoice direct shipment matches": _method(C.BY_SHIPMENT_ID),
        "Invoice sales-order fallback matches": _method(C.BY_SALES_ORDER),
        "Invoice PRO-number fallback matches": _method(C.BY_PRO_NUMBER),
        "Unmatched invoices": _method(C.UNMATCHED),
        "Customer revenue invoices": count_where(F.col("invoice_type") == "CUSTOMER"),
        "Carrier bill invoices": count_where(F.col("invoice_type") == "CARRIER_BILL"),
        "Disputed invoices": count_where(F.col("dispute_flag")),
    })
    return wms.unionByName(invoices)


def customer_impact_metrics(t) -> DataFrame:
    no_shipment = count_where(~F.col("shipment_match_flag"))

    def nps(name: str) -> Column:
        return count_where(F.col("nps_category") == name)

    return union_all([
        _one_pass(t["stg_claims"], {
            "Total claims": _rows(),
            "Unmatched claims": no_shipment,
            "Claims paid above requested": count_where(F.col("paid_exceeds_requested_flag")),
        }),
        _one_pass(t["stg_crm_tickets"], {
            "Total CRM tickets": _rows(),
            "Unmatched ticket shipments": no_shipment,
            "Unmatched ticket customers": count_where(~F.col("customer_match_flag")),
            "Tickets categorized as OTHER": count_where(F.col("category_normalized") == "OTHER"),
        }),
        _one_pass(t["stg_csat_responses"], {
            "Total CSAT responses": _rows(),
            "Invalid CSAT scores": count_where(~F.col("valid_csat_flag")),
            "Invalid NPS scores": count_where(~F.col("valid_nps_flag")),
            "Unmatched CSAT shipments": no_shipment,
            "Promoters": nps("PROMOTER"),
            "Passives": nps("PASSIVE"),
            "Detractors": nps("DETRACTOR"),
        }),
    ])


def star_metrics(t) -> DataFrame:
    fact = t["fact_shipment"]

    def unknown(key: str) -> Column:
        return count_where(F.col(key) == C.UNKNOWN)

    one_pass = _one_pass(fact, {
        "Fact shipment rows": _rows(),
        "Official KPI shipments": count_where(F.col("official_kpi_eligible_flag")),
        "Unknown customers": unknown("customer_key"),
        "Unknown carriers": unknown("carrier_key"),
        "Unknown warehouses": unknown("warehouse_key"),
        "Shipments missing fill rate": count_where(F.col("shipment_fill_rate").isNull()),
        "Shipments with invoice data": count_where(F.col("invoice_count") > 0),
        "Shipments with claims": count_where(F.col("claim_count") > 0),
        "Shipments with CRM tickets": count_where(F.col("ticket_count") > 0),
        "Shipments with CSAT responses": count_where(F.col("survey_response_count") > 0),
    })
    repeats = fact.groupBy("shipment_key").count().agg(
        count_where(F.col("count") > 1).alias("Duplicate fact shipment keys")
    )
    return one_pass.unionByName(as_rows(repeats))


# --- model validation -------------------------------------------------------

# Test names.
VIEW_CHECKS = {
    "executive shipment total reconciles to fact": "vw_executive_kpis",
    "monthly shipment totals reconcile to fact": "vw_monthly_performance",
    "carrier scorecard totals reconcile to fact": "vw_carrier_scorecard",
    "warehouse scorecard totals reconcile to fact": "vw_warehouse_scorecard",
    "customer scorecard totals reconcile to fact": "vw_customer_scorecard",
    "lane scorecard totals reconcile to fact": "vw_lane_scorecard",
}
DATE_CHECKS = {
    "non-null fact ship dates resolve": "ship_date",
    "non-null promised dates resolve": "promised_delivery_date",
    "non-null actual delivery dates resolve": "actual_delivery_date",
}
COST_CHECKS = {
    "carrier accessorial cost reconciles to invoices": ("accessorial_amount_usd", "total_accessorial_usd"),
    "carrier fuel surcharge cost reconciles to invoices": ("fuel_surcharge_usd", "total_fuel_surcharge_usd"),
}


def _flag(cond: Column) -> Column:
    """One if the condition holds, for a check that can fail once."""
    return F.when(cond, 1).otherwise(0).cast("long")


def _fact_checks(first_day: str, last_day: str) -> dict[str, Column]:
    """Checks that one pass over the fact answers."""
    ship = F.col("ship_date")
    responses, valid = F.col("survey_response_count"), F.col("valid_csat_response_count")
    return {
        "fact_shipment key is not null": count_where(F.col("shipment_key").isNull()),
        "gross margin identity is consistent": count_where(
            ~F.col("gross_margin_usd").eqNullSafe(margin())
        ),
        "shipment dates stay within the declared 2024-2025 fixture window": count_where(
            (ship < F.lit(first_day).cast("date")) | (ship > F.lit(last_day).cast("date"))
        ),
        "aggregate gross margin is positive": _flag(
            F.coalesce(F.sum("gross_margin_usd"), F.lit(0)) <= 0
        ),
        "OTIF flag follows its documented rule": count_where(
            ~F.col("otif_flag").eqNullSafe(
                otif(F.col("final_on_time_flag"), F.col("shipment_fill_rate"))
            )
        ),
        "valid CSAT responses do not exceed survey responses": count_where(
            (valid < 0) | (valid > responses)
        ),
        "CSAT averages have valid response counts": count_where(
            F.col("average_csat_score").isNotNull() & (valid == 0)
        ),
    }


DIMENSIONS = ("customer", "carrier", "warehouse", "service", "lane")
DATE_KEYS = ("ship_date_key", "promised_delivery_date_key", "actual_delivery_date_key")
OTHER_CHECKS = (
    "fact_shipment has one row per shipment",
    "date dimension has exactly one unknown member",
    "all fact date keys resolve",
    "fact row count reconciles through ship date",
)


# How a test's summed values become its failures.
COUNTED, GAP, MONEY = "counted", "gap", "money"


def _value_rows(one_row: DataFrame) -> DataFrame:
    """(test_name, value) of a one-row frame whose columns are named after tests."""
    pairs = ", ".join(f"struct('{c}' AS test_name, CAST(`{c}` AS decimal(38,6)) AS value)" for c in one_row.columns)
    return one_row.selectExpr(f"inline(array({pairs}))")


def _fact_pass(t, first_day: str, last_day: str) -> DataFrame:
    """The first pass: all checks of a row of the fact, its dates looked up in the date dimension.

    The dimension has a row a day, at most 3.7 million for the years 1 to 9999, so it is broadcast.
    """
    days = F.broadcast(t["dim_date"].where("date_key IS NOT NULL").groupBy("date_key").agg(_rows().alias("n")))
    checks = _fact_checks(first_day, last_day)
    joined = t["fact_shipment"]
    for c in (*DATE_CHECKS.values(), *DATE_KEYS):
        joined = joined.join(days.select(F.col("date_key").alias(f"_{c}"), F.col("n").alias(f"_n_{c}")),
                             F.col(c) == F.col(f"_{c}"), "left")

    def lost(c: str) -> Column:
        return F.col(f"_n_{c}").isNull()

    for name, c in DATE_CHECKS.items():
        checks[name] = count_where(F.col(c).isNotNull() & lost(c))
    any_lost = lost(DATE_KEYS[0])
    for c in DATE_KEYS[1:]:
        any_lost = any_lost | lost(c)
    checks["all fact date keys resolve"] = count_where(any_lost)
    checks["fact row count reconciles through ship date"] = _flag(
        F.coalesce(F.sum(f"_n_{DATE_KEYS[0]}"), F.lit(0)) != _rows())
    total = F.expr(KPI["total_shipments"])
    # What is shown elsewhere is added to these, so that a test's sum is the gap.
    checks |= {name: -_rows() for name in VIEW_CHECKS}
    checks |= {name: -F.coalesce(F.sum(c), F.lit(0)) for name, (_, c) in COST_CHECKS.items()}
    checks["executive shipment total reconciles to fact"] = total - _rows()
    return _value_rows(joined.agg(*[c.alias(name) for name, c in checks.items()]))


def _key_pass(t) -> DataFrame:
    """The second pass: rows by month and by each dimension key, as grouping sets.

    The counts by key, in the views' own grouping, take the views' labels: what a label join loses or
    doubles shows in the sum. The same join tells the keys that no dimension has.
    """
    fact = t["fact_shipment"].select(month_start(F.col("ship_date")).alias("month"), *[f"{d}_key" for d in DIMENSIONS])
    names = ["month", *[f"{d}_key" for d in DIMENSIONS]]
    # A row's grouping set is the only name that it keeps; the bits of the others are set.
    which = F.grouping_id().alias("bits")
    counts = fact.groupingSets([[F.col(n)] for n in names], *names).agg(which, F.expr(KPI["total_shipments"]).alias("n"))
    every = (1 << len(names)) - 1
    dim = F.expr("CASE bits " + " ".join(
        f"WHEN {every ^ (1 << len(names) - 1 - i)} THEN '{n.removesuffix('_key')}'" for i, n in enumerate(names)) + " END")
    keyed = counts.select(dim.alias("dim"), F.coalesce(*[F.col(n) for n in names[1:]]).alias("key"), "n")
    shown = {f"{d}_key": [] for d in DIMENSIONS}
    for view, (_, key, _, _) in SCORECARDS.items():
        shown[key] = card_labels(view, t)
    members = union_all([
        (shown[f"{d}_key"] or t[f"dim_{d}"].select(f"{d}_key").distinct()).select(
            F.lit(d).alias("dim"), F.col(f"{d}_key").alias("key"))
        for d in DIMENSIONS
    ]).groupBy("dim", "key").agg(_rows().alias("shown"))
    found = keyed.join(members, ["dim", "key"], "left").groupBy("dim").agg(
        F.sum(F.when(F.col("shown").isNull(), F.col("n")).otherwise(0)).alias("lost"),
        F.sum(F.col("n") * F.coalesce("shown", F.lit(1))).alias("total"),
    )
    views = {SCORECARDS[v][1].removesuffix("_key"): name for name, v in VIEW_CHECKS.items() if v in SCORECARDS}
    views["month"] = "monthly shipment totals reconcile to fact"
    arms = " ".join(f"WHEN '{d}' THEN '{name}'" for d, name in views.items())
    return found.selectExpr(
        "inline(array("
        "struct(if(dim <> 'month', concat('fact ', dim, ' keys resolve'), NULL) AS test_name, CAST(lost AS decimal(38,6)) AS value),"
        f"struct(CASE dim {arms} END AS test_name, CAST(total AS decimal(38,6)) AS value)))"
    ).where("test_name IS NOT NULL")


def _shipment_pass(t) -> DataFrame:
    """The third pass: rows and billed cost by shipment, summed up together, so without a join."""
    amounts = {a: name for name, (a, _) in COST_CHECKS.items()}
    none = [F.lit(None).cast("decimal(38,6)").alias(a) for a in amounts]
    rows = t["fact_shipment"].select("shipment_key", F.lit(1).alias("rows"), *none)
    billed = t["stg_invoices"].where("shipment_match_flag AND invoice_type = 'CARRIER_BILL'").select(
        F.col("matched_tms_shipment_id").alias("shipment_key"), F.lit(0).alias("rows"),
        *[F.col(a).cast("decimal(38,6)").alias(a) for a in amounts])
    one = rows.unionByName(billed).groupBy("shipment_key").agg(
        F.sum("rows").alias("rows"), *[F.sum(a).alias(a) for a in amounts])
    return _value_rows(one.agg(
        count_where(F.col("rows") > 1).alias("fact_shipment has one row per shipment"),
        # A bill counts once for each row of its shipment.
        *[F.coalesce(F.sum(F.col(a) * F.col("rows").cast("decimal(10,0)")), F.lit(0)).alias(name) for a, name in amounts.items()],
    ))


def _member_checks(t) -> DataFrame:
    """Unique members of the dimensions, and the one unknown date."""
    members = union_all([
        t[f"dim_{d}"].selectExpr(f"'{d}' AS dim", f"{d}_key AS key") for d in DIMENSIONS
    ]).groupBy("dim", "key").count()
    repeated = members.groupBy("dim").agg(
        count_where((F.col("count") > 1) | F.col("key").isNull()).alias("bad")
    ).selectExpr("concat('dim_', dim, ' key is unique') AS test_name", "CAST(bad AS decimal(38,6)) AS value")
    unknown = t["dim_date"].agg(
        _flag(count_where(F.col("unknown_date_flag")) != 1).alias("date dimension has exactly one unknown member"))
    return repeated.unionByName(_value_rows(unknown))


def validate_model(t, first_day: str = "2024-01-01", last_day: str = "2025-12-31") -> DataFrame:
    """The thirty-two named gates: test, severity, failure count and PASS or FAIL.

    Three passes over the fact give signed values by test; their sum is what a test judges.
    """
    kinds = {name: COUNTED for name in [
        *_fact_checks(first_day, last_day), *OTHER_CHECKS, *DATE_CHECKS,
        *[f"dim_{d} key is unique" for d in DIMENSIONS], *[f"fact {d} keys resolve" for d in DIMENSIONS],
    ]} | {name: GAP for name in VIEW_CHECKS} | {name: MONEY for name in COST_CHECKS}
    values = union_all([
        _fact_pass(t, first_day, last_day), _key_pass(t), _shipment_pass(t), _member_checks(t)
    ]).groupBy("test_name").agg(F.sum("value").alias("value"))
    wanted = listed(t["fact_shipment"].sparkSession, list(kinds.items()), "test_name string, kind string")
    failures = f"bigint(CASE kind WHEN '{MONEY}' THEN int(abs(value) > 0.01) ELSE abs(value) END)"
    return wanted.join(values, "test_name", "left").selectExpr(
        "test_name", f"coalesce({failures}, 0L) AS failure_count"
    ).selectExpr(
        "test_name",
        "'CRITICAL' AS severity",
        "failure_count",
        "if(failure_count = 0, 'PASS', 'FAIL') AS validation_status",
    )


def _severity_order() -> list[Column]:
    rank = F.when(F.col("severity") == "CRITICAL", 1).when(F.col("severity") == "WARNING", 2).otherwise(3)
    return [rank, F.col("test_name")]


def by_severity(results: DataFrame) -> DataFrame:
    """Critical tests first, then warnings, then the rest; names in order."""
    return results.orderBy(*_severity_order())


def numbered_by_severity(results: DataFrame) -> DataFrame:
    """The order of ``by_severity`` as a column; tests number in the dozens."""
    return results.select(F.row_number().over(Window.orderBy(*_severity_order())).alias("position"), "*")


def check_targets(fact_kpis: DataFrame, expected: dict[str, float], tolerance: float = 0.005) -> DataFrame:
    """Compare executive KPIs with published numbers."""
    pairs = F.array(*[
        F.struct(
            F.lit(k).alias("metric"), F.lit(float(v)).alias("expected"),
            F.col(k).cast("double").alias("actual"),
        )
        for k, v in expected.items()
    ])
    off = F.coalesce(F.abs(F.col("actual") - F.col("expected")) > tolerance, F.lit(True))
    return fact_kpis.select(F.inline(pairs)).withColumn(
        "status", F.when(off, "FAIL").otherwise("PASS")
    )
