from decimal import Decimal

import pytest

from rows import CARRIER, CUSTOMER, CROSSWALK, by_key, event, invoice, layers, line, pairs, shipment, survey

from haulgrain.operators import findings, measures, quality, segments


@pytest.fixture(scope="module")
def world(spark):
    """Independent cases, one shipment each, in one refresh."""
    return layers(
        spark,
        shared=("stg_shipments", "fact_shipment"),
        erp_customers=[
            CUSTOMER, dict(CUSTOMER, erp_customer_id="C002"),
            dict(CUSTOMER, erp_customer_id="CT", is_test_account="true"),
        ],
        customer_id_crosswalk=[
            CROSSWALK,
            dict(CROSSWALK, erp_customer_id="C002", is_primary_mapping="false", effective_from="2024-06-01"),
            dict(CROSSWALK, erp_customer_id="CT", tms_customer_code="TEST"),
        ],
        tms_shipments=[
            shipment("UNKQTY"), shipment("HALF"), shipment("NOLINES"), shipment("OVER"),
            shipment("LATE", actual_delivery_ts="2024-01-07 00:10:00"),
            shipment("TRANSIT", shipment_status="IN TRANSIT"),
            shipment("MONEY"), shipment("FAN"), shipment("SURV"),
            shipment("XWALK", erp_customer_id_ref=None, tms_customer_code=" nw 001 "),
            shipment("DIRECT", erp_customer_id_ref="C002"),
            shipment("NOCUST", erp_customer_id_ref="GHOST", tms_customer_code="??"),
            shipment("TESTACC", erp_customer_id_ref="CT"),
            shipment("TESTCODE", erp_customer_id_ref=None, tms_customer_code="test"),
            shipment("PARENT"), shipment("CHILD", parent_tms_shipment_id="PARENT"),
            shipment("VOID", is_void="true"), shipment("CANC", shipment_status="CANCELED"),
            shipment("LANE", origin_warehouse_id=None, dest_state=None, dest_postal=None),
            shipment("LANE2", dest_country="united states"), shipment("LANE3", dest_country=" us"),
            shipment("NAME", service_level_code=None), shipment("NOSVC", service_level_code=None, service_level_name=None),
            shipment("ALLUNK", mode=None, service_level_code=None, service_level_name=None,
                     origin_warehouse_id=None, dest_state=None, dest_postal=None, dest_city=None, dest_country=None,
                     carrier_id=None, ship_create_date=None, promised_delivery_date=None, actual_delivery_ts=None),
            shipment("RECENT", ship_create_date="2024-02-01"),
        ],
        tms_shipment_lines=[
            line("UNKQTY", 1, 10, 10), line("UNKQTY", 2, 10, None),
            line("HALF", 1, 10, 10), line("HALF", 2, 20, 5),
            line("OVER", 1, 10, 12), line("LATE", 1, 10, 10), line("TRANSIT", 1, 10, 10), line("RECENT", 1, 1, 1),
            line("FAN", 1, 5, 5), line("FAN", 2, 5, 5), line("FAN", 3, 5, 5, ),
        ],
        carrier_tracking_events=[
            event("E1", "FAN", "PU", "2024-01-01 09:00:00", event_ts_local="2024-01-01 08:00:00"),
            event("E2", "FAN", "DLV", "2024-01-03 09:00:00", event_ts_local="2024-01-03 08:00:00"),
            event("E3", "FAN", "DELAY", "2024-01-02 09:00:00", exception_reason="weather"),
        ],
        wms_outbound=[
            dict(wms_outbound_id="W1", tms_shipment_id="FAN", short_pick_flag="true", inventory_accuracy_snapshot="0.9"),
            dict(wms_outbound_id="W2", sales_order_id="SO-FAN", inventory_accuracy_snapshot="1.0"),
        ],
        erp_invoices=[
            invoice("M1", amount="500", tms_shipment_id="MONEY", accessorial_amount_usd="25",
                    fuel_surcharge_usd="15", tax_usd="40"),
            invoice("M2", "CARRIER_BILL", "300", tms_shipment_id="MONEY", accessorial_amount_usd="10",
                    fuel_surcharge_usd="20"),
            invoice("F1", amount="100", tms_shipment_id="FAN"), invoice("F2", amount="200", sales_order_id="SO-FAN"),
            invoice("F3", "CARRIER_BILL", "120", pro_number="PRO-FAN"),
        ],
        claims=[
            dict(claim_id="C1", tms_shipment_id="FAN", claim_amount_requested_usd="60", claim_amount_paid_usd="50"),
            dict(claim_id="C2", pro_number="PRO-FAN", claim_amount_requested_usd="5"),
        ],
        crm_tickets=[
            dict(ticket_id="T1", tms_shipment_id="FAN", severity="high", category_raw="late"),
            dict(ticket_id="T2", tracking_number="TRK-FAN", severity="low", resolution_hours="4"),
        ],
        csat_survey_responses=[
            survey("R1", "FAN", 5, 10), survey("R2", "FAN", 3, 9),
            *[survey(f"S{i}", "SURV", c, None) for i, c in enumerate([5, 3, 0, 6, None])],
            *[survey(f"N{i}", "SURV", None, n) for i, n in enumerate([10, 9, 8, 7, 6, 0, 11])],
        ],
    )


@pytest.fixture(scope="module")
def fact(world):
    return by_key(world["fact_shipment"], "shipment_key")


def test_fact_has_the_contract_columns_and_one_row_each(world, fact):
    assert len(world["fact_shipment"].columns) == 79
    assert world["fact_shipment"].count() == len(fact)


def test_only_live_non_test_shipments(fact):
    assert {"TESTACC", "TESTCODE", "PARENT", "VOID", "CANC"}.isdisjoint(fact)
    assert "CHILD" in fact


@pytest.mark.parametrize("sid, fill, otif, extra", [
    ("UNKQTY", None, None, {"missing_shipped_quantity_lines": 1}),
    ("HALF", 0.5, False, {"shipment_line_count": 2, "short_shipped_lines": 1}),
    ("NOLINES", None, None, {"shipment_line_count": 0, "total_quantity_ordered": None}),
    ("OVER", 1.2, True, {"over_shipped_lines": 1}),
    ("LATE", 1.0, False, {"days_late": 3, "final_on_time_flag": False}),
    ("TRANSIT", 1.0, None, {"final_on_time_flag": None, "days_late": None}),
])
def test_fill_rate_and_otif(fact, sid, fill, otif, extra):
    row = fact[sid]
    assert row["shipment_fill_rate"] == (None if fill is None else pytest.approx(fill))
    assert row["otif_flag"] is otif
    for column, want in extra.items():
        assert row[column] == want


def test_money(fact):
    r = fact["MONEY"]
    assert [r[c] for c in ("customer_revenue_usd", "carrier_cost_usd", "total_accessorial_usd",
                           "total_fuel_surcharge_usd", "gross_margin_usd")] == [
        Decimal(540), Decimal(330), Decimal(10), Decimal(20), Decimal(210)]
    assert r["gross_margin_percentage"] == pytest.approx(210 / 540)
    assert fact["HALF"]["customer_revenue_usd"] == 0 and fact["HALF"]["gross_margin_percentage"] is None


def test_children_do_not_fan_out(fact):
    r = fact["FAN"]
    assert [r[c] for c in ("shipment_line_count", "tracking_event_count", "wms_record_count", "invoice_count",
                           "claim_count", "ticket_count", "survey_response_count")] == [3, 3, 2, 3, 2, 2, 2]
    assert (r["customer_revenue_usd"], r["carrier_cost_usd"], r["claims_paid_usd"], r["gross_margin_usd"]) == (300, 120, 50, 130)
    assert r["shipment_fill_rate"] == 1.0 and r["tracking_exception_count"] == 1
    assert r["short_pick_flag"] is True and r["average_inventory_accuracy"] == pytest.approx(0.95)
    assert str(r["first_pickup_event_ts"]) == "2024-01-01 08:00:00"
    assert r["severe_ticket_count"] == 1 and r["late_delivery_ticket_count"] == 1
    assert r["average_resolution_hours"] == 4 and r["complaint_flag"] and r["claim_flag"]
    assert r["shipment_nps"] == 100


def test_surveys(fact):
    r = fact["SURV"]
    assert (r["survey_response_count"], r["valid_csat_response_count"], r["average_csat_score"]) == (12, 2, 4.0)
    assert (r["promoter_count"], r["passive_count"], r["detractor_count"]) == (2, 2, 2)
    none = fact["HALF"]
    assert none["survey_response_count"] == 0 and none["average_csat_score"] is None
    assert none["promoter_count"] is None


@pytest.mark.parametrize("sid, key", [("XWALK", "C001"), ("DIRECT", "C002"), ("NOCUST", "UNKNOWN"), ("MONEY", "C001")])
def test_customer_resolution(fact, sid, key):
    assert fact[sid]["customer_key"] == key


def test_keys_with_unknown_parts(world, fact):
    assert fact["LANE"]["lane_key"] == "UNKNOWN|US|UNKNOWN|Denver|UNKNOWN"
    assert fact["LANE2"]["lane_key"] == fact["LANE3"]["lane_key"] == fact["MONEY"]["lane_key"]
    assert [fact[s]["service_key"] for s in ("MONEY", "NAME", "NOSVC", "ALLUNK")] == [
        "LTL|CODE:STD", "LTL|NAME:STANDARD", "LTL|UNKNOWN", "UNKNOWN|UNKNOWN"]
    assert str(fact["ALLUNK"]["ship_date_key"]) == "1900-01-01" and fact["ALLUNK"]["carrier_key"] == "UNKNOWN"
    for dim, key in [("dim_customer", "customer_key"), ("dim_carrier", "carrier_key"), ("dim_warehouse", "warehouse_key")]:
        assert world[dim].where(f"{key} = 'UNKNOWN'").count() == 1
    services = by_key(world["dim_service"], "service_key")
    assert len(services) == world["dim_service"].count() and services["UNKNOWN|UNKNOWN"]["planned_transit_days"] is None
    assert services["LTL|NAME:STANDARD"]["service_level_code"] == "UNKNOWN"
    assert world["dim_lane"].where("lane_key = 'UNKNOWN|UNKNOWN|UNKNOWN|UNKNOWN|UNKNOWN'").count() == 1


def test_dates(world):
    days = world["dim_date"]
    rows = by_key(days.where("date_key IN (DATE'1900-01-01', DATE'1900-01-02', DATE'2024-01-06')"), "date_key")
    kinds = {str(k): (r["date_type"], r["month_name"], r["day_of_week_number"], r["weekend_flag"]) for k, r in rows.items()}
    assert kinds == {
        "1900-01-01": ("Unknown", "Unknown", 1, False), "1900-01-02": ("Filler", "January", 2, False),
        "2024-01-06": ("Actual", "January", 6, True),
    }
    assert days.where("unknown_date_flag").count() == 1


def test_all_gates_pass_on_awkward_data(world):
    gates = by_key(quality.validate_model(world), "test_name")
    assert len(gates) == 32
    assert {t for t, r in gates.items() if r["validation_status"] != "PASS"} == set()
    ordered = quality.by_severity(quality.validate_model(world)).collect()
    assert [r["test_name"] for r in ordered] == sorted(gates)


def test_views_reconcile_and_have_contract_widths(world, fact):
    widths = {"vw_executive_kpis": 27, "vw_monthly_performance": 26, "vw_carrier_scorecard": 30,
              "vw_warehouse_scorecard": 32, "vw_customer_scorecard": 31, "vw_lane_scorecard": 32}
    for view, width in widths.items():
        df = world[view]
        assert len(df.columns) == width, view
        assert df.selectExpr("sum(total_shipments) AS n").first()["n"] == len(fact), view


def test_gates_catch_broken_models(spark):
    t = layers(
        spark,
        ref_carriers=[CARRIER, CARRIER],
        tms_shipments=[shipment("A"), shipment("A"), shipment("B", carrier_id="GHOST", ship_create_date="2030-01-01")],
    )
    failed = {r["test_name"] for r in quality.validate_model(t).where("validation_status = 'FAIL'").collect()}
    assert {"fact_shipment has one row per shipment", "dim_carrier key is unique", "fact carrier keys resolve",
            "shipment dates stay within the declared 2024-2025 fixture window",
            "aggregate gross margin is positive"} <= failed


@pytest.fixture(scope="module")
def small(spark):
    return layers(
        spark,
        shared=("stg_shipments", "fact_shipment"),
        tms_shipments=[
            shipment("S1"), shipment("S2"), shipment("S9", ship_create_date="2024-01-08"),
            shipment("S4", ship_create_date="2023-11-20", actual_delivery_ts="2024-01-20 00:00:00"),
        ],
        tms_shipment_lines=[line("S1", 1, 1, 1), line("S2", 1, 1, None), line("S9", 1, 1, 1)],
        erp_invoices=[
            invoice("a", amount="100", tms_shipment_id="S1"), invoice("b", "CARRIER_BILL", "50", tms_shipment_id="S1"),
            invoice("c", amount="900", tms_shipment_id="S2"), invoice("d", "CARRIER_BILL", "800", tms_shipment_id="S2"),
        ],
        csat_survey_responses=[survey("1", "S1", 5), survey("2", "S1", 5), survey("3", "S1", 9), survey("4", "S2", 1)],
    )


def test_rates_use_their_own_denominators(small):
    k = small["vw_executive_kpis"].first()
    assert (k["otd_eligible_shipments"], k["otif_eligible_shipments"]) == (3, 1)
    assert k["on_time_delivery_rate"] == pytest.approx(2 / 3) and k["otif_rate"] == 1.0
    assert k["gross_margin_percentage"] == pytest.approx(0.15)
    assert k["average_csat_score"] == pytest.approx(11 / 3)


def test_executive_view_of_nothing_is_one_row(spark):
    t = layers(spark)
    k = t["vw_executive_kpis"].collect()
    assert len(k) == 1 and k[0]["total_shipments"] == 0 and k[0]["otif_rate"] is None
    assert k[0]["customer_revenue_usd"] is None


def test_measures_respect_and_ignore_the_date_slice(small):
    fact = small["fact_shipment"]
    s = measures.Slice(start="2024-01-01", end="2024-01-31")
    names = ["total_shipments", "shipments_with_known_ship_date", "delivered_shipments", "data_through_date"]
    r = measures.evaluate(fact, names, s=s).first()
    assert (r[0], r[1], r[2], str(r[3])) == (3, 4, 4, "2024-01-08")
    r = measures.evaluate(fact, ["total_shipments", "gross_margin_pct"], s=s).first()
    assert r["total_shipments"] == 3 and r["gross_margin_pct"] == pytest.approx(0.15)
    r = measures.evaluate(fact, names, s=measures.Slice(keep={"mode": ["FTL"]})).first()
    assert r[0] == 0 and r[3] is None
    with pytest.raises(KeyError):
        measures.evaluate(fact, ["no_such_measure"])
    assert sum(len(v) for v in measures.GROUPS.values()) == 7 + 15 + 9 + 13 + 18 + 11 + 1


def test_previous_month_is_null_across_a_gap(small):
    rows = {str(r["month_start_date"]): r for r in measures.previous_month(small["fact_shipment"]).collect()}
    assert set(rows) == {"2023-11-01", "2024-01-01"}
    assert all(r["shipments_previous_month"] is None for r in rows.values())


def test_target_statuses(small):
    rows = by_key(measures.target_status(small["fact_shipment"]), "kpi_name")
    assert len(rows) == 8
    got = {k: r["status"] for k, r in rows.items()}
    assert got["OTIF %"] == "On target" and got["On-Time Delivery %"] == "Off target"
    assert got["Claim Rate"] == "On target" and got["Net Promoter Score"] == "No data"


def test_delivery_impact(small):
    rows = by_key(findings.delivery_impact(small["fact_shipment"]), "delivery_status")
    assert rows["On time"]["csat_observations"] == 3 and rows["On time"]["average_csat_score"] == pytest.approx(11 / 3)
    assert rows["Late"]["average_csat_score"] is None and rows["Late"]["complaint_rate_vs_on_time"] is None


def test_rankings_guard_volume_and_break_ties_by_key(spark):
    card = spark.createDataFrame(
        [("b", 0.5, 10, 100), ("a", 0.5, 10, 100), ("c", 0.1, 50, 5), ("d", None, 0, 500), ("e", 0.4, 1, 100)],
        "carrier_key string, on_time_delivery_rate double, late_shipments long, otd_eligible_shipments long",
    )
    for c in ("scac carrier_legal_name primary_mode official_kpi_shipments on_time_shipments otif_eligible_shipments "
              "otif_shipments otif_rate claim_rate gross_margin_percentage").split():
        card = card.selectExpr("*", f"1 AS {c}")
    rows = findings.rank_carriers(card, minimum=100, top=2).collect()
    assert [(r["rate_rank"], r["carrier_key"]) for r in rows] == [(1, "e"), (2, "a")]


def test_segments_match_row_level_names(small):
    fact = small["fact_shipment"]
    by_label = by_key(segments.summary_by_label(fact, small, "carrier_name"), "carrier_name")
    row_level = by_key(segments.kpi_summary(segments.with_names(fact, small), ["carrier_name"]), "carrier_name")
    assert by_label.keys() == row_level.keys()
    for k in by_label:
        assert by_label[k].asDict() == row_level[k].asDict()
    lanes = by_key(segments.summary_by_lane(fact, small), "lane")
    assert list(lanes) == ["First DC → Denver, CO"]


def test_context_and_targets(small):
    context = pairs(findings.analysis_context(small["fact_shipment"]), value="value")
    assert len(context) == 19 and context["total_shipments"] == "4" and context["first_ship_date"] == "2023-11-20"
    check = by_key(quality.check_targets(small["vw_executive_kpis"], {"total_shipments": 4, "otif_shipments": 2}), "metric")
    assert (check["total_shipments"]["status"], check["otif_shipments"]["status"]) == ("PASS", "FAIL")
    counts = findings.eligibility_counts(small["vw_lane_scorecard"], small["fact_shipment"], "lane_key")
    assert set(counts.columns) == set(small["vw_lane_scorecard"].columns)


def test_shipment_360_finds_one(small):
    rows = findings.shipment_360(small["fact_shipment"], small, "S4").collect()
    assert len(rows) == 1 and rows[0]["delivery_status"] == "Late" and rows[0]["carrier_name"] == "First Trucking"
