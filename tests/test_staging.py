import pytest

from rows import (
    CROSSWALK,
    CUSTOMER,
    by_key,
    event,
    invoice,
    layers,
    pairs,
    raw_tables,
    shipment,
    survey,
)

from haulgrain import contracts as C
from haulgrain.operators import quality, staging


def test_contract_columns_are_unique_and_complete():
    for staged, raw in C.RAW_OF_STAGED.items():
        cols = C.staged_columns(staged)
        assert len({c for c, _, _ in cols}) == len(cols)
        assert {src for _, _, src in cols} <= set(C.RAW_COLUMNS[raw])
    assert sum(len(v) for v in C.RAW_COLUMNS.values()) == 169
    assert set(C.PRIMARY_KEYS) == set(C.RAW_COLUMNS)


def test_fixture_builder_rejects_unknown_names(spark):
    with pytest.raises(ValueError):
        raw_tables(spark, nothing=[])
    with pytest.raises(ValueError):
        raw_tables(spark, claims=[{"oops": 1}])


def test_missing_raw_column_is_an_error(spark):
    raw = raw_tables(spark)["ref_carriers"].drop("scac")
    with pytest.raises(ValueError, match="scac"):
        staging.reference(raw, "stg_carriers")


@pytest.fixture(scope="module")
def scans(spark):
    t = layers(
        spark,
        tms_shipments=[shipment("S1"), shipment("S2")],
        carrier_tracking_events=[
            event("E1", "S1", "DLV", "2024-01-03 10:00:00"),
            event("E2", "S1", " dlv ", "2024-01-03 12:00:00"),
            event("E3", "S1", "DLV", None),
            event("E4", "S2", "DLV", "2024-01-03 09:00:00"),
            event("E5", "S1", "PU", "2024-01-01 10:00:00"),
            event("E6", "S1", "PU", "2024-01-01 11:00:00"),
            event("E7", "S1", "ARR", "2024-01-01 11:00:00"),
            event("E8", "NOPE", "PU", "2024-01-01 11:00:00"),
            event("N1", None, "DLV", "2024-01-01 01:00:00"),
            event(None, "S1", "ARR", "2024-01-01 02:00:00"),
            event("D1", "S1", "ARR", "2024-01-01 02:00:00", event_ts_utc="2024-01-01 00:00:00"),
            event("D1", "S1", "ARR", "2024-01-01 02:00:00", event_ts_utc="2024-01-01 01:00:00"),
        ],
    )
    return t


def test_latest_delivery_scan_is_kept(scans):
    rows = by_key(scans["stg_tracking_events"].where("tracking_event_id LIKE 'E%'"), "tracking_event_id")
    assert [rows[e]["duplicate_rank"] for e in ("E2", "E1", "E3")] == [1, 2, 3]
    assert rows["E4"]["keep_event_flag"] and rows["E5"]["keep_event_flag"] and rows["E6"]["keep_event_flag"]
    assert rows["E8"]["keep_event_flag"] and not rows["E8"]["shipment_match_flag"]
    assert sum(r["duplicate_event_flag"] for r in rows.values()) == 2


def test_scans_without_a_key_share_one_group(scans):
    rows = scans["stg_tracking_events"].where(
        "tracking_event_id IS NULL OR tracking_event_id = 'N1'"
    ).orderBy("duplicate_rank").collect()
    assert [(r["tracking_event_id"], r["duplicate_rank"]) for r in rows] == [(None, 1), ("N1", 2)]


def test_dedup_table_equals_kept_rows(scans):
    kept = scans["stg_tracking_events"].where("keep_event_flag")
    dedup = scans["stg_tracking_events_dedup"]
    assert dedup.columns == kept.columns
    assert sorted(map(str, dedup.collect())) == sorted(map(str, kept.collect()))


def test_repeated_event_id_is_ranked_by_event_time(scans):
    rows = scans["stg_tracking_events"].where("tracking_event_id = 'D1'").orderBy("duplicate_rank").collect()
    assert [str(r["event_ts_utc"]) for r in rows] == ["2024-01-01 01:00:00", "2024-01-01 00:00:00"]


def test_eligibility_waits_three_days(spark):
    t = layers(spark, tms_shipments=[
        shipment("A", ship_create_date="2024-01-01"), shipment("B", ship_create_date="2024-01-07"),
        shipment("C", ship_create_date="2024-01-10", is_void="true"), shipment("D", ship_create_date=None),
    ])
    rows = by_key(t["stg_shipments"], "tms_shipment_id")
    assert [rows[k]["official_kpi_eligible_flag"] for k in "ABCD"] == [True, True, False, False]
    assert len(t["stg_shipments"].columns) == 51


def test_live_set_and_status_rules(spark):
    t = layers(spark, tms_shipments=[
        shipment("P"), shipment("K", parent_tms_shipment_id=" P "),
        shipment("Q"), shipment("L", parent_tms_shipment_id="Q", is_void="true"),
        shipment("V", is_void="yes"), shipment("X", shipment_status=" cancelled "),
        shipment("Y", shipment_status="Replaced"), shipment("N", shipment_status=None),
    ])
    live = {r["tms_shipment_id"] for r in t["stg_shipments"].where("final_live_shipment_flag").collect()}
    assert live == {"K", "Q"}


def test_on_time_source_wins_and_conflict_is_counted(spark):
    t = layers(spark, tms_shipments=[
        shipment("S1", on_time_flag="true", actual_delivery_ts="2024-01-07 01:00:00"),
        shipment("S2", shipment_status="IN TRANSIT"),
        shipment("S3", actual_delivery_ts="2024-01-04 23:59:00"),
    ])
    rows = by_key(t["stg_shipments"], "tms_shipment_id")
    assert rows["S1"]["final_on_time_flag"] is True and rows["S1"]["days_late"] == 3
    assert rows["S2"]["final_on_time_flag"] is None and rows["S2"]["days_late"] is None
    assert rows["S3"]["final_on_time_flag"] is True and rows["S3"]["days_late"] == 0
    assert pairs(quality.shipment_metrics(t))["Source and calculated on-time results conflict"] == 1


def test_invoice_cascade(spark):
    t = layers(
        spark,
        tms_shipments=[
            shipment("S1"), shipment("V", is_void="true"),
            shipment("OLD", sales_order_id="SHARED", last_update_ts="2024-01-01 00:00:00"),
            shipment("NEW", sales_order_id="SHARED", last_update_ts="2024-01-02 00:00:00"),
            shipment("NUL", sales_order_id="SHARED", last_update_ts=None),
        ],
        erp_invoices=[
            invoice("I1", tms_shipment_id="S1", sales_order_id="SHARED"),
            invoice("I2", sales_order_id="SO-S1"),
            invoice("I3", tms_shipment_id="GHOST", pro_number="PRO-S1"),
            invoice("I4", tms_shipment_id="GHOST"),
            invoice("I5", sales_order_id="SHARED"),
            invoice("I6", tms_shipment_id="V"),
            invoice("I7", sales_order_id="SO-V"),
        ],
    )
    rows = by_key(t["stg_invoices"], "invoice_id")
    got = {k: (r["matched_tms_shipment_id"], r["shipment_match_method"]) for k, r in rows.items()}
    assert got == {
        "I1": ("S1", "TMS SHIPMENT ID"), "I2": ("S1", "SALES ORDER FALLBACK"),
        "I3": ("S1", "PRO NUMBER FALLBACK"), "I4": (None, "UNMATCHED"),
        "I5": ("NEW", "SALES ORDER FALLBACK"), "I6": ("V", "TMS SHIPMENT ID"), "I7": (None, "UNMATCHED"),
    }
    assert len(t["stg_invoices"].columns) == 23


def test_wms_matching_and_durations(spark):
    t = layers(
        spark,
        tms_shipments=[shipment("S1")],
        wms_outbound=[
            dict(wms_outbound_id="W1", tms_shipment_id="S1", pick_start_ts="2024-01-01 09:00:00",
                 pack_complete_ts="2024-01-01 08:00:00", ship_confirm_ts="2024-01-01 10:00:00"),
            dict(wms_outbound_id="W2", sales_order_id="SO-S1"),
            dict(wms_outbound_id="W3", sales_order_id="NONE"),
        ],
    )
    rows = by_key(t["stg_wms_outbound"], "wms_outbound_id")
    assert [rows[k]["shipment_match_method"] for k in ("W1", "W2", "W3")] == [
        "TMS SHIPMENT ID", "SALES ORDER FALLBACK", "UNMATCHED"]
    w1 = rows["W1"]
    assert w1["invalid_timestamp_sequence_flag"] and w1["pick_to_pack_hours"] is None
    assert w1["total_warehouse_cycle_hours"] == 1.0 and w1["pack_to_ship_hours"] == 2.0
    assert not rows["W2"]["invalid_timestamp_sequence_flag"]


def test_claims_and_tickets(spark):
    t = layers(
        spark,
        tms_shipments=[shipment("S1")],
        claims=[
            dict(claim_id="C1", tms_shipment_id="S1", claim_type="concealed damage", filed_date="2024-01-10",
                 claim_amount_requested_usd="10", claim_amount_paid_usd="11"),
            dict(claim_id="C2", pro_number="PRO-S1", claim_type="Lost in transit", filed_date="2024-01-01"),
            dict(claim_id="C3", claim_type="theft"), dict(claim_id="C4"),
        ],
        crm_tickets=[
            dict(ticket_id="T1", tms_shipment_id="S1", erp_customer_id="C001", category_raw="late delivery - damaged"),
            dict(ticket_id="T2", tracking_number="TRK-S1", tms_customer_code=" nw 001", category_raw="Missing items",
                 resolution_hours="-1"),
            dict(ticket_id="T3", erp_customer_id="GHOST", category_raw="hello", resolution_hours="0"),
        ],
    )
    claims = by_key(t["stg_claims"], "claim_id")
    assert [claims[c]["claim_type"] for c in ("C1", "C2", "C3", "C4")] == ["CONCEALED DAMAGE", "LOSS", "THEFT", "OTHER"]
    assert claims["C1"]["days_delivery_to_claim"] == 7 and claims["C1"]["paid_exceeds_requested_flag"]
    assert claims["C2"]["shipment_match_method"] == "PRO NUMBER FALLBACK"
    assert claims["C2"]["days_delivery_to_claim"] == -2
    tickets = by_key(t["stg_crm_tickets"], "ticket_id")
    assert [tickets[c]["category_normalized"] for c in ("T1", "T2", "T3")] == [
        "DAMAGE", "SHORTAGE / PARTIAL DELIVERY", "OTHER"]
    assert tickets["T2"]["customer_match_method"] == "CUSTOMER CROSSWALK"
    assert tickets["T2"]["shipment_match_method"] == "TRACKING NUMBER FALLBACK"
    assert tickets["T3"]["customer_match_method"] == "UNMATCHED"
    assert [tickets[c]["valid_resolution_time_flag"] for c in ("T1", "T2", "T3")] == [False, False, True]


def test_surveys_and_a_duplicated_parent_does_not_fan_out(spark):
    t = layers(
        spark,
        tms_shipments=[shipment("S1"), shipment("S1", ship_create_date="2024-01-02")],
        csat_survey_responses=[survey("R1", "S1", 5, 10), survey("R2", "GHOST", 0, 11), survey("R3", "S1", None, 7)],
    )
    rows = by_key(t["stg_csat_responses"], "response_id")
    assert len(rows) == 3 and t["stg_csat_responses"].count() == 3
    assert [rows[r]["nps_category"] for r in ("R1", "R2", "R3")] == ["PROMOTER", "INVALID", "PASSIVE"]
    assert [rows[r]["valid_csat_flag"] for r in ("R1", "R2", "R3")] == [True, False, False]
    assert [rows[r]["shipment_match_flag"] for r in ("R1", "R2", "R3")] == [True, False, True]


def test_line_statuses(spark):
    from rows import line

    cases = {"1": (10, None, "INCOMPLETE EXTRACT"), "2": (10, -1, "INVALID QUANTITY"), "3": (10, 10, "FULLY SHIPPED"),
             "4": (10, 4, "SHORT SHIPPED"), "5": (10, 12, "OVER SHIPPED"), "6": (None, 5, "UNKNOWN"),
             "7": (-1, 5, "INVALID QUANTITY")}
    t = layers(spark, tms_shipments=[shipment("S1")],
               tms_shipment_lines=[line("S1", n, o, s) for n, (o, s, _) in cases.items()] + [line("X", "9", 1, 1)])
    rows = by_key(t["stg_shipment_lines"], "line_number")
    assert {str(n): r["quantity_status"] for n, r in rows.items() if n != 9} == {n: c[2] for n, c in cases.items()}
    assert rows[4]["line_fill_rate"] == pytest.approx(0.4) and not rows[9]["shipment_match_flag"]


def test_crosswalk_prefers_primary_then_latest(spark):
    t = layers(
        spark,
        erp_customers=[CUSTOMER, dict(CUSTOMER, erp_customer_id="C002")],
        customer_id_crosswalk=[
            CROSSWALK,
            dict(CROSSWALK, erp_customer_id="C002", is_primary_mapping="false", effective_from="2024-06-01"),
            dict(tms_customer_code="Z9", erp_customer_id="C001", effective_from="2023-01-01"),
            dict(tms_customer_code="z-9", erp_customer_id="C002", effective_from="2024-01-01"),
            dict(tms_customer_code="Z 9", erp_customer_id="C003"),
        ],
    )
    best = by_key(staging.crosswalk_lookup(t["stg_customer_crosswalk"]), "tms_customer_code_normalized")
    assert best["NW001"]["erp_customer_id"] == "C001" and best["Z9"]["erp_customer_id"] == "C002"
