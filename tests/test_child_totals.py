"""Totals by shipment look up no more than they read."""

from rows import invoice, layers, shipment
from haulgrain.operators import children

CLAIMS = [
    dict(claim_id="1", tms_shipment_id="A", claim_amount_requested_usd="10.00", claim_amount_paid_usd="4.00"),
    dict(claim_id="2", tms_shipment_id="GHOST", pro_number="PRO-A", claim_amount_requested_usd="5.00"),
    dict(claim_id="3", pro_number="PRO-B", claim_amount_paid_usd="1.50"),
    dict(claim_id="4", pro_number="NONE"),
]
TICKETS = [
    dict(ticket_id="1", tms_shipment_id="A", erp_customer_id="C001", category_raw="Late delivery", severity="Critical", resolution_hours="3"),
    dict(ticket_id="2", tracking_number="TRK-B", tms_customer_code="nw-001", category_raw="DAMAGED goods", resolution_hours="-1"),
    dict(ticket_id="3", erp_customer_id="C001"),
]


def test_claims_and_tickets_are_matched_with_their_shipment_alone(spark):
    # An id that occurs twice, and a PRO number of two live shipments.
    ships = [shipment("A"), shipment("A", last_update_ts=None), shipment("B"), shipment("C", pro_number="PRO-B", last_update_ts="2023-01-01")]
    t = layers(spark, ("stg_shipments",), tms_shipments=ships, claims=CLAIMS, crm_tickets=TICKETS, erp_invoices=[invoice("I")])
    for child, table, total in (("claims", "stg_claims", children.claim_totals), ("tickets", "stg_crm_tickets", children.ticket_totals)):
        lean = t.child_totals(child)
        found, whole = lean.collect(), total(t[table]).collect()
        assert sorted(map(str, found)) == sorted(map(str, whole)) and len(found) == 2
        plan = lean._jdf.queryExecution().optimizedPlan().toString()
        # Two rules and their answer are three joins; only the second rule looks up the newest row of a key, so the ids
        # carry no payload, and no customer is looked up.
        assert plan.count("Join LeftOuter") == 3 and sum("max_by" in x for x in plan.splitlines()) == 1
    assert {r["tms_shipment_id"]: r["claim_count"] for r in t.child_totals("claims").collect()} == {"A": 2, "B": 1}


def test_the_lookup_of_totals_carries_no_column_made_of_others(spark):
    t = layers(spark, ("stg_shipments",), tms_shipments=[shipment("A"), shipment("B", carrier_id=None)], claims=CLAIMS)
    plan = t["fact_shipment"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(plan) if "Join LeftOuter" in x and "_lk#" in x)
    carried = plan[join + 1]
    assert "tms_shipment_id#" in carried and "resolved_customer_key" in carried
    assert not any(f"AS {c}#" in carried for c in ("shipment_key", "lane_key", "service_key", "ship_date_key"))
    made = {r["shipment_key"]: (r["carrier_key"], r["lane_key"], str(r["ship_date_key"]), r["claim_count"]) for r in t["fact_shipment"].collect()}
    assert made == {"A": ("CAR1", "W01|US|CO|Denver|80202", "2024-01-01", 2), "B": ("UNKNOWN", "W01|US|CO|Denver|80202", "2024-01-01", 1)}


def test_the_lookup_of_an_answer_carries_no_key_that_is_not_read_after_it(spark):
    t = layers(spark, ("stg_shipments",), tms_shipments=[shipment("A")], claims=CLAIMS)
    plan = t.child_totals("claims")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(plan) if "Join LeftOuter" in x)
    carried, depth, outputs = plan[join + 1].split("Project [")[1], 0, [""]
    for c in carried:
        depth += (c in "([") - (c in ")]")
        outputs = [*outputs, ""] if c == "," and depth == 0 else [*outputs[:-1], outputs[-1] + c]
    names = {x.split(" AS ")[-1].split("#")[0].strip() for x in outputs}
    assert {"_lk", "claim_amount_paid_usd"} <= names and not names & {"source_tms_shipment_id", "pro_number"}
