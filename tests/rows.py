"""Hand-made raw rows. Every value is text and omitted columns are null."""

from haulgrain.contracts import RAW_COLUMNS
from haulgrain.plans.layers import Layers

CUSTOMER = dict(erp_customer_id="C001", legal_name="Customer One", customer_status="ACTIVE",
                is_test_account="false")
CROSSWALK = dict(erp_customer_id="C001", tms_customer_code="NW-001", is_primary_mapping="true",
                 effective_from="2023-01-01")
WAREHOUSE = dict(warehouse_id="W01", warehouse_name="First DC", city="Chicago", state="IL",
                 is_active="true")
CARRIER = dict(carrier_id="CAR1", scac="ABCD", carrier_legal_name="First Trucking", mode="LTL",
               status="ACTIVE")


def shipment(sid, **over):
    """Shipped 1 January, promised the 4th, delivered the 3rd."""
    row = dict(
        tms_shipment_id=sid, tms_customer_code="NW-001", erp_customer_id_ref="C001",
        sales_order_id=f"SO-{sid}", pro_number=f"PRO-{sid}", tracking_number=f"TRK-{sid}",
        origin_warehouse_id="W01", dest_city="Denver", dest_state="CO", dest_postal="80202",
        dest_country="USA", carrier_id="CAR1", mode="LTL", service_level_code="STD",
        service_level_name="Standard", planned_transit_days="3", ship_create_date="2024-01-01",
        promised_delivery_date="2024-01-04", actual_pickup_ts="2024-01-01 12:00:00",
        actual_delivery_ts="2024-01-03 15:00:00", shipment_status="DELIVERED", is_void="false",
        last_update_ts="2024-01-05 00:00:00",
    )
    row.update(over)
    return row


def line(sid, n, ordered, shipped, **over):
    return dict(tms_shipment_id=sid, line_number=n, qty_ordered=ordered, qty_shipped=shipped,
                hazardous_flag="false", **over)


def event(eid, sid, code, ingested, **over):
    return dict(column1=eid, tms_shipment_id=sid, event_code=code, ingested_ts=ingested, **over)


def invoice(iid, kind="CUSTOMER", amount="100", **over):
    row = dict(invoice_id=iid, invoice_type=kind, line_amount_usd=amount, dispute_flag="false")
    row.update(over)
    return row


def survey(rid, sid, csat=None, nps=None, **over):
    return dict(response_id=rid, tms_shipment_id=sid, csat_score_1_to_5=csat,
                nps_score_0_to_10=nps, **over)


def raw_tables(spark, **tables):
    """All twelve raw frames; unknown tables or columns are errors."""
    unknown = set(tables) - set(RAW_COLUMNS)
    if unknown:
        raise ValueError(f"unknown raw tables: {sorted(unknown)}")
    tables.setdefault("erp_customers", [CUSTOMER])
    tables.setdefault("customer_id_crosswalk", [CROSSWALK])
    tables.setdefault("ref_warehouses", [WAREHOUSE])
    tables.setdefault("ref_carriers", [CARRIER])
    out = {}
    for name, columns in RAW_COLUMNS.items():
        rows = tables.get(name, [])
        for row in rows:
            extra = set(row) - set(columns)
            if extra:
                raise ValueError(f"{name} has no column(s) {sorted(extra)}")
        data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in columns) for r in rows]
        schema = ", ".join(f"`{c}` string" for c in columns)
        out[name] = spark.createDataFrame(data, schema)
    return out


def layers(spark, shared=(), **tables):
    return Layers(spark, raw_tables(spark, **tables), shared=shared)


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def pairs(df, key="metric", value="metric_value"):
    return {r[key]: r[value] for r in df.collect()}
