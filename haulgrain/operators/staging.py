"""Staging tables: cleaned, typed, matched and flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain import contracts as C
from haulgrain.functions.cleaning import MONEY, bucket_by_words, typed_select
from haulgrain.functions.measures import hours_between
from haulgrain.operators.matching import (
    Rule,
    cascade_match,
    distinct_keys,
    first_in_group,
    flag_matches,
    flag_replaced,
    newest_per_key,
    rank_in_group,
    row_hash,
)


def reference(raw: DataFrame, table: str) -> DataFrame:
    """Customers, crosswalk, warehouses and carriers need cleaning only."""
    return typed_select(raw, table)


# --- shipments --------------------------------------------------------------


def shipments(raw: DataFrame) -> DataFrame:
    df = typed_select(raw, "stg_shipments")
    alive = F.coalesce(
        ~F.col("is_void") & ~F.col("shipment_status").isin(C.DEAD_STATUSES), F.lit(False)
    )
    delivery_day = F.col("actual_delivery_ts").cast("date")
    promised = F.col("promised_delivery_date")
    delivered = (F.col("shipment_status") == "DELIVERED") & delivery_day.isNotNull() & promised.isNotNull()
    df = df.withColumns({
        "base_eligible_flag": alive,
        "calculated_on_time_flag": F.when(delivered, delivery_day <= promised),
        "days_late": F.when(
            delivered, F.greatest(F.datediff(delivery_day, promised), F.lit(0)).cast("long")
        ),
    })
    df = flag_replaced(
        df, "tms_shipment_id", "parent_tms_shipment_id", "base_eligible_flag", "_replaced"
    )
    # The cut-off looks at every staged row, void ones included: one column, one row.
    ship_day = typed_select(raw, "stg_shipments").agg(F.max("ship_create_date"))
    live = F.col("base_eligible_flag") & ~F.col("_replaced")
    return df.withColumns({
        "final_live_shipment_flag": live,
        "final_on_time_flag": F.coalesce("source_on_time_flag", "calculated_on_time_flag"),
        "official_kpi_eligible_flag": F.coalesce(
            live & (F.col("ship_create_date") <= F.date_sub(ship_day.scalar(), C.KPI_LAG_DAYS)),
            F.lit(False),
        ),
    }).drop("_replaced")


def live_lookup(ships: DataFrame, key: str, *payload: str) -> DataFrame:
    """The newest live shipment for each sales order, PRO or tracking number."""
    return newest_per_key(
        ships.where("final_live_shipment_flag"),
        key,
        ["last_update_ts", "tms_shipment_id"],
        ["tms_shipment_id", *payload],
    )


def id_lookup(ships: DataFrame, *payload: str) -> DataFrame:
    """Every staged shipment id, void ones included, with its newest payload."""
    if not payload:
        return distinct_keys(ships, "tms_shipment_id")
    return newest_per_key(
        ships.withColumn("_id", F.col("tms_shipment_id")), "_id",
        ["last_update_ts", *payload], ["tms_shipment_id", *payload],
    ).drop("_id")


def crosswalk_lookup(crosswalk: DataFrame) -> DataFrame:
    """Best customer per code: primary first, then the latest start, then the greatest id."""
    return newest_per_key(
        crosswalk,
        "tms_customer_code_normalized",
        ["is_primary_mapping", "effective_from", "erp_customer_id"],
        ["erp_customer_id"],
    )


def _by_id(ships: DataFrame, key: str = "source_tms_shipment_id", *payload: str) -> Rule:
    return Rule(C.BY_SHIPMENT_ID, key, id_lookup(ships, *payload), "tms_shipment_id", "tms_shipment_id")


def _by_number(ships: DataFrame, label: str, key: str, *payload: str) -> Rule:
    return Rule(label, key, live_lookup(ships, key, *payload), key, "tms_shipment_id")


# --- lines and events -------------------------------------------------------


def clean_lines(raw: DataFrame) -> DataFrame:
    ordered, shipped = F.col("qty_ordered"), F.col("qty_shipped")
    status = (
        F.when(shipped.isNull(), "INCOMPLETE EXTRACT")
        .when((shipped < 0) | (ordered < 0), "INVALID QUANTITY")
        .when(shipped == ordered, "FULLY SHIPPED")
        .when(shipped < ordered, "SHORT SHIPPED")
        .when(shipped > ordered, "OVER SHIPPED")
        .otherwise("UNKNOWN")
    )
    return typed_select(raw, "stg_shipment_lines").withColumns({
        "line_fill_rate": F.when(ordered > 0, shipped.cast("double") / ordered),
        "quantity_status": status,
        "calculated_line_weight_lb": shipped * F.col("unit_weight_lb"),
    })


def lines(raw: DataFrame, ships: DataFrame) -> DataFrame:
    return flag_matches(
        clean_lines(raw), "tms_shipment_id", ships, "tms_shipment_id", "shipment_match_flag"
    )


def _scan_group() -> Column:
    """Delivery scans compete per shipment, all other scans per event id."""
    return F.when(
        F.col("event_code").eqNullSafe(F.lit("DLV")),
        F.concat(F.col("tms_shipment_id"), F.lit("|DLV")),
    ).otherwise(F.col("tracking_event_id"))


# The latest ingested comes first, then the latest scan.
_SCAN_ORDER = ("ingested_ts", "event_ts_utc", "tracking_event_id")


def clean_events(raw: DataFrame) -> DataFrame:
    return typed_select(raw, "stg_tracking_events")


def kept_events(raw: DataFrame) -> DataFrame:
    """The scans that survive deduplication, without the match flag.

    A hash of the row ends the order, as in the full ranking, so both keep the same scan on ties.
    """
    cleaned = clean_events(raw)
    order = [F.col(c).desc_nulls_last() for c in _SCAN_ORDER]
    return first_in_group(cleaned, _scan_group(), [*order, row_hash(cleaned)])


def events(raw: DataFrame, ships: DataFrame) -> DataFrame:
    """Every scan with its rank in its duplicate group (the latest ingested is 1)."""
    ranked = rank_in_group(
        clean_events(raw), _scan_group(), _SCAN_ORDER, "duplicate_rank"
    ).withColumns({
        "duplicate_rank": F.col("duplicate_rank").cast("long"),
        "keep_event_flag": F.col("duplicate_rank") == 1,
        "duplicate_event_flag": F.col("duplicate_rank") > 1,
    })
    return flag_matches(ranked, "tms_shipment_id", ships, "tms_shipment_id", "shipment_match_flag")


def events_dedup(raw: DataFrame, ships: DataFrame) -> DataFrame:
    kept = kept_events(raw).withColumns({
        "duplicate_rank": F.lit(1).cast("long"),
        "keep_event_flag": F.lit(True),
        "duplicate_event_flag": F.lit(False),
    })
    return flag_matches(kept, "tms_shipment_id", ships, "tms_shipment_id", "shipment_match_flag")


# --- WMS and invoices -------------------------------------------------------


def _place(df: DataFrame, table: str, front: dict[str, list[str]], tail: list[str]) -> DataFrame:
    """Contract columns in order, each of ``front``'s lists right after its column."""
    order: list[str] = []
    for name, _, _ in C.staged_columns(table):
        order.append(name)
        order += front.get(name, [])
    return df.select(*order, *tail)


def match_wms(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    return cascade_match(
        typed_select(raw, "stg_wms_outbound"),
        [_by_id(ships), _by_number(ships, C.BY_SALES_ORDER, "sales_order_id")],
        "matched_tms_shipment_id", "shipment_match_method", reread=reread,
    )


def wms(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    pick, pack, ship = (F.col(c) for c in ("pick_start_ts", "pack_complete_ts", "ship_confirm_ts"))
    df = match_wms(raw, ships, reread).withColumns({
        "pick_to_pack_hours": hours_between(pick, pack),
        "pack_to_ship_hours": hours_between(pack, ship),
        "total_warehouse_cycle_hours": hours_between(pick, ship),
        "invalid_timestamp_sequence_flag": F.coalesce(pack < pick, F.lit(False))
        | F.coalesce(ship < pack, F.lit(False)),
        "shipment_match_flag": F.col("matched_tms_shipment_id").isNotNull(),
    })
    return _place(
        df, "stg_wms_outbound",
        {"source_tms_shipment_id": ["matched_tms_shipment_id", "shipment_match_method"]},
        ["pick_to_pack_hours", "pack_to_ship_hours", "total_warehouse_cycle_hours",
         "invalid_timestamp_sequence_flag", "shipment_match_flag"],
    )


def match_invoices(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    return cascade_match(
        typed_select(raw, "stg_invoices"),
        [
            _by_id(ships),
            _by_number(ships, C.BY_SALES_ORDER, "sales_order_id"),
            _by_number(ships, C.BY_PRO_NUMBER, "pro_number"),
        ],
        "matched_tms_shipment_id", "shipment_match_method", reread=reread,
    )


def invoices(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    def amount(*names: str) -> Column:
        total = F.lit(0).cast(MONEY)
        for n in names:
            total = total + F.coalesce(F.col(n), F.lit(0).cast(MONEY))
        return total.cast(MONEY)

    freight = ("line_amount_usd", "accessorial_amount_usd", "fuel_surcharge_usd")

    def freight_if(kind: str) -> Column:
        return F.when(F.col("invoice_type") == kind, amount(*freight)).otherwise(
            F.lit(0).cast(MONEY)
        )

    df = match_invoices(raw, ships, reread).withColumns({
        "net_freight_amount_usd": amount(*freight),
        "invoice_total_usd": amount(*freight, "tax_usd"),
        "customer_revenue_usd": freight_if("CUSTOMER"),
        "carrier_cost_usd": freight_if("CARRIER_BILL"),
        "shipment_match_flag": F.col("matched_tms_shipment_id").isNotNull(),
    })
    return _place(
        df, "stg_invoices",
        {"pro_number": ["matched_tms_shipment_id", "shipment_match_method"]},
        ["net_freight_amount_usd", "invoice_total_usd", "customer_revenue_usd",
         "carrier_cost_usd", "shipment_match_flag"],
    )


# --- claims, tickets and surveys --------------------------------------------


def match_claims(raw: DataFrame, ships: DataFrame) -> DataFrame:
    delivered = "actual_delivery_ts"
    return cascade_match(
        typed_select(raw, "stg_claims"),
        [
            _by_id(ships, "source_tms_shipment_id", delivered),
            _by_number(ships, C.BY_PRO_NUMBER, "pro_number", delivered),
        ],
        "matched_tms_shipment_id", "shipment_match_method", payload=[delivered],
    )


def matched_claims(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    """Claims with their shipment alone, by the same rules: no lookup brings the delivery along."""
    return cascade_match(
        typed_select(raw, "stg_claims"),
        [_by_id(ships), _by_number(ships, C.BY_PRO_NUMBER, "pro_number")],
        "matched_tms_shipment_id", "shipment_match_method", reread=reread,
    ).withColumn("shipment_match_flag", F.col("matched_tms_shipment_id").isNotNull())


def claims(raw: DataFrame, ships: DataFrame) -> DataFrame:
    df = match_claims(raw, ships).withColumns({
        "claim_type": bucket_by_words(
            "claim_type", C.CLAIM_TYPE_WORDS, "coalesce(claim_type, 'OTHER')"
        ),
        "paid_exceeds_requested_flag": F.coalesce(
            F.col("claim_amount_paid_usd") > F.col("claim_amount_requested_usd"), F.lit(False)
        ),
        "days_delivery_to_claim": F.datediff(
            F.col("filed_date"), F.col("actual_delivery_ts").cast("date")
        ).cast("long"),
        "shipment_match_flag": F.col("matched_tms_shipment_id").isNotNull(),
    })
    return _place(
        df, "stg_claims",
        {"pro_number": ["matched_tms_shipment_id", "shipment_match_method"]},
        ["paid_exceeds_requested_flag", "days_delivery_to_claim", "shipment_match_flag"],
    )


def _tickets_by_shipment(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    return cascade_match(
        typed_select(raw, "stg_crm_tickets"),
        [_by_id(ships), _by_number(ships, C.BY_TRACKING_NUMBER, "tracking_number")],
        "matched_tms_shipment_id", "shipment_match_method", reread=reread,
    )


def match_tickets(
    raw: DataFrame, ships: DataFrame, customers: DataFrame, crosswalk: DataFrame, reread: bool = False
) -> DataFrame:
    """Two independent cascades: shipment and customer."""
    return cascade_match(
        _tickets_by_shipment(raw, ships, reread),
        customer_rules(customers, crosswalk, "source_erp_customer_id"),
        "matched_erp_customer_id", "customer_match_method",
    )


def customer_rules(customers: DataFrame, crosswalk: DataFrame, key: str) -> list[Rule]:
    code = "tms_customer_code_normalized"
    return [
        Rule(C.BY_CUSTOMER_ID, key, distinct_keys(customers, "erp_customer_id"),
             "erp_customer_id", "erp_customer_id"),
        Rule(C.BY_CROSSWALK, code, crosswalk_lookup(crosswalk), code, "erp_customer_id"),
    ]


def _ticket_facts(matched: DataFrame) -> DataFrame:
    return matched.withColumns({
        "category_normalized": bucket_by_words(
            "upper(category_raw)", C.TICKET_CATEGORY_WORDS, "'OTHER'"
        ),
        "valid_resolution_time_flag": F.coalesce(F.col("resolution_hours") >= 0, F.lit(False)),
        "shipment_match_flag": F.col("matched_tms_shipment_id").isNotNull(),
    })


def matched_tickets(raw: DataFrame, ships: DataFrame, reread: bool = False) -> DataFrame:
    """Tickets with their shipment alone: the customer, which no total by shipment reads, is not looked up."""
    return _ticket_facts(_tickets_by_shipment(raw, ships, reread))


def tickets(
    raw: DataFrame, ships: DataFrame, customers: DataFrame, crosswalk: DataFrame, reread: bool = False
) -> DataFrame:
    df = _ticket_facts(match_tickets(raw, ships, customers, crosswalk, reread)).withColumns({
        "customer_match_flag": F.col("matched_erp_customer_id").isNotNull(),
    })
    return _place(
        df, "stg_crm_tickets",
        {
            "tms_customer_code_normalized": ["matched_erp_customer_id", "customer_match_method"],
            "tracking_number": ["matched_tms_shipment_id", "shipment_match_method"],
            "category_raw": ["category_normalized"],
        },
        ["valid_resolution_time_flag", "shipment_match_flag", "customer_match_flag"],
    )


def clean_surveys(raw: DataFrame) -> DataFrame:
    csat, nps = F.col("csat_score"), F.col("nps_score")
    sent, answered = F.col("survey_sent_ts"), F.col("response_ts")
    return typed_select(raw, "stg_csat_responses").withColumns({
        "valid_csat_flag": F.coalesce(csat.between(1, 5), F.lit(False)),
        "valid_nps_flag": F.coalesce(nps.between(0, 10), F.lit(False)),
        "nps_category": F.when(nps.between(9, 10), "PROMOTER")
        .when(nps.between(7, 8), "PASSIVE")
        .when(nps.between(0, 6), "DETRACTOR")
        .otherwise("INVALID"),
        "response_days": F.when(
            answered >= sent, F.datediff(answered.cast("date"), sent.cast("date")).cast("long")
        ),
    })


def surveys(raw: DataFrame, ships: DataFrame, customers: DataFrame) -> DataFrame:
    df = flag_matches(
        clean_surveys(raw), "tms_shipment_id", ships, "tms_shipment_id", "shipment_match_flag"
    )
    return flag_matches(
        df, "erp_customer_id", customers, "erp_customer_id", "customer_match_flag"
    )
