"""Profiles and business-rule checks of the raw tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain import contracts as C
from haulgrain.functions.cleaning import cleaned
from haulgrain.functions.measures import count_where


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def listed(spark, rows, schema: str) -> DataFrame:
    """A short fixed list of what a report must show even when nothing was counted."""
    return spark.createDataFrame(rows, schema)


def row_hash(df: DataFrame) -> list[Column]:
    """128 bits of a row's columns as text, as h1 and h2.

    A hash goes over nulls as if they were not there, so each value is followed by whether it is null.
    """
    parts = []
    for c in df.columns:
        text = F.col(f"`{c}`").cast("string")
        parts += [text, text.isNull()]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")]


def _named(tables: list[str]) -> Column:
    """Name of a table by its place: an aggregate over all tables holds a number, not a name, in each of its keys."""
    return F.get(F.array(*[F.lit(t) for t in tables]), "place").alias("table_name")


def key_counts(raw, tables) -> DataFrame:
    """Rows per table and key value, for all tables in one aggregation.

    The parts of a key are columns of their own, null beyond a table's last: a list takes half as much memory again.
    """
    tables = list(tables)
    width = max(len(C.PRIMARY_KEYS[t]) for t in tables)
    parts = [f"k{i}" for i in range(width)]
    keys = []
    for i, t in enumerate(tables):
        own = [f"string(`{c}`)" for c in C.PRIMARY_KEYS[t]]
        own += ["string(NULL)"] * (width - len(own))
        keys.append(raw[t].selectExpr(f"{i} AS place", *[f"{x} AS {k}" for x, k in zip(own, parts)]))
    length = F.get(F.array(*[F.lit(len(C.PRIMARY_KEYS[t])) for t in tables]), "place")
    return union_all(keys).groupBy("place", *parts).count().select(
        _named(tables), F.slice(F.array(*parts), F.lit(1), length).alias("key"), "count",
    ).withColumn("complete", F.expr("NOT exists(key, k -> k IS NULL)"))


def profile_tables(raw, tables=tuple(C.RAW_COLUMNS), file_bytes: dict[str, int] | None = None):
    """Rows, columns, fully duplicated rows (all copies counted) and duplicate key groups.

    Copies are found by the rows' hashes, so no row leaves its task as text.
    """
    tables = list(tables)
    frames = {t: raw[t] for t in tables}
    copies = union_all([
        df.select(F.lit(i).alias("place"), *row_hash(df)) for i, df in enumerate(frames.values())
    ]).groupBy("place", "h1", "h2").count().groupBy("place").agg(
        F.sum("count").alias("row_count"),
        F.sum(F.when(F.col("count") > 1, F.col("count"))).alias("fully_duplicated_rows"),
    ).withColumn("table_name", _named(tables)).drop("place")
    groups = key_counts(raw, tables).groupBy("table_name").agg(
        count_where(F.col("complete") & (F.col("count") > 1)).alias("duplicate_key_groups")
    )
    spark = frames[tables[0]].sparkSession
    wanted = listed(
        spark, [(t, len(df.columns), (file_bytes or {}).get(t)) for t, df in frames.items()],
        "table_name string, column_count long, file_bytes long",
    )
    out = wanted.join(copies, "table_name", "left").join(groups, "table_name", "left")
    measured = ["row_count", "column_count", "fully_duplicated_rows", "duplicate_key_groups"]
    return out.selectExpr(
        "table_name", *[f"coalesce({c}, 0L) AS {c}" for c in measured],
        *(["file_bytes"] if file_bytes is not None else []),
    )


_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def _column_kind(name: str, dtype) -> str:
    if dtype.typeName() in _NUMERIC:
        return "number"
    return "time" if name.endswith(("_date", "_ts")) else "text"


def _column_values(df: DataFrame, table: str) -> DataFrame:
    """Nulls, range and sample of each column, side by side in one aggregate of a few numbers and texts."""
    names = df.columns
    cells, measures, rows = [], [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema.fields):
        kind = _column_kind(f.name, f.dataType)
        cells.append(F.col(f"`{f.name}`").cast("string").alias(f"v{i}"))
        edges = [F.lit(None).cast("string")] * 2
        if kind != "text":
            # Parsed once for both ends of the range.
            cells.append(cleaned("double" if kind == "number" else "ts", f.name).alias(f"e{i}"))
            measures += [F.min(f"e{i}").alias(f"low{i}"), F.max(f"e{i}").alias(f"high{i}")]
            edges = [F.col(f"{edge}{i}") for edge in ("low", "high")]
            edges = [F.date_format(e, "yyyy-MM-dd HH:mm:ss") if kind == "time" else e.cast("string") for e in edges]
        measures += [F.count(f"v{i}").alias(f"filled{i}"), F.min(F.substring(f"v{i}", 1, 100)).alias(f"sample{i}")]
        rows.append(F.struct(
            F.lit(i).alias("place"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("row_count"), (F.col("n") - F.col(f"filled{i}")).alias("null_count"),
            edges[0].alias("low"), edges[1].alias("high"), F.col(f"sample{i}").alias("sample")))
    if not names:
        raise ValueError(f"{table} has no columns")
    return df.select(*cells).agg(*measures).select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def _distinct_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Distinct values of every column of every table: 128 bits of each value, distinct before the shuffle.

    The hashes are columns of their own, put below each other by ``stack``: a list of structs is built and filtered
    outside of generated code. The place counts on from table to table, so no key holds a name.
    """
    hashes, names, first = [], [], 0
    for t, df in frames.items():
        cells = []
        for i, c in enumerate(df.columns):
            text = F.col(f"`{c}`").cast("string")
            cells += [F.xxhash64(text).alias(f"h{i}"), F.when(text.isNotNull(), F.xxhash64(F.lit(1), text)).alias(f"g{i}")]
        below = ", ".join(f"{first + i}, h{i}, g{i}" for i in range(len(df.columns)))
        hashes.append(df.select(*cells).selectExpr(f"stack({len(df.columns)}, {below}) AS (at, h1, h2)").where("h2 IS NOT NULL"))
        names += [F.struct(F.lit(t).alias("table_name"), F.lit(i).alias("place")) for i in range(len(df.columns))]
        first += len(df.columns)
    counted = union_all(hashes).distinct().groupBy("at").agg(F.count(F.lit(1)).alias("distinct_count"))
    return counted.select(F.get(F.array(*names), "at").alias("column"), "distinct_count").select("column.*", "distinct_count")


def profile_columns(raw, tables=tuple(C.RAW_COLUMNS)) -> DataFrame:
    """Type, nulls, distinct values, range and a sample per column of every table.

    One aggregate a table holds the columns side by side; for the distinct counts only hashes of the
    values are shuffled. Ranges are given for numbers, and for text whose name ends in _date or _ts.
    """
    frames = {t: raw[t] for t in tables}
    found = union_all([_column_values(df, t) for t, df in frames.items()])
    return found.join(_distinct_counts(frames), ["table_name", "place"], "left").selectExpr(
        "table_name", "column_name", "data_type", "row_count", "null_count",
        "coalesce(round(try_divide(null_count, row_count) * 100, 2), 0D) AS null_percentage",
        "coalesce(distinct_count, 0L) AS distinct_count",
        "coalesce(low, '') AS minimum_value",
        "coalesce(high, '') AS maximum_value",
        "coalesce(sample, '') AS sample_value",
    )


def duplicate_keys(raw, tables=tuple(C.RAW_COLUMNS)) -> DataFrame:
    """Duplicate key values with their counts; each table fills only its own key columns."""
    all_keys = list(dict.fromkeys(k for keys in C.PRIMARY_KEYS.values() for k in keys))

    def spread(k: str) -> str:
        arms = " ".join(
            f"WHEN '{t}' THEN key[{C.PRIMARY_KEYS[t].index(k)}]" for t in tables if k in C.PRIMARY_KEYS[t]
        )
        return f"CASE table_name {arms} END AS {k}" if arms else f"string(NULL) AS {k}"

    names = " ".join(f"WHEN '{t}' THEN '{' + '.join(C.PRIMARY_KEYS[t])}'" for t in tables)
    return key_counts(raw, tables).where("complete AND count > 1").selectExpr(
        "table_name", f"CASE table_name {names} END AS key_columns", "count AS duplicate_count",
        *[spread(k) for k in all_keys],
    )


# --- business checks --------------------------------------------------------

# Check names, severities and descriptions.
KEY_CHECKS = [
    ("Null primary keys", "High", "Primary-key fields should not be null."),
    ("Duplicate primary keys", "High", "Primary-key values should be unique."),
]
REFERENCES = [
    ("tms_shipments", "tms_customer_code", "customer_id_crosswalk", "tms_customer_code",
     "Unmatched TMS customer codes", "High", "TMS customer codes should match the customer crosswalk."),
    ("tms_shipments", "erp_customer_id_ref", "erp_customers", "erp_customer_id",
     "Unmatched ERP customer references", "High", "ERP customer references should match ERP_Customers."),
    ("tms_shipments", "carrier_id", "ref_carriers", "carrier_id",
     "Unmatched carriers", "High", "Shipment carrier IDs should match Ref_Carriers."),
    ("tms_shipments", "origin_warehouse_id", "ref_warehouses", "warehouse_id",
     "Unmatched warehouses", "High", "Origin warehouse IDs should match Ref_Warehouses."),
] + [
    (child, "tms_shipment_id", "tms_shipments", "tms_shipment_id", "Unmatched tms_shipment_id",
     "Medium", "Non-null shipment IDs should match TMS_Shipments.")
    for child in ("tms_shipment_lines", "carrier_tracking_events", "claims", "crm_tickets",
                  "csat_survey_responses")
]


def _row_checks() -> dict[str, list[tuple[str, Column, str, str]]]:
    """Checks that one conditional count per table answers."""
    picked, delivered = cleaned("ts", "actual_pickup_ts"), cleaned("ts", "actual_delivery_ts")
    ordered, shipped = cleaned("double", "qty_ordered"), cleaned("double", "qty_shipped")
    asked, paid = (cleaned("double", f"claim_amount_{c}_usd") for c in ("requested", "paid"))
    csat, nps = cleaned("double", "csat_score_1_to_5"), cleaned("double", "nps_score_0_to_10")
    no_id = F.col("tms_shipment_id").isNull()
    return {
        "tms_shipments": [
            ("Delivery before pickup", delivered < picked, "High",
             "Actual delivery cannot occur before actual pickup."),
            ("Delivered shipments missing delivery date",
             (F.upper("shipment_status") == "DELIVERED") & delivered.isNull(), "High",
             "Delivered shipments should normally have an actual delivery timestamp."),
        ],
        "wms_outbound": [
            ("Missing TMS shipment ID", no_id, "Medium",
             "Use sales_order_id as the controlled fallback match."),
        ],
        "erp_invoices": [
            ("Missing TMS shipment ID", no_id, "Medium",
             "Use sales order and PRO number as controlled fallbacks."),
        ],
        "tms_shipment_lines": [
            ("Missing shipped quantity", shipped.isNull(), "Medium",
             "Missing shipped quantity should remain null, not zero."),
            ("Negative quantity", (ordered < 0) | (shipped < 0), "High",
             "Ordered and shipped quantities cannot be negative."),
            ("Shipped quantity above ordered quantity", shipped > ordered, "Low",
             "Overshipments are possible but should be reviewed."),
        ],
        "claims": [
            ("Paid claim above requested amount", paid > asked, "High",
             "Paid claim amount should not exceed requested amount."),
        ],
        "csat_survey_responses": [
            ("Invalid CSAT score", (csat < 1) | (csat > 5), "High", "CSAT must be between 1 and 5."),
            ("Invalid NPS score", (nps < 0) | (nps > 10), "High",
             "NPS responses must be between 0 and 10."),
        ],
    }


def _row_check_counts(raw) -> list[DataFrame]:
    frames = []
    for t, checks in _row_checks().items():
        one = raw[t].agg(*[count_where(cond).alias(f"c{i}") for i, (_, cond, _, _) in enumerate(checks)])
        rows = ", ".join(f"struct('{name}' AS check_name, c{i} AS issue_count)" for i, (name, *_) in enumerate(checks))
        frames.append(one.selectExpr(f"'{t}' AS table_name", f"inline(array({rows}))"))
    return frames


def _orphan_counts(raw) -> DataFrame:
    """Child rows whose normalised reference is no parent's; null references do not count.

    All references are counted per value in one aggregation before the anti join, so a hot
    value is one row, and each parent's keys are gathered once.
    """
    refs = union_all([
        raw[child].select(
            F.lit(child).alias("table_name"), F.lit(check).alias("check_name"),
            F.lit(f"{parent}.{key}").alias("parent"), cleaned("upper", column).alias("ref"),
        )
        for child, column, parent, key, check, *_ in REFERENCES
    ]).where("ref IS NOT NULL").groupBy("table_name", "check_name", "parent", "ref").count()
    known = union_all([
        raw[parent].select(F.lit(f"{parent}.{key}").alias("parent"), cleaned("upper", key).alias("ref"))
        for parent, key in dict.fromkeys((p, k) for _, _, p, k, *_ in REFERENCES)
    ]).where("ref IS NOT NULL").distinct()
    return refs.join(known, ["parent", "ref"], "left_anti").groupBy("table_name", "check_name").agg(
        F.sum("count").alias("issue_count")
    )


def _key_check_counts(raw) -> DataFrame:
    return key_counts(raw, C.PRIMARY_KEYS).groupBy("table_name").agg(
        F.sum(F.when(~F.col("complete"), F.col("count"))).alias("nulls"),
        count_where(F.col("complete") & (F.col("count") > 1)).alias("repeats"),
    ).selectExpr(
        "table_name",
        f"inline(array(struct('{KEY_CHECKS[0][0]}' AS check_name, nulls AS issue_count),"
        f" struct('{KEY_CHECKS[1][0]}' AS check_name, repeats AS issue_count)))",
    )


SCAN_CHECK = (
    "Duplicate delivery events", "Medium", "Keep the event with the latest ingestion timestamp."
)


def _repeat_scan_counts(raw) -> DataFrame:
    table = "carrier_tracking_events"
    scans = raw[table].where(
        (cleaned("upper", "event_code") == "DLV") & F.col("tms_shipment_id").isNotNull()
    )
    return scans.groupBy("tms_shipment_id", "event_code").count().agg(
        F.sum(F.col("count") - 1).alias("issue_count")
    ).select(F.lit(table).alias("table_name"), F.lit(SCAN_CHECK[0]).alias("check_name"), "issue_count")


def business_checks(raw) -> DataFrame:
    """Every quality check as one row: table, check, status, count, severity, description."""
    counts = union_all([
        _key_check_counts(raw), _orphan_counts(raw), *_row_check_counts(raw), _repeat_scan_counts(raw)
    ])
    checks = [
        *[(t, *check) for t in C.PRIMARY_KEYS for check in KEY_CHECKS],
        *[(child, *check) for child, _, _, _, *check in REFERENCES],
        *[(t, name, sev, text) for t, found in _row_checks().items() for name, _, sev, text in found],
        ("carrier_tracking_events", *SCAN_CHECK),
    ]
    # A check over an empty table has no count; it lists as zero issues.
    wanted = listed(
        counts.sparkSession, checks,
        "table_name string, check_name string, severity string, description string",
    )
    return wanted.join(counts, ["table_name", "check_name"], "left").selectExpr(
        "table_name", "check_name",
        "if(coalesce(issue_count, 0) = 0, 'Pass', 'Issue') AS status",
        "coalesce(issue_count, 0L) AS issue_count", "severity", "description",
    )
