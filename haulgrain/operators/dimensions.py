"""Conformed dimensions, each with an explicit Unknown member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.contracts import UNKNOWN, UNKNOWN_DATE


def known(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN))


def service_key() -> Column:
    """mode|CODE:code, mode|NAME:name or mode|UNKNOWN."""
    level = (
        F.when(
            F.col("service_level_code").isNotNull(),
            F.concat(F.lit("CODE:"), F.col("service_level_code")),
        )
        .when(
            F.col("service_level_name").isNotNull(),
            F.concat(F.lit("NAME:"), F.col("service_level_name")),
        )
        .otherwise(F.lit(UNKNOWN))
    )
    return F.concat_ws("|", known("mode"), level)


def lane_key() -> Column:
    return F.concat_ws(
        "|",
        *[
            known(c)
            for c in ("origin_warehouse_id", "dest_country", "dest_state", "dest_city", "dest_postal")
        ],
    )


def date_key(day: Column) -> Column:
    return F.coalesce(day, F.lit(UNKNOWN_DATE).cast("date"))


def with_unknown(dim: DataFrame, **values) -> DataFrame:
    """Append one constant member; columns not named are null."""
    member = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(member)


def dim_customer(customers: DataFrame) -> DataFrame:
    attrs = (
        "legal_name dba_name parent_erp_customer_id industry customer_status payment_terms "
        "credit_limit_usd primary_bill_to_state account_owner_email annual_volume_tier"
    ).split()
    dim = customers.where(~F.col("is_test_account")).select(
        F.col("erp_customer_id").alias("customer_key"), "erp_customer_id", *attrs
    )
    return with_unknown(
        dim, customer_key=UNKNOWN, erp_customer_id=UNKNOWN, legal_name="Unknown Customer",
        industry=UNKNOWN, customer_status=UNKNOWN, annual_volume_tier=UNKNOWN,
    )


def dim_carrier(carriers: DataFrame) -> DataFrame:
    dim = carriers.select(
        F.col("carrier_id").alias("carrier_key"), "carrier_id", "scac", "carrier_legal_name",
        F.col("mode").alias("primary_mode"), "carrier_status",
    )
    return with_unknown(
        dim, carrier_key=UNKNOWN, carrier_id=UNKNOWN, carrier_legal_name="Unknown Carrier",
        primary_mode=UNKNOWN, carrier_status=UNKNOWN,
    )


def dim_warehouse(warehouses: DataFrame) -> DataFrame:
    attrs = [c for c in warehouses.columns if c not in ("warehouse_id", "source_system")]
    dim = warehouses.select(F.col("warehouse_id").alias("warehouse_key"), "warehouse_id", *attrs)
    return with_unknown(
        dim, warehouse_key=UNKNOWN, warehouse_id=UNKNOWN, warehouse_name="Unknown Warehouse",
        is_active=False,
    )


def dim_service(ships: DataFrame) -> DataFrame:
    """One row per service of the live shipments, with its commonest labels.

    Shipments are first counted per distinct label and transit time, so the second step
    handles as many rows as there are combinations, not shipments.
    """
    parts = ["service_key", "mode"]
    labels = ["service_level_code", "service_level_name"]
    combos = (
        ships.where("final_live_shipment_flag")
        .select(
            service_key().alias("service_key"), known("mode").alias("mode"),
            *[known(c).alias(c) for c in labels], "planned_transit_days",
        )
        .groupBy(*parts, *labels, "planned_transit_days")
        .count()
    )
    dim = combos.groupBy(*parts).agg(
        F.percentile("planned_transit_days", F.lit(0.5), F.col("count")).alias("median_days")
    )
    for label in labels:
        # Ties go to the label that sorts first.
        counted = combos.groupBy(*parts, label).agg(F.sum("count").alias("n"))
        peak = counted.groupBy(*parts).agg(F.max("n").alias("n"))
        best = counted.join(peak, [*parts, "n"]).groupBy(*parts).agg(F.min(label).alias(label))
        dim = dim.join(best, parts)
    dim = dim.where(F.col("service_key") != f"{UNKNOWN}|{UNKNOWN}").select(
        *parts, *labels, F.round("median_days").cast("int").alias("planned_transit_days")
    )
    return with_unknown(
        dim, service_key=f"{UNKNOWN}|{UNKNOWN}", mode=UNKNOWN,
        service_level_code=UNKNOWN, service_level_name=UNKNOWN,
    )


def dim_lane(ships: DataFrame) -> DataFrame:
    return (
        ships.where("final_live_shipment_flag")
        .select(
            lane_key().alias("lane_key"),
            known("origin_warehouse_id").alias("origin_warehouse_id"),
            known("dest_state").alias("destination_state"),
            known("dest_city").alias("destination_city"),
            known("dest_postal").alias("destination_postal"),
            known("dest_country").alias("destination_country"),
        )
        .distinct()
    )


def dim_date(ships: DataFrame) -> DataFrame:
    """Every day from the Unknown date to the latest ship, promise or delivery date."""
    bounds = ships.agg(
        F.min("ship_create_date").alias("first_ship"),
        F.max(
            F.greatest(
                "ship_create_date", "promised_delivery_date",
                F.col("actual_delivery_ts").cast("date"),
            )
        ).alias("last_day"),
    )
    unknown = F.lit(UNKNOWN_DATE).cast("date")
    days = bounds.where("last_day IS NOT NULL").select(
        "first_ship",
        F.explode(F.sequence(unknown, F.col("last_day"))).alias("date_key"),
    )
    d = F.col("date_key")
    is_unknown = d == unknown
    weekday = F.dayofweek(d) - 1
    return days.select(
        d,
        F.when(is_unknown, "Unknown").when(d < F.col("first_ship"), "Filler")
        .otherwise("Actual").alias("date_type"),
        is_unknown.alias("unknown_date_flag"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month_number"),
        F.when(is_unknown, "Unknown").otherwise(F.date_format(d, "MMMM")).alias("month_name"),
        F.when(is_unknown, "Unknown").otherwise(F.date_format(d, "yyyy-MM")).alias("year_month"),
        F.weekofyear(d).alias("week_number"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        weekday.isin(0, 6).alias("weekend_flag"),
    )


def date_labels(dim: DataFrame) -> DataFrame:
    """Sort and label columns of the date dimension."""
    quarter = F.concat(F.lit("Q"), F.col("quarter"))
    return dim.withColumns({
        "year_month_sort": F.col("year") * 100 + F.col("month_number"),
        "quarter_label": quarter,
        "year_quarter": F.concat(F.col("year"), F.lit(" "), quarter),
    })


def lane_labels(dim: DataFrame) -> DataFrame:
    return dim.withColumn(
        "lane_label",
        F.concat(
            F.col("origin_warehouse_id"), F.lit(" → "), F.col("destination_city"),
            F.lit(", "), F.col("destination_state"),
        ),
    )
