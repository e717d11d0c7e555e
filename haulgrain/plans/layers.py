"""Raw, staging and mart tables by name.

Tables are lazy DataFrames, built on first use. The few that many others read are written
once as Parquet to the shared folder and read back: that cuts lineage, survives lost
executors and lets each reader scan only its own columns.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

from haulgrain import contracts
from haulgrain.operators import children, dimensions, fact, kpis, staging
from haulgrain.operators.matching import distinct_keys
from haulgrain.session import run_folder, shuffles_removed, tune

SHARED = ("stg_shipments", "fact_shipment")
# Tables that are searched by an id. Each file is sorted by it and has a Bloom filter of it, so a search
# opens footers and reads the pages of the few row groups that may hold the id. The rows stay in the
# partitions that the last join left them in: a range layout would cost one more shuffle and prune no more.
SEARCHED = {"fact_shipment": "tms_shipment_id"}

STAGING = [*contracts.STAGED_COLUMNS, "stg_tracking_events_dedup"]
MART = (
    "dim_date dim_customer dim_carrier dim_warehouse dim_service dim_lane fact_shipment"
).split()
VIEWS = [e for e in contracts.EXPORTS if e.startswith("vw_")]


class Layers:
    def __init__(
        self,
        spark: SparkSession,
        raw,
        root: str | None = None,
        shared: Collection[str] = SHARED,
    ):
        """``raw`` maps raw table names to DataFrames; ``shared`` tables get written."""
        tune(spark)
        self.spark, self.raw, self.shared = spark, raw, set(shared)
        self._root = root
        self._built: dict[str, DataFrame] = {}

    @property
    def root(self) -> str:
        if self._root is None:
            self._root = run_folder(self.spark)
        return self._root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._build(name)
            if name in self.shared:
                self._write(name, df)
                df = self.spark.read.schema(df.schema).parquet(self.path(name))
            self._built[name] = df
        return self._built[name]

    def _write(self, name: str, df: DataFrame) -> None:
        options = {"compression": "zstd"}
        if key := SEARCHED.get(name):
            df = df.sortWithinPartitions(key)
            options |= {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").options(**options).parquet(self.path(name))

    def _build(self, name: str) -> DataFrame:
        if name.startswith("vw_"):
            return kpis.view(name, self)
        if name.startswith("dim_"):
            return self._dimension(name)
        if name == "fact_shipment":
            totals = {c: self.child_totals(c) for c in fact.CHILD_COLUMNS}
            live = self["stg_shipments"].where("final_live_shipment_flag")
            ids = distinct_keys(live, "tms_shipment_id")
            return fact.fact_shipment(self["resolved_shipments"], ids, totals)
        if name == "resolved_shipments":
            return fact.resolve_customers(
                self["stg_shipments"], self["stg_customers"], self["stg_customer_crosswalk"]
            )
        return self._staging(name)

    def _staging(self, name: str) -> DataFrame:
        raw = self.raw
        if name == "stg_shipments":
            return staging.shipments(raw["tms_shipments"])
        if name in ("stg_customers", "stg_customer_crosswalk", "stg_warehouses", "stg_carriers"):
            return staging.reference(raw[contracts.RAW_OF_STAGED[name]], name)
        ships = self["stg_shipments"]
        if name == "stg_shipment_lines":
            return staging.lines(raw["tms_shipment_lines"], ships)
        if name == "stg_tracking_events":
            return staging.events(raw["carrier_tracking_events"], ships)
        if name == "stg_tracking_events_dedup":
            if self._written("stg_tracking_events"):
                return self["stg_tracking_events"].where("keep_event_flag")
            return staging.events_dedup(raw["carrier_tracking_events"], ships)
        if name == "stg_wms_outbound":
            return staging.wms(raw["wms_outbound"], ships, self.reread)
        if name == "stg_invoices":
            return staging.invoices(raw["erp_invoices"], ships, self.reread)
        if name == "stg_claims":
            return staging.claims(raw["claims"], ships)
        if name == "stg_crm_tickets":
            return staging.tickets(
                raw["crm_tickets"], ships, self["stg_customers"], self["stg_customer_crosswalk"], self.reread
            )
        if name == "stg_csat_responses":
            return staging.surveys(raw["csat_survey_responses"], ships, self["stg_customers"])
        raise KeyError(name)

    def _dimension(self, name: str) -> DataFrame:
        source = {
            "dim_customer": "stg_customers",
            "dim_carrier": "stg_carriers",
            "dim_warehouse": "stg_warehouses",
        }.get(name, "stg_shipments")
        return getattr(dimensions, name)(self[source])

    def _written(self, name: str) -> bool:
        return name in self.shared

    @property
    def reread(self) -> bool:
        """May matching read the shipments some times over? Only where they are a written table."""
        return self._written("stg_shipments")

    def child_totals(self, child: str) -> DataFrame:
        """One of the seven per-shipment aggregates behind the fact.

        Lines, scans and surveys of unknown shipments drop out in the fact join anyway, so
        unless their staging table is written they are aggregated straight from the
        cleaned rows, without the join that only sets the match flag. Claims and tickets are
        matched with their shipment alone in that case: no total reads the rest.
        """
        raw = self.raw
        if child == "lines":
            source = (
                self["stg_shipment_lines"] if self._written("stg_shipment_lines")
                else staging.clean_lines(raw["tms_shipment_lines"])
            )
            return children.line_totals(source)
        if child == "events":
            source = (
                self["stg_tracking_events"].where("keep_event_flag")
                if self._written("stg_tracking_events")
                else staging.kept_events(raw["carrier_tracking_events"])
            )
            return children.event_totals(source)
        if child == "surveys":
            source = (
                self["stg_csat_responses"] if self._written("stg_csat_responses")
                else staging.clean_surveys(raw["csat_survey_responses"])
            )
            return children.survey_totals(source)
        if child == "claims":
            source = (
                self["stg_claims"] if self._written("stg_claims")
                else staging.matched_claims(raw["claims"], self["stg_shipments"], self.reread)
            )
            return children.claim_totals(source)
        if child == "tickets":
            source = (
                self["stg_crm_tickets"] if self._written("stg_crm_tickets")
                else staging.matched_tickets(raw["crm_tickets"], self["stg_shipments"], self.reread)
            )
            return children.ticket_totals(source)
        table, total = {
            "wms": ("stg_wms_outbound", children.wms_totals),
            "invoices": ("stg_invoices", children.invoice_totals),
        }[child]
        return total(self[table])


def refresh(spark: SparkSession, raw, root: str) -> Layers:
    """Full batch refresh: every staging and mart table written under ``root``."""
    layers = Layers(spark, raw, root, shared=[*STAGING, *MART])
    for name in [*STAGING, *MART]:
        layers[name]
    return layers
