"""The twelve raw extracts, derived from the TPC-H-like tables.

Every column is text, as in a spreadsheet extract, with the usual defects built in by
integer arithmetic on the source key: padded ids, bad dates, null and orphan references,
shared sales orders, re-tenders, duplicate scans and out-of-range scores. Each derivation
is one projection of a source table, so filters and column pruning reach its scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrain.contracts import RAW_COLUMNS
from haulgrain.sources.scans import spread

_STAMP = "yyyy-MM-dd HH:mm:ss"


def _project(df: DataFrame, table: str, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *[f"CAST({exprs.get(c, 'NULL')} AS string) AS `{c}`" for c in RAW_COLUMNS[table]]
    )


class TpchRaw:
    """Raw layer over a folder of source Parquet tables; frames are lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = spread(self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))
        return self._sources[name]

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, table)()

    def _orders(self) -> DataFrame:
        return self.source("orders").select(
            F.col("o_orderkey").alias("k"),
            F.col("o_custkey").alias("c"),
            F.col("o_orderdate").cast("date").alias("d"),
            F.col("o_orderstatus").alias("st"),
            F.col("o_totalprice").alias("price"),
        )

    def erp_customers(self) -> DataFrame:
        nation = self.source("nation").select("n_nationkey", "n_name")
        df = self.source("customer").join(
            nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).withColumnRenamed("c_custkey", "k")
        return _project(df, "erp_customers", {
            "erp_customer_id": "if(k % 7 = 0, concat('  ', 10000000 + k, ' '), string(10000000 + k))",
            "legal_name": "c_name",
            "dba_name": "if(k % 3 = 0, '', concat('DBA ', k))",
            "parent_erp_customer_id": "if(k % 10 = 9, string(10000000 + k - 1), NULL)",
            "industry": "c_mktsegment",
            "customer_status": "if(k % 5 = 0, 'inactive', ' Active ')",
            "payment_terms": "concat('NET', 30 + k % 3 * 15)",
            "credit_limit_usd": "if(k % 11 = 0, 'n/a', string(cast(c_acctbal AS decimal(18,2))))",
            "primary_bill_to_state": "lower(n_name)",
            "account_owner_email": "concat(' OWNER', k, '@EXAMPLE.COM')",
            "created_date": "CASE WHEN k % 13 = 0 THEN '01/05/2024' WHEN k % 17 = 0 THEN '2023/02/10'"
                            " WHEN k % 19 = 0 THEN '2023-03' ELSE '2023-01-15' END",
            "last_modified_ts": "if(k % 19 = 0, 'bad', '2024-06-01 10:00:00')",
            "is_test_account": "CASE WHEN k % 50 = 49 THEN 'true' WHEN k % 3 = 0 THEN NULL ELSE 'false' END",
            "notes": "if(k % 4 = 0, '  ', NULL)",
            "annual_volume_tier": "element_at(array('gold', 'silver', 'bronze'), int(k % 3 + 1))",
            "source_system": "'ERP'",
        })

    def customer_id_crosswalk(self) -> DataFrame:
        # Codes of customers 8, 17, 26, ... are missing in the primary row; every fourth has a secondary code.
        rows = self.source("customer").select(
            F.col("c_custkey").alias("k"),
            F.explode(F.array(F.lit(True), F.lit(False))).alias("main"),
        )
        return _project(rows, "customer_id_crosswalk", {
            "erp_customer_id": "if(main, 10000000 + k, 10000000 + k + 1)",
            "tms_customer_code": "CASE WHEN main AND k % 9 <> 8 THEN concat('CU-', k)"
                                 " WHEN NOT main AND k % 4 = 0 THEN concat(' cu ', k, ' ') END",
            "is_primary_mapping": "if(main, 'true', 'false')",
            "effective_from": "if(main, '2023-01-01', '2024-01-01')",
            "mapping_confidence": "if(main, 'high', 'low')",
        })

    def ref_warehouses(self) -> DataFrame:
        df = self.source("nation").withColumnRenamed("n_nationkey", "k")
        return _project(df, "ref_warehouses", {
            "warehouse_id": "concat('WH', k)",
            "wms_location_code": "concat('loc', k)",
            "warehouse_name": "concat('Warehouse ', k)",
            "city": "concat('City ', k)",
            "state": "concat('s', n_regionkey)",
            "postal_code": "lpad(string(k * 137), 5, '0')",
            "latitude": "concat(k, '.5')",
            "longitude": "concat('-', k, '.25')",
            "timezone": "'UTC'",
            "daily_outbound_capacity": "if(k % 4 = 0, concat(100 * k, '.6'), string(1000 + k))",
            "is_active": "if(k % 9 = 0, 'false', 'true')",
            "source_system": "'WMS'",
        })

    def ref_carriers(self) -> DataFrame:
        df = self.source("supplier").withColumnRenamed("s_suppkey", "k")
        return _project(df, "ref_carriers", {
            "carrier_id": "concat('CAR', k)",
            "scac": "concat('sc', k)",
            "carrier_legal_name": "s_name",
            "mode": "element_at(array('ltl', 'ftl', ' parcel '), int(k % 3 + 1))",
            "status": "if(k % 6 = 0, 'inactive', 'Active')",
            "source_system": "'TMS'",
        })

    def tms_shipments(self) -> DataFrame:
        late = "CASE k % 11 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE -1 END"
        df = self._orders().withColumns({
            "promise": F.expr("date_add(d, int(1 + k % 7))"),
            "delivered": F.expr("st <> 'O' OR k % 5 <> 0"),
        }).withColumn("arrival", F.expr(f"date_add(promise, {late})"))
        return _project(df, "tms_shipments", {
            "tms_shipment_id": "if(k % 97 = 0, concat(' TMS', k, '  '), concat('TMS', k))",
            "tms_customer_code": "if(k % 3 = 0, concat('cu ', c), concat('CU-', c))",
            "erp_customer_id_ref": "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 37 = 0 THEN 'GHOST'"
                                   " ELSE string(10000000 + c) END",
            "sales_order_id": "concat('SO', if(k % 20 = 1, k - 1, k))",
            "customer_po": "concat('PO', k)",
            "bol_number": "concat('BOL', k)",
            "pro_number": "if(k % 3 = 0, NULL, concat('PRO', k))",
            "tracking_number": "concat('TRK', k)",
            "origin_warehouse_id": "if(k % 31 = 0, NULL, concat('WH', k % 25))",
            "origin_wms_code": "concat('loc', k % 25)",
            "dest_name": "concat('Dest ', k % 100)",
            "dest_address1": "concat(k, ' Main St')",
            "dest_city": "if(k % 47 = 0, NULL, concat('City ', k % 40))",
            "dest_state": "concat('s', k % 5)",
            "dest_postal": "if(k % 29 = 0, NULL, lpad(string(k % 40), 5, '0'))",
            "dest_country": "element_at(array('USA', 'United States', ' us ', 'ca'), int(k % 4 + 1))",
            "is_residential": "if(k % 2 = 1, 'true', 'N')",
            "carrier_id": "if(k % 43 = 0, NULL, concat('CAR', k % 10))",
            "carrier_scac": "concat('sc', k % 10)",
            "mode": "element_at(array('ltl', 'ftl', ' parcel '), int(k % 10 % 3 + 1))",
            "service_level_code": "if(k % 17 = 0, NULL,"
                                  " element_at(array('std', 'exp', 'eco', 'wht'), int(k % 4 + 1)))",
            "service_level_name": "if(k % 34 = 0, NULL, element_at(array('Standard', 'Express',"
                                  " 'Economy', 'White Glove'), int(if(k % 13 = 0, k + 1, k) % 4 + 1)))",
            "planned_transit_days": "if(k % 101 = 0, 'x', string(1 + k % 7))",
            "lane_miles_est": "concat(100 + k % 1900, '.5')",
            "ship_create_date": "if(k % 29 = 0, NULL, string(d))",
            "ship_create_ts": "concat(d, ' 08:00:00')",
            "promised_delivery_date": "if(k % 59 = 0, NULL, string(promise))",
            "actual_pickup_ts": "concat(if(k % 71 = 0, date_add(d, 30), d), ' 12:00:00')",
            "actual_delivery_ts": "if(delivered AND k % 23 <> 0, concat(arrival, ' 15:30:00'), NULL)",
            "shipment_status": "CASE WHEN k % 83 = 0 THEN 'Cancelled' WHEN k % 89 = 0 THEN 'Replaced'"
                               " WHEN k % 103 = 0 THEN NULL WHEN NOT delivered THEN 'in transit'"
                               " WHEN k % 2 = 0 THEN ' delivered ' ELSE 'DELIVERED' END",
            "exception_code": "CASE WHEN k % 11 > 1 THEN NULL WHEN k % 2 = 0 THEN 'wx' ELSE 'mech' END",
            "weight_lb": "concat(k % 500, '.25')",
            "pieces": "1 + k % 20",
            "freight_class": "'70'",
            "estimated_revenue_usd": "cast(price AS decimal(18,2))",
            "estimated_cost_usd": "if(k % 3 = 0, NULL, '100.005')",
            "currency": "'usd'",
            "on_time_flag": "CASE WHEN k % 5 = 0 THEN NULL WHEN k % 19 = 0 THEN 'true'"
                            " WHEN k % 11 < 2 THEN 'false' ELSE 'true' END",
            "is_void": "CASE WHEN k % 41 = 0 THEN 'true' WHEN k % 2 = 0 THEN NULL ELSE 'false' END",
            "is_re_tender": "if(k % 53 = 0, 'true', 'false')",
            "parent_tms_shipment_id": "if(k % 53 = 0 AND k > 0, concat('TMS', k - 1), NULL)",
            "source_system": "'TMS'",
            "extract_batch_id": "concat('B', k % 3)",
            "last_update_ts": "if(k % 61 = 0, NULL, concat(date_add(d, int(k % 5)), ' 00:00:00'))",
            "row_hash": "concat('h', k)",
        })

    def tms_shipment_lines(self) -> DataFrame:
        df = self.source("lineitem").selectExpr(
            "l_orderkey AS k", "l_linenumber AS n", "l_partkey AS p", "l_suppkey AS s",
            "int(l_quantity) AS q", "l_returnflag AS rf",
        )
        return _project(df, "tms_shipment_lines", {
            "tms_shipment_id": "if(p % 211 = 0, 'GHOST', concat('TMS', k))",
            "line_number": "n",
            "sku": "concat(' sku', p)",
            "description": "concat('Part ', p)",
            "qty_ordered": "if(n = 1, concat(q, '.0'), string(q))",
            "qty_shipped": "CASE WHEN p % 40 = 0 THEN NULL WHEN p % 173 = 0 THEN '-1'"
                           " WHEN rf = 'R' AND s % 2 = 0 THEN string(q - 1)"
                           " WHEN p % 97 = 0 THEN string(q + 2) ELSE string(q) END",
            "unit_weight_lb": "concat(1 + p % 9, '.5')",
            "hazardous_flag": "CASE WHEN p % 50 = 0 THEN 'true' WHEN p % 3 = 0 THEN NULL ELSE 'false' END",
            "source_system": "'TMS'",
        })

    def carrier_tracking_events(self) -> DataFrame:
        df = self.source("events").selectExpr("event_id AS e", "ts", "event_type AS et")
        return _project(df, "carrier_tracking_events", {
            "column1": "CASE WHEN e % 127 = 0 THEN NULL WHEN e % 67 = 0 THEN concat('EV', e - 1)"
                       " ELSE concat('EV', e) END",
            "tms_shipment_id": "CASE WHEN e % 61 = 0 THEN NULL WHEN e % 59 = 0 THEN 'GHOST'"
                               " ELSE concat('TMS', e div 4) END",
            "tracking_number": "concat('TRK', e div 4)",
            "event_code": "CASE et WHEN 'view' THEN 'arr' WHEN 'signup' THEN 'PU' WHEN 'purchase'"
                          " THEN 'DLV' WHEN 'click' THEN ' delay' ELSE 'EXC' END",
            "event_description": "et",
            "event_ts_utc": f"date_format(ts, '{_STAMP}')",
            "event_ts_local": f"date_format(ts - INTERVAL '5' HOUR, '{_STAMP}')",
            "event_city": "concat('City ', e % 40)",
            "event_state": "concat('s', e % 5)",
            "exception_reason": "if(e % 13 = 0, 'weather', '')",
            "source": "if(e % 2 = 0, 'edi', 'api')",
            "ingested_ts": "if(e % 31 = 0, NULL,"
                           f" date_format(ts + make_dt_interval(0, 0, int(e % 90)), '{_STAMP}'))",
        })

    def wms_outbound(self) -> DataFrame:
        # A second pick record exists for every shipment whose number leaves 2 when split by 21;
        # every 17th names neither its order nor its shipment.
        df = self._orders().withColumn(
            "part", F.explode(F.expr("if(k % 21 = 2, array('', 'B'), array(''))"))
        )
        return _project(df, "wms_outbound", {
            "wms_outbound_id": "concat('W', k, part)",
            "wms_location_code": "concat('loc', k % 25)",
            "sales_order_id": "if(k % 14 = 5 OR k % 17 = 0, NULL, concat('SO', if(k % 20 = 1, k - 1, k)))",
            "tms_shipment_id": "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 14 = 5 THEN 'GHOST' WHEN k % 6 = 0 THEN NULL"
                               " WHEN k % 6 = 3 THEN concat('GHOST', k) ELSE concat('TMS', k) END",
            "pick_start_ts": "concat(d, ' 06:', lpad(string(k % 60), 2, '0'), ':50')",
            "pack_complete_ts": "concat(d, if(k % 27 = 0, ' 05:00:00', ' 08:30:10'))",
            "ship_confirm_ts": "if(k % 33 = 0, NULL, concat(d, ' 10:15:00'))",
            "lines_picked": "k % 9",
            "short_pick_flag": "CASE WHEN k % 12 = 1 THEN 'true' WHEN k % 2 = 0 THEN NULL ELSE 'false' END",
            "inventory_accuracy_snapshot": "if(k % 26 = 0, 'n/a', concat('0.9', k % 10))",
            "source_system": "'WMS'",
        })

    def erp_invoices(self) -> DataFrame:
        df = self._orders().withColumn(
            "cust", F.explode(F.array(F.lit(True), F.lit(False)))
        )
        return _project(df, "erp_invoices", {
            "invoice_id": "concat('I', k, if(cust, 'C', 'B'))",
            "invoice_type": "if(cust, 'customer', ' CARRIER_BILL ')",
            "erp_customer_id": "10000000 + c",
            "tms_shipment_id": "CASE WHEN k % 8 <= 4 THEN concat('TMS', k) WHEN k % 8 = 7 THEN 'GHOST' END",
            "sales_order_id": "CASE WHEN k % 8 = 5 THEN concat('SO', if(k % 20 = 1, k - 1, k))"
                              " WHEN k % 8 = 6 THEN 'NONE' END",
            "pro_number": "if(k % 8 = 6, concat('PRO', k), NULL)",
            "invoice_date": "d",
            "gl_post_date": "date_add(d, 2)",
            "line_amount_usd": "cast(if(cust, price, price * 0.6D) AS decimal(18,2))",
            "accessorial_amount_usd": "CASE WHEN k % 4 = 0 THEN '' WHEN cust THEN '15.00'"
                                      " ELSE concat(k % 50, '.10') END",
            "fuel_surcharge_usd": "if(k % 9 = 0, 'n/a', concat(k % 30, '.05'))",
            "tax_usd": "if(cust, '12.00', NULL)",
            "currency": "'usd'",
            "payment_status": "if(k % 3 = 0, 'open', 'Paid')",
            "dispute_flag": "if(k % 18 = 0, 'true', 'false')",
            "source_system": "'ERP'",
        })

    def claims(self) -> DataFrame:
        df = self._orders().withColumn("j", F.expr("k div 15"))
        return _project(df, "claims", {
            "claim_id": "concat('C', k)",
            "tms_shipment_id": "CASE WHEN j % 5 = 4 THEN 'GHOST' WHEN j % 2 = 0 THEN NULL"
                               " ELSE concat('TMS', k) END",
            "pro_number": "if(j % 5 = 4, NULL, concat('PRO', k))",
            "claim_type": "element_at(array('Concealed Damage', 'damage - visible', 'shortage', 'Loss',"
                          " 'package lost', 'theft', NULL), int(j % 7 + 1))",
            "filed_date": "if(j % 11 = 0, 'soon', string(date_add(d, 20)))",
            "claim_amount_requested_usd": "concat(100 + j % 40, '.00')",
            "claim_amount_paid_usd": "CASE j % 3 WHEN 0 THEN concat(110 + j % 40, '.00') WHEN 1 THEN NULL"
                                     " ELSE concat(50 + j % 40, '.00') END",
            "claim_status": "if(j % 2 = 0, 'open', 'Closed')",
            "carrier_id": "concat('CAR', k % 10)",
            "source_system": "'CLM'",
        })

    def crm_tickets(self) -> DataFrame:
        df = self.source("events").selectExpr(
            "event_id AS e", "ts", "user_id AS u"
        )
        return _project(df, "crm_tickets", {
            "ticket_id": "concat('T', e)",
            "opened_ts": f"date_format(ts, '{_STAMP}')",
            "erp_customer_id": "if(e % 3 = 0, string(10000000 + u), NULL)",
            "tms_customer_code": "if(e % 11 = 0, NULL, concat('cu-', u))",
            "tms_shipment_id": "if(e % 2 = 0, concat('TMS', e), NULL)",
            "tracking_number": "if(e % 10 = 9, 'NOPE', concat('TRK', e))",
            "channel": "if(e % 2 = 0, 'email', 'Phone')",
            "category_raw": "element_at(array('Late delivery', 'delay complaint', 'DAMAGED goods',"
                            " 'Partial shipment', 'lost freight', 'driver rude', 'billing issue',"
                            " 'Invoice question', NULL), int(e % 9 + 1))",
            "severity": "element_at(array('low', 'medium', 'high', 'Critical'), int(e % 4 + 1))",
            "status": "'open'",
            "subject": "concat('Subject ', e % 5)",
            "description_free_text": "'text '",
            "resolution_hours": "CASE e % 7 WHEN 0 THEN NULL WHEN 1 THEN '-5' ELSE concat(e % 72, '.5') END",
            "source_system": "'CRM'",
        })

    def csat_survey_responses(self) -> DataFrame:
        # Some shipments answered twice.
        df = self._orders().withColumn(
            "again", F.explode(F.expr("if(k % 18 = 0, array(0, 1), array(0))"))
        )
        return _project(df, "csat_survey_responses", {
            "response_id": "concat('R', k, if(again = 0, 'A', 'B'))",
            "survey_sent_ts": "concat(date_add(d, 10), ' 09:00:00')",
            "response_ts": "concat(date_add(d, int(if(k % 36 = 0, 9, 10 + k % 4))), ' 11:00:00')",
            "erp_customer_id": "if(k % 27 = 0, 'GHOST', string(10000000 + c))",
            "tms_shipment_id": "if(k % 45 = 0, 'GHOST', concat('TMS', k))",
            "csat_score_1_to_5": "if(k % 63 = 0, NULL, string((k + 3 * again) % 8 - 1))",
            "nps_score_0_to_10": "(k + 5 * again) % 13 - 1",
            "comment": "'ok '",
            "source_system": "'SRV'",
        })
