import datetime as dt
import hashlib
import os

import pytest

from rows import invoice, line, raw_tables, shipment

from haulgrain import contracts as C
from haulgrain.operators import profiling, release
from haulgrain.plans.layers import refresh
from haulgrain.sources import landing, lineage, publish
from haulgrain.sources.scans import scan


@pytest.mark.parametrize("name, want", [
    ("lastUpdateTS", "last_update_ts"), ("TMSShipmentID", "tms_shipment_id"), ("Ship To (City)", "ship_to_city"),
    ("dest_address1", "dest_address1"), ("CSAT Score 1-to-5", "csat_score_1_to_5"), ("  ", ""), ("é!", ""),
])
def test_snake_case(name, want):
    assert landing.snake_case(name) == want


def test_blank_and_colliding_names_are_errors(spark):
    with pytest.raises(ValueError, match="collide"):
        landing.normalize_columns(spark.createDataFrame([(1, 2)], "`Ship ID` int, ship_id int"))
    with pytest.raises(ValueError, match="no letters"):
        landing.normalize_columns(spark.createDataFrame([(1, 2)], "`--` int, a int"))


def test_identifiers_land_as_text(spark):
    df = spark.createDataFrame(
        [(123.0, "ABC.0", 7, True, 1.5), (123.5, None, None, None, None)],
        "order_id double, sku string, zip_code int, source boolean, weight double",
    )
    out = landing.preserve_text(df)
    assert [tuple(r) for r in out.collect()] == [("123", "ABC.0", "7", "True", 1.5), ("123.5", None, None, None, None)]
    assert landing.is_text_name("pro_number") and not landing.is_text_name("weight_lb")


def test_landing_csv_and_json(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Carrier ID,SCAC\n001,ab\n002,\n")
    (tmp_path / "b.json").write_text('{"claimID": 5, "amount": 2.5}\n')
    out = str(tmp_path / "raw")
    manifest = landing.land_extracts(
        spark, {"ref_carriers": str(tmp_path / "a.csv"), "claims": str(tmp_path / "b.json")}, out)
    assert {(r[0], r[1], r[2]) for r in manifest.collect()} == {("ref_carriers", 2, 2), ("claims", 1, 2)}
    raw = landing.LandedRaw(spark, out)
    assert sorted(r["carrier_id"] for r in raw["ref_carriers"].collect()) == ["001", "002"]
    assert raw["claims"].first().asDict() == {"amount": 2.5, "claim_id": "5"}
    assert scan(spark, f"{out}/claims", ["claim_id"]).columns == ["claim_id"]


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('ticketID,amount,note\nT1,123.0,"He said ""late"", twice"\nT2,,"two\nlines, one field"\nT3,5,\\n\n')
    got = landing.read_extract(spark, str(tmp_path / "t.csv")).collect()
    assert [tuple(r) for r in got] == [
        ("T1", "123.0", 'He said "late", twice'), ("T2", None, "two\nlines, one field"), ("T3", "5", "\\n")]


@pytest.mark.parametrize("row", ["T1,1", "T1,1,a,b"])
def test_csv_rows_of_a_wrong_length_are_errors(spark, tmp_path, row):
    (tmp_path / "t.csv").write_text(f"id,n,note\n{row}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        landing.read_extract(spark, str(tmp_path / "t.csv")).collect()


def test_lineage_ignores_order_and_layout(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "string(id % 7) AS v")
    a, b, c = (str(tmp_path / x) for x in "abc")
    df.coalesce(1).write.parquet(a)
    df.orderBy("v").repartition(3).write.parquet(b)
    df.selectExpr("id", "if(id = 5, 'x', v) AS v").write.parquet(c)
    rows = {r["table_name"]: r for r in lineage.load_lineage(spark, {"a": a, "b": b, "c": c}).collect()}
    assert rows["a"]["fingerprint"] == rows["b"]["fingerprint"] != rows["c"]["fingerprint"]
    assert rows["b"]["row_count"] == 100 and rows["b"]["column_count"] == 2 and rows["b"]["file_count"] == 3
    assert rows["a"]["source_bytes"] == sum(
        os.path.getsize(f"{a}/{f}") for f in os.listdir(a) if f.endswith(".parquet"))


def test_file_digests(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"hello")
    (tmp_path / "y.bin").write_bytes(b"h" * 100)
    (tmp_path / "z.gz").write_bytes(b"ab" * 9_000_000)  # more than a block
    rows = {os.path.basename(r["path"]): r for r in lineage.file_digests(spark, str(tmp_path)).collect()}
    for name, content in (("x.bin", b"hello"), ("y.bin", b"h" * 100), ("z.gz", b"ab" * 9_000_000)):
        assert rows[name]["sha256"] == hashlib.sha256(content).hexdigest() and rows[name]["length"] == len(content)


def test_publish_switches_only_after_every_table_verified(spark, tmp_path):
    folder = str(tmp_path / "out")
    one = {"a": spark.range(3), "b": spark.range(2)}
    run = publish.publish(one, folder, ["a", "b"])
    assert publish.current_run(spark, folder) == run

    class Broken(dict):
        def __getitem__(self, name):
            if name == "b":
                raise RuntimeError("source failed")
            return super().__getitem__(name)

    with pytest.raises(RuntimeError):
        publish.publish(Broken(a=spark.range(9)), folder, ["a", "b"])
    assert publish.read_published(spark, folder, "a").count() == 3
    second = publish.publish({"a": spark.range(5), "b": spark.range(1)}, folder, ["a", "b"])
    assert publish.current_run(spark, folder) == second and publish.read_published(spark, folder, "a").count() == 5
    assert [(r["table_name"], r["row_count"], r["columns"]) for r in publish.manifest(spark, folder).collect()] == [
        ("a", 5, ["id"]), ("b", 1, ["id"])]


def test_exports_compute_each_table_once(spark, tmp_path):
    """A table is computed by its write alone: the accumulator sees every row once."""
    rows = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    df = spark.range(0, 50, 1, 3).mapInArrow(seen, "id long")
    assert publish.export_table(df, str(tmp_path / "t")) == 50 and rows.value == 50
    assert publish.export_table(df.where("id < 0"), str(tmp_path / "none")) == 0
    spark.range(1).write.parquet(str(tmp_path / "taken"))
    with pytest.raises(Exception, match="(?i)exist"):
        publish.export_table(df, str(tmp_path / "taken"))


def test_vacuum_keeps_what_readers_use(spark, tmp_path):
    folder = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.current_run(spark, folder)
    runs = [os.path.basename(publish.publish({"a": spark.range(n)}, folder, ["a"])) for n in (1, 2, 3)]

    class Failing(dict):
        def __getitem__(self, name):
            if name == "b":
                raise RuntimeError("source failed")
            return super().__getitem__(name)

    with pytest.raises(RuntimeError):
        publish.publish(Failing(a=spark.range(9)), folder, ["a", "b"])
    left = set(os.listdir(f"{folder}/runs"))
    failed = (left - set(runs)).pop()
    assert publish.vacuum(spark, folder, keep=2) == [runs[0]]  # the failed run may still be at work
    assert set(os.listdir(f"{folder}/runs")) == {runs[1], runs[2], failed}
    assert publish.vacuum(spark, folder, keep=1, unfinished_hours=0.0) == sorted([runs[1], failed])
    assert publish.read_published(spark, folder, "a").count() == 3
    assert os.path.basename(publish.publish({"a": spark.range(4)}, folder, ["a"])) not in left
    assert publish.read_published(spark, folder, "a").count() == 4
    os.remove(f"{folder}/commits/{4:012d}/_SUCCESS")  # a commit that never finished is not read
    assert publish.read_published(spark, folder, "a").count() == 3
    with pytest.raises(ValueError):
        publish.vacuum(spark, folder, keep=0)


def test_report_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "report")
    publish.write_report(spark.createDataFrame([(1, 'a "b", c\nd')], "n int, note string"), path, ["note", "n", "missing"])
    assert [tuple(r) for r in landing.read_extract(spark, path, "csv").collect()] == [('a "b", c\nd', "1", None)]

    def fails(batches):
        raise RuntimeError("source failed")
        yield

    with pytest.raises(Exception, match="source failed"):
        publish.write_report(spark.range(3).mapInArrow(fails, "n long"), path, ["n"])
    assert publish.report_header(spark, path) == ["note", "n", "missing"]
    publish.write_report(spark.range(3).withColumnRenamed("id", "n"), path, ["n"])
    assert publish.report_header(spark, path) == ["n"] and spark.read.csv(path, header=True).count() == 3


def test_empty_report_keeps_its_header(spark, tmp_path):
    path = str(tmp_path / "report")
    publish.write_report(spark.createDataFrame([], "a string, b int, c int"), path, ["b", "a"])
    assert publish.report_header(spark, path) == ["b", "a"]
    none = raw_tables(spark)
    publish.write_report(profiling.duplicate_keys(none), path, ["table_name", "duplicate_count"])
    assert publish.report_header(spark, path) == ["table_name", "duplicate_count"]
    assert spark.read.option("header", True).csv(path).count() == 0


def test_release_end_to_end(spark, tmp_path):
    """Land, refresh, export, report and validate; then break one thing and see it named."""
    raw = raw_tables(
        spark,
        tms_shipments=[shipment("A"), shipment("B", ship_create_date="2024-02-01")],
        tms_shipment_lines=[line("A", 1, 1, 1)],
        erp_invoices=[invoice("i", tms_shipment_id="A")],
    )
    files = {t: str(tmp_path / "raw" / t) for t in C.RAW_COLUMNS}
    for t, path in files.items():
        raw[t].write.parquet(path)
    landed = landing.LandedRaw(spark, str(tmp_path / "raw"))
    recorded = lineage.load_lineage(spark, files)
    recorded.write.parquet(str(tmp_path / "lineage"))
    recorded = spark.read.parquet(str(tmp_path / "lineage"))
    t = refresh(spark, landed, str(tmp_path / "tables"))
    published = str(tmp_path / "published")
    publish.publish(t, published)
    reports = {
        "duplicate_keys": profiling.duplicate_keys(landed),
        "data_quality_issues": profiling.business_checks(landed),
    }
    for name, df in reports.items():
        publish.write_report(df, str(tmp_path / "reports" / name), df.columns)
    results = profiling.union_all([
        release.source_checks(landed, recorded, spark, files),
        release.model_checks(t, "2024-01-01", "2025-12-31"),
        release.export_checks(t, spark, published),
        release.report_checks(spark, [str(tmp_path / "reports" / n) for n in reports]),
    ])
    assert results.count() == 24 + 13 + 1 + 33 + 13 + 2
    release.require_all(results)
    raw["claims"].union(spark.createDataFrame([tuple("x" for _ in C.RAW_COLUMNS["claims"])], raw["claims"].schema)) \
        .write.mode("overwrite").parquet(files["claims"])
    with pytest.raises(RuntimeError, match="raw.claims source lineage"):
        release.require_all(release.source_checks(landed, recorded, spark, files))


def test_profiles_of_a_small_table(spark):
    raw = raw_tables(spark, claims=[
        dict(claim_id="C1", filed_date="2024-01-05"), dict(claim_id="C1", filed_date="2024-01-05"),
        dict(claim_id="C2", filed_date="soon"), dict(claim_id=None),
    ])
    p = profiling.profile_tables(raw, ["claims"]).first()
    assert (p["row_count"], p["fully_duplicated_rows"], p["duplicate_key_groups"], p["column_count"]) == (4, 2, 1, 11)
    cols = {r["column_name"]: r for r in profiling.profile_columns(raw, ["claims"]).collect()}
    assert list(C.COLUMN_PROFILE_COLUMNS) == profiling.profile_columns(raw, ["claims"]).columns
    assert (cols["claim_id"]["null_count"], cols["claim_id"]["null_percentage"], cols["claim_id"]["distinct_count"]) == (1, 25.0, 2)
    assert cols["filed_date"]["minimum_value"] == "2024-01-05 00:00:00" and cols["filed_date"]["sample_value"] == "2024-01-05"
    empty = {r["column_name"]: r for r in profiling.profile_columns(raw, ["crm_tickets"]).collect()}
    assert len(empty) == 14 and empty["ticket_id"]["null_percentage"] == 0 and empty["ticket_id"]["row_count"] == 0
    typed = spark.createDataFrame([(3, dt.date(2024, 1, 1)), (10, None)], "pieces int, ship_date date")
    cols = {r["column_name"]: r for r in profiling.profile_columns({"t": typed}, ["t"]).collect()}
    assert (cols["pieces"]["minimum_value"], cols["pieces"]["maximum_value"]) == ("3.0", "10.0")
    sized = profiling.profile_tables(raw, ["claims"], {"claims": 99})
    assert sized.columns == C.TABLE_PROFILE_COLUMNS and sized.first()["file_bytes"] == 99


def test_rows_that_differ_in_where_a_value_or_null_stands_are_no_copies(spark):
    claims = [dict(claim_id="a"), dict(pro_number="a"), dict(claim_id="a", pro_number=""), dict(claim_id="a")]
    raw = raw_tables(spark, claims=claims, tms_shipment_lines=[line("A", 1, 1, 1)] * 3)
    rows = {r["table_name"]: r for r in profiling.profile_tables(raw, ["claims", "tms_shipment_lines"]).collect()}
    assert [rows["claims"][c] for c in ("row_count", "fully_duplicated_rows", "duplicate_key_groups")] == [4, 2, 1]
    assert [rows["tms_shipment_lines"][c] for c in ("row_count", "fully_duplicated_rows", "duplicate_key_groups")] == [3, 3, 1]
    hashed = raw["claims"].select(*profiling.row_hash(raw["claims"]))
    assert [f.dataType.typeName() for f in hashed.schema] == ["long", "long"]
    assert hashed.distinct().count() == hashed.select("h1").distinct().count() == hashed.select("h2").distinct().count() == 3


def test_key_counts_group_by_short_columns(spark):
    lines = [line("A", 1, 1, 1), line("A", 1, 2, 2), line(None, 1, 1, 1), line("B", None, 1, 1)]
    raw = raw_tables(spark, claims=[dict(claim_id="A"), dict(claim_id="A"), dict(claim_id=None)], tms_shipment_lines=lines)
    counts = profiling.key_counts(raw, ["claims", "tms_shipment_lines"])
    found = {(r["table_name"], tuple(r["key"])): (r["count"], r["complete"]) for r in counts.collect()}
    assert found == {
        ("claims", ("A",)): (2, True), ("claims", (None,)): (1, False), ("tms_shipment_lines", ("A", "1")): (2, True),
        ("tms_shipment_lines", (None, "1")): (1, False), ("tms_shipment_lines", ("B", None)): (1, False)}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    # A number and the parts of the key: no name of a table, no list.
    grouped = next(x for x in plan.splitlines() if "Aggregate" in x)
    assert "Aggregate [place#" in grouped and ", k0#" in grouped and "table_name" not in grouped.split("]")[0]


def test_distinct_counts_are_made_in_generated_code(spark):
    raw = raw_tables(spark, claims=[dict(claim_id="A", pro_number="A"), dict(claim_id="B", pro_number="A"), dict(claim_id=None)],
                     tms_shipment_lines=[line("A", 1, 1, 1), line("A", 2, 1, 1)])
    counts = profiling._distinct_counts({t: raw[t] for t in ("claims", "tms_shipment_lines")})
    found = {(r["table_name"], C.RAW_COLUMNS[r["table_name"]][r["place"]]): r["distinct_count"] for r in counts.collect()}
    assert found[("claims", "claim_id")] == 2 and found[("claims", "pro_number")] == 1
    assert found[("tms_shipment_lines", "tms_shipment_id")] == 1 and found[("tms_shipment_lines", "line_number")] == 2
    # A lambda over a list of structs is not compiled.
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "stack(" in plan


def test_business_checks_shape(spark):
    raw = raw_tables(spark, tms_shipments=[shipment("A"), shipment("B", carrier_id="GHOST")],
                     tms_shipment_lines=[line("a", 1, 1, 2), line("ZZ", 1, -1, 1)])
    df = profiling.business_checks(raw)
    rows = {(r["table_name"], r["check_name"]): r for r in df.collect()}
    assert len(rows) == 44 and df.columns == C.QUALITY_ISSUE_COLUMNS
    assert rows["tms_shipments", "Unmatched carriers"]["issue_count"] == 1
    assert rows["tms_shipment_lines", "Unmatched tms_shipment_id"]["issue_count"] == 1
    assert rows["tms_shipment_lines", "Negative quantity"]["status"] == "Issue"
    assert rows["tms_shipment_lines", "Shipped quantity above ordered quantity"]["issue_count"] == 2
    assert rows["claims", "Null primary keys"]["status"] == "Pass"
