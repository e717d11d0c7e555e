"""Plans and skew: what has to hold when one key carries a third of the rows."""

import functools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rows import event, layers, shipment

from haulgrain.operators import matching, measures, quality, staging
from haulgrain.plans.layers import Layers, refresh


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.fixture
def conf(spark):
    changed = {}

    def set_(key, value):
        changed[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield set_
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def random_scans(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sid = rng.choice(["HOT", "HOT", None, "A", "B", "C"])
        code = rng.choice(["DLV", "PU"])
        eid = rng.choice([None, f"E{i}", f"E{i % 7}"])
        stamp = rng.choice([None, f"2024-01-{rng.randint(1, 5):02d} 00:00:00"])
        rows.append(event(eid, sid, code, stamp, event_ts_utc=f"2024-02-01 00:00:{i % 60:02d}", event_city=str(i)))
    return rows


def group_of(code, shipment_id, event_id):
    return (shipment_id and shipment_id + "|DLV") if code == "DLV" else event_id


def brute_ranks(rows):
    """Rank in plain Python: latest ingest, then latest event, then greatest id; nulls last."""
    groups = {}
    for r in rows:
        groups.setdefault(group_of(r["event_code"], r["tms_shipment_id"], r["column1"]), []).append(r)

    def down(v):
        return (v is not None, v or "")

    out = {}
    for members in groups.values():
        members.sort(key=lambda r: (down(r["ingested_ts"]), down(r["event_ts_utc"]), down(r["column1"])), reverse=True)
        for i, r in enumerate(members, 1):
            # Rows that tie in the order may share out their ranks in any way.
            out.setdefault((group_of(r["event_code"], r["tms_shipment_id"], r["column1"]),
                            r["column1"], r["event_ts_utc"], r["ingested_ts"]), []).append(i)
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("n, same, bucket", [(240, 0, 1_000_000), (240, 0, 10), (60, 400, 10), (60, 0, 1)])
def test_hot_groups_are_ranked_like_any_other(spark, monkeypatch, n, same, bucket):
    monkeypatch.setattr(staging, "rank_in_group", functools.partial(matching.rank_in_group, bucket_rows=bucket))
    rows = random_scans(n, 7) + [event(None, "HOT", "PU", None, event_ts_utc=None)] * same
    t = layers(spark, tms_shipments=[shipment("A")], carrier_tracking_events=rows)
    ranked = staging.events(t.raw["carrier_tracking_events"], t["stg_shipments"]).collect()
    got = {}
    for r in ranked:
        key = (group_of(r["event_code"], r["tms_shipment_id"], r["tracking_event_id"]), r["tracking_event_id"],
               r["event_ts_utc"] and str(r["event_ts_utc"]), r["ingested_ts"] and str(r["ingested_ts"]))
        got.setdefault(key, []).append(r["duplicate_rank"])
    assert {k: sorted(v) for k, v in got.items()} == brute_ranks(rows)


def test_identical_sort_keys_are_split_over_tasks(spark, conf):
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(4000).selectExpr("if(id % 8 < 6, 'hot', NULL) AS g", "int(NULL) AS ts", "id")
    ranked = matching.rank_in_group(df, F.col("g"), ["ts"], "rank", bucket_rows=50)
    rows = ranked.withColumn("task", F.spark_partition_id()).collect()
    for group, n in (("hot", 3000), (None, 1000)):
        assert sorted(r["rank"] for r in rows if r["g"] == group) == list(range(1, n + 1))
    sizes = Counter(r["task"] for r in rows)
    assert len(sizes) >= 6 and max(sizes.values()) < 1500


def test_ranking_runs_nothing_before_it_is_read(spark):
    spark.sparkContext.setJobGroup("ranking", "plans only")
    try:
        t = layers(spark, tms_shipments=[shipment("A")], carrier_tracking_events=random_scans(20, 2))
        ships = t["stg_shipments"]
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("ranking"))
        ranked = staging.events(t.raw["carrier_tracking_events"], ships)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("ranking")) == before
        assert ranked.count() == 20
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")


def test_tables_of_scans_agree_on_ties(spark, tmp_path):
    scans = [event("E", "A", "PU", "2024-01-01 00:00:00", event_ts_utc="2024-02-01 00:00:00", event_city=str(i)) for i in range(9)]
    raw = layers(spark, tms_shipments=[shipment("A")], carrier_tracking_events=scans).raw
    lazy, full = Layers(spark, raw), refresh(spark, raw, str(tmp_path / "tables"))
    kept = full["stg_tracking_events"].where("keep_event_flag").collect()
    assert len(kept) == 1
    for t in (lazy, full):
        assert [r.asDict() for r in t["stg_tracking_events_dedup"].collect()] == [r.asDict() for r in kept]
    assert lazy.child_totals("events").collect() == full.child_totals("events").collect()


def test_first_in_group_trims_groups_before_the_shuffle(spark):
    t = layers(spark, tms_shipments=[shipment("A")], carrier_tracking_events=random_scans(60, 1))
    text = plan(staging.kept_events(t.raw["carrier_tracking_events"]))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_cascade_equals_brute_force(spark):
    rng = random.Random(3)
    ids = [f"S{i}" for i in range(12)]
    child = [
        (i, rng.choice([*ids, None, "GHOST", "GHOST"]), rng.choice([None, "k1", "k2", "k9"]), rng.choice([None, "p1", "p3"]))
        for i in range(300)
    ]
    by_id, by_k, by_p = {i: i for i in ids}, {"k1": "S1", "k2": "S2"}, {"p1": "S7"}

    def lookup(d, key):
        return spark.createDataFrame(list(d.items()), f"{key} string, target string")

    df = spark.createDataFrame(child, "n int, id string, k string, p string")
    out = matching.cascade_match(
        df,
        [matching.Rule("one", "id", lookup(by_id, "key1"), "key1", "target"),
         matching.Rule("two", "k", lookup(by_k, "key2"), "key2", "target"),
         matching.Rule("three", "p", lookup(by_p, "key3"), "key3", "target")],
        "hit", "how",
    ).collect()
    assert len(out) == len(child)
    for r in out:
        want = next(((d[v], name) for name, v, d in (("one", r["id"], by_id), ("two", r["k"], by_k), ("three", r["p"], by_p))
                     if v in d), (None, "UNMATCHED"))
        assert (r["hit"], r["how"]) == want


def test_null_keys_are_spread_and_never_match(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    df = spark.range(4000).select(
        F.concat(F.lit("r"), F.col("id")).alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
    )
    keys = spark.createDataFrame([("k1", "x"), ("\u0001no key 5", "bad")], "key string, v string")
    out = matching.left_lookup(df, "k", keys, "key", v="v")
    rows = out.withColumn("part", F.spark_partition_id())
    assert rows.where("v IS NOT NULL").select("rid").collect()[0]["rid"] == "r1" and rows.count() == 4000
    per_task = [r["count"] for r in rows.where("k IS NULL").groupBy("part").count().collect()]
    assert len(per_task) == 4 and max(per_task) < 2 * min(per_task)


def test_hot_key_join_is_split_by_adaptive_execution(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    df = spark.range(60_000, numPartitions=8).select(
        F.concat(F.lit("row"), F.col("id")).alias("rid"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
    )
    keys = df.select("k").distinct()
    out = matching.flag_matches(df, "k", keys, "k", "hit")
    assert out.where("hit").count() == 60_000
    out.collect()
    assert "skew=true" in plan(out, "simple")


def test_fact_shuffles_each_side_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    t = layers(spark, tms_shipments=[shipment("A")])
    from haulgrain.operators import fact

    ships = spark.createDataFrame(t["resolved_shipments"].limit(0).collect(), t["resolved_shipments"].schema)
    ids = matching.distinct_keys(ships, "tms_shipment_id")
    children = {
        name: spark.createDataFrame(
            [], ", ".join(["tms_shipment_id string", *[f"{c.rstrip('*')} decimal(18,2)" for c in cols.split()]])
        ).groupBy("tms_shipment_id").agg(*[F.max(c.rstrip("*")).alias(c.rstrip("*")) for c in cols.split()])
        for name, cols in fact.CHILD_COLUMNS.items()
    }
    bundle = plan(fact.child_bundle(ids, children), "simple")
    # One per child aggregate and one for the ids; none for the seven joins.
    assert bundle.count("Exchange hashpartitioning") == 8 and bundle.count("SortMergeJoin") == 7
    text = plan(fact.fact_shipment(ships, ids, children), "simple")
    assert text.count("Exchange hashpartitioning") == 10 and text.count("SortMergeJoin") == 8


def test_shipments_without_an_id_or_in_copies_keep_their_rows(spark):
    from rows import line

    t = layers(
        spark,
        tms_shipments=[shipment(None), shipment(None), shipment("A"), shipment("A")],
        tms_shipment_lines=[line("A", 1, 4, 2), line(None, 1, 9, 9)],
    )
    rows = t["fact_shipment"].select("shipment_key", "shipment_line_count", "shipment_fill_rate").collect()
    assert sorted((r[0] or "", r[1], r[2]) for r in rows if r[0]) == [("A", 1, 0.5)] * 2
    assert [(r[1], r[2]) for r in rows if not r[0]] == [(0, None)] * 2


def test_slices_reach_the_scan(spark, tmp_path):
    t = layers(spark, tms_shipments=[shipment("A")])
    path = str(tmp_path / "fact")
    t["fact_shipment"].write.parquet(path)
    fact = spark.read.parquet(path)
    s = measures.Slice(keep={"mode": ["LTL"]}, start="2024-01-01", end="2024-01-31")
    text = plan(measures.evaluate(fact, ["total_shipments", "gross_margin"], s=s))
    pushed = next(x for x in text.splitlines() if "PushedFilters" in x)
    assert "ship_date" in pushed and "mode" in pushed
    schema = next(x for x in text.splitlines() if "ReadSchema" in x)
    assert "gross_margin_usd" in schema and "dest_city" not in schema


def test_core_plans_have_no_single_task_window_or_cross_product(spark):
    t = layers(spark, tms_shipments=[shipment("A")])
    for name in ("stg_shipments", "fact_shipment", "vw_lane_scorecard", "dim_service", "stg_invoices"):
        text = plan(t[name], "simple")
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "windowspecdefinition(specifiedwindowframe" not in text, name


def scanned_rows(df):
    """Rows that each file scan handed on, after row groups and pages were left out."""
    df.collect()
    top = df._jdf.queryExecution().executedPlan()
    leaves = (top.executedPlan() if top.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else top).collectLeaves()
    return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())]


def test_a_search_by_id_reads_few_rows(spark, tmp_path, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    ids = [f"TMS{i * 7919 % 6000}" for i in range(6000)]
    t = Layers(spark, None, str(tmp_path / "t"))
    fact = spark.createDataFrame([(i, "x" * 50) for i in ids], "tms_shipment_id string, note string").repartition(8, "tms_shipment_id")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "16384")
    try:
        t._write("fact_shipment", fact)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    found = spark.read.parquet(t.path("fact_shipment"))
    assert found.count() == 6000
    for key in ("TMS4", "TMS5999"):
        one = found.where(F.col("tms_shipment_id") == key)
        assert [r["tms_shipment_id"] for r in one.collect()] == [key]
        assert sum(scanned_rows(one)) < 600
    # Between the ids of every file: only the Bloom filters can tell that it is in none.
    assert sum(scanned_rows(found.where(F.col("tms_shipment_id") == "TMS30005"))) < 600
    assert sum(scanned_rows(found.where("note > 'w'"))) == 6000


def test_one_to_one_merges_check_themselves(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    right = spark.createDataFrame([("a", 1.5), (None, 2.5), ("z", 3.5)], "k string, x double")
    got = matching.merge_one_to_one(left, right, ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1, 1.5), ("b", 2, None), (None, 3, 2.5)]
    for a, b, side in ((left.union(left.limit(1)), right, "left"), (left, right.union(right), "right"),
                       (left.union(spark.createDataFrame([(None, 9)], left.schema)), right, "left")):
        with pytest.raises(Exception, match=f"{side} side is not one row a key: k="):
            matching.merge_one_to_one(a, b, ["k"]).collect()
    # The check also runs where no column of the doubled side is read.
    with pytest.raises(Exception, match="right side"):
        matching.merge_one_to_one(left, right.union(right), ["k"]).select("n").collect()
    two = matching.merge_one_to_one(left.withColumn("j", F.lit(1)), right.withColumn("j", F.lit(1)), ["k", "j"])
    assert two.columns == ["k", "n", "j", "x"] and two.where("x IS NOT NULL").count() == 2


def test_gates_read_the_fact_three_times(spark, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    t = layers(spark, shared=["stg_shipments", "fact_shipment"], tms_shipments=[shipment(f"S{i}") for i in range(5)])
    text = plan(quality.validate_model(t))
    assert text.count("fact_shipment]") == 3


def test_the_written_fact_is_searched_by_its_filters(spark):
    t = layers(spark, shared=["fact_shipment"], tms_shipments=[shipment(f"S{i}") for i in range(50)])
    fact = t["fact_shipment"]
    assert [r["tms_shipment_id"] for r in fact.where("tms_shipment_id = 'S7'").collect()] == ["S7"]
    assert sum(scanned_rows(fact.where("tms_shipment_id = 'S7x'"))) == 0
