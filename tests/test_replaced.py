"""Replaced rows are found without a shuffle of the rows that are not."""

from pyspark.sql import functions as F

from haulgrain.operators.matching import flag_replaced, may_occur


def test_only_rows_that_may_be_replaced_are_joined(spark):
    rows = spark.createDataFrame(
        [("a", None, True, "1"), ("b", "a", True, "2"), ("c", "b", False, "3"), (None, None, True, "4"),
         ("b", "zz", None, "5"), ("d", "", True, "6"), ("", "d", True, "7")],
        "id string, parent string, counts boolean, wide string")
    found = flag_replaced(rows, "id", "parent", "counts", "replaced")
    assert sorted((r["wide"], r["replaced"]) for r in found.collect()) == [
        ("1", True), ("2", False), ("3", False), ("4", False), ("5", False), ("6", True), ("7", True)]
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    stays, joined = (plan.children().apply(i).toString() for i in range(2))
    assert "wide" in stays and "Join" not in stays and "Join" in joined


def test_the_map_misses_no_key(spark):
    some = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    every = spark.range(200000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    hit = every.where(may_occur(every, "k", some, "k"))
    assert hit.where("id < 3000").count() == 3000
    # A hash in 2^25: some 18 of the other keys.
    assert hit.where("id >= 3000").count() < 200
