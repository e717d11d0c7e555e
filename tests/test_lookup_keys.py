"""Lookups sort and hash by a finished key."""

from pyspark.sql import functions as F

from haulgrain.operators.matching import left_lookup


def test_lookup_key_is_a_column_of_its_own(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n long")
    lookup = spark.createDataFrame([("a", "x"), ("c", "y")], "key string, v string").groupBy("key").agg(F.max("v").alias("v"))
    found = left_lookup(rows, "concat('', k)", lookup.hint("merge"), "key", v="v")
    assert sorted((r["n"], r["v"]) for r in found.collect()) == [(1, "x"), (2, None), (3, None)]
    assert found.columns == ["k", "n", "v"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "_lk" in join and "coalesce" not in join and "concat" not in join
    assert not [line for line in plan.splitlines() if " Sort [" in line and "(" in line.split("Sort [")[1].split(" ASC")[0]]
