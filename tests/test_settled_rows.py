"""Rows whose own key is the answer are matched without a shuffle."""

import random

from pyspark.sql import functions as F

from haulgrain.operators.matching import Rule, cascade_match

IDS = [f"S{i}" for i in range(12)]


def rules(spark):
    known = spark.createDataFrame([(i, i in ("S3", "S4")) for i in IDS] + [("S5", None)], "id string, rare boolean")
    accounts = known.where("id <> 'S5' OR rare IS NULL").groupBy("id").agg(F.max("rare").alias("rare"))
    by_k = spark.createDataFrame([("k1", "S1", False), ("k2", "S3", True)], "key string, target string, rare boolean")
    return [Rule("one", "id", accounts, "id", "id"), Rule("two", "k", by_k, "key", "target")]


def rows(spark):
    rng = random.Random(5)
    keys = [(rng.choice([*IDS, None, "GHOST", "", "1:a;-"]), rng.choice([None, "k1", "k2", "k9"])) for _ in range(300)]
    return spark.createDataFrame([(i, *k, f"w{i}") for i, k in enumerate([*keys, (None, None), ("GHOST", None)])],
                                 "n int, id string, k string, wide string")


def nodes(plan):
    """Names of a plan's operators, those of subqueries left out."""
    yield plan.nodeName()
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_settled_rows_match_like_any_other(spark):
    df = rows(spark)
    got, want = (cascade_match(df, rules(spark), "hit", "how", reread=r) for r in (True, False))
    assert got.columns == want.columns
    found = got.collect()
    assert sorted(map(str, found)) == sorted(map(str, want.collect()))
    by_id = {r["n"]: r for r in found}
    for n, key, other, _ in map(tuple, df.collect()):
        hit = key if key in IDS else {"k1": "S1", "k2": "S3"}.get(other)
        assert by_id[n]["hit"] == hit and by_id[n]["how"] == ("one" if key in IDS else "two" if hit else "UNMATCHED")


def test_settled_rows_are_not_joined(spark):
    found = cascade_match(rows(spark), rules(spark), "hit", "how", reread=True)
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Union"
    settled, joined = (list(nodes(plan.children().apply(i))) for i in range(2))
    assert "Join" not in settled and "Join" in joined


def test_a_payload_is_looked_up(spark):
    found = cascade_match(rows(spark), rules(spark), "hit", "how", ["rare"], reread=True)
    assert found._jdf.queryExecution().optimizedPlan().nodeName() != "Union"
