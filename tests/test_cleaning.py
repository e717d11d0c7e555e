import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from haulgrain.functions.cleaning import RULES

CASES = [
    ("text", "  a b ", "a b"), ("text", "   ", None), ("text", "\tx", "\tx"),
    ("upper", " ab ", "AB"), ("lower", " AB@X ", "ab@x"),
    ("code", " nw 001 ", "NW001"), ("code", "nw-001", "NW001"), ("code", " - ", ""), ("code", "", ""),
    ("country", " usa ", "US"), ("country", "United States of America", "US"), ("country", "ca", "CA"),
    ("country", "", None),
    ("int", "10.7", 11), ("int", "10.5", 11), ("int", "-10.5", -11), ("int", "1e3", 1000),
    ("int", " 10 ", 10), ("int", "3000000000", None), ("int", "abc", None), ("int", "", None),
    ("double", "1.5f", None), ("double", "1d", None), ("double", " 5.5 ", 5.5), ("double", "5,5", None),
    ("double", "inf", float("inf")),
    ("money", "12.345", Decimal("12.35")), ("money", "-5.005", Decimal("-5.01")), ("money", "n/a", None),
    ("date", "2024-01-05", dt.date(2024, 1, 5)), ("date", "2024/01/05", dt.date(2024, 1, 5)),
    ("date", " 2024-1-5 ", dt.date(2024, 1, 5)), ("date", "2024", None), ("date", "2024-01", None),
    ("date", "01/05/2024", None), ("date", "2024-01-05 10:00:00", dt.date(2024, 1, 5)),
    ("date", "2024-01-05T10:00:00", dt.date(2024, 1, 5)), ("date", "2024-02-30", None),
    ("date", "2024-01-05 x", None), ("date", "20240105", None),
    ("ts", "2024-01-05", dt.datetime(2024, 1, 5)), ("ts", "2024/01/05 10:00:00", dt.datetime(2024, 1, 5, 10)),
    ("ts", "2024-01-05 10:00:00+02:00", dt.datetime(2024, 1, 5, 10)), ("ts", "2024", None),
    ("ts", "10:00:00", None), ("ts", "2024-01-05 25:00:00", None),
    ("tri", "true", True), ("tri", "Y", True), ("tri", "0", False), ("tri", " true ", None),
    ("tri", "maybe", None), ("flag", "maybe", False), ("flag", None, False), ("tri", None, None),
]


def test_every_rule(spark):
    data = [(i, value) for i, (_, value, _) in enumerate(CASES)]
    df = spark.createDataFrame(data, "i int, v string")
    for rule in RULES:
        mine = [(i, want) for i, (r, _, want) in enumerate(CASES) if r == rule]
        got = {
            r["i"]: r["o"]
            for r in df.where(F.col("i").isin([i for i, _ in mine])).select("i", F.expr(RULES[rule]("v")).alias("o")).collect()
        }
        for i, want in mine:
            assert got[i] == want, CASES[i]


@pytest.mark.parametrize("start, end, hours", [
    ("2024-01-01 08:00:59", "2024-01-01 08:01:01", 1 / 60),
    ("2024-01-01 23:30:00", "2024-01-02 00:30:00", 1.0),
    ("2024-01-01 09:00:00", "2024-01-01 08:00:00", None),
    (None, "2024-01-01 08:00:00", None),
])
def test_hours_count_minute_boundaries(spark, start, end, hours):
    from haulgrain.functions.measures import hours_between

    df = spark.createDataFrame([(start, end)], "a string, b string").select(
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in "ab"]
    )
    got = df.select(hours_between(F.col("a"), F.col("b")).alias("h")).first()["h"]
    assert got == (None if hours is None else pytest.approx(hours))
