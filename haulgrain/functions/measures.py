"""Small numeric, date and conditional-aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_true(name: str) -> Column:
    return F.col(name).eqNullSafe(F.lit(True))


def is_false(name: str) -> Column:
    return F.col(name).eqNullSafe(F.lit(False))


def ratio(a: Column, b: Column) -> Column:
    """Double quotient; null when either side is null or the divisor is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def mean_where(value: Column, cond: Column) -> Column:
    return F.avg(F.when(cond, value))


def rate_where(flag: Column, cond: Column) -> Column:
    """Share of true among rows in ``cond`` whose flag is known."""
    return F.avg(F.when(cond, flag.cast("int")))


def sum_where(value: Column, cond: Column) -> Column:
    return F.sum(F.when(cond, value))


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def hours_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, in hours; null when either is null or out of order.

    Built from date, hour and minute parts, so the session time zone plays no role.
    """
    minutes = (
        F.datediff(end.cast("date"), start.cast("date")) * 1440
        + _minute_of_day(end)
        - _minute_of_day(start)
    )
    return F.when(end >= start, minutes / F.lit(60.0))


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def weighted_csat() -> Column:
    """Mean CSAT over responses, from per-shipment averages."""
    known = (F.col("valid_csat_response_count") > 0) & F.col("average_csat_score").isNotNull()
    n = F.col("valid_csat_response_count")
    return ratio(
        F.sum(F.when(known, F.col("average_csat_score") * n)), F.sum(F.when(known, n))
    )
