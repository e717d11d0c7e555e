"""Plain and column-pruned scans."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """Parquet scan; with columns named, only those are read from the files."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


# A scan whose fullest core gets this many times its even share is dealt out.
UNEVEN = 2.0


def spread(df: DataFrame) -> DataFrame:
    """A scan whose rows lie in too few splits, dealt over all cores; any other scan as it is.

    Splits are cut by bytes, but a row group belongs to one of them, however many rows it has: a file of
    four row groups keeps four tasks busy, and its other splits are empty. So the rows of each split are
    counted, which for Parquet reads footers only. Filters and column pruning pass through, so only the
    narrow source columns that a query needs are dealt.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits < cores:
        return df.repartition(cores)
    if splits > 4 * cores * cores:  # as uneven as that no table of so many splits is
        return df
    counted = df.groupBy(F.spark_partition_id().alias("split")).count().collect()  # a row a split
    return df.repartition(cores) if fullest([r["count"] for r in counted], cores) > UNEVEN else df


def fullest(rows: Sequence[int], cores: int) -> float:
    """How many times its even share the fullest core gets, if the largest splits are dealt first."""
    loads = [0] * cores
    for n in sorted(rows, reverse=True):
        heapq.heapreplace(loads, loads[0] + n)
    return max(loads) * cores / max(1, sum(loads))
