"""Intermediate tables in the shared folder, and small helpers that several operators use."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrain.session import run_folder

#: Words as most operators take them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer form of it that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column, pattern: str = WORD) -> Column:
    """The words of a text in order; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)),
                      F.array().cast("array<string>"))


def split_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` such that adaptive execution can split a hot key's rows over many tasks.

    It can do so only where both sides are shuffled for the join itself. A side fresh from an aggregate
    on the same keys would be joined in place; a hash of the keys as one more key has it shuffled again.
    """
    mark = fresh_name(left, "_mark")
    return left.withColumn(mark, F.xxhash64(*keys)).join(
        right.withColumn(mark, F.xxhash64(*keys)), [mark, *keys], how).drop(mark)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 500_000) -> DataFrame:
    """Broadcast a narrow table of a counted size below ``limit`` rows; else leave the join to shuffle."""
    return F.broadcast(df) if rows <= limit else df
