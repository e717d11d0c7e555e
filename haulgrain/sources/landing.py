"""Landing source extracts as Parquet with normalised names and text identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulgrain.contracts import TEXT_NAME_PARTS, TEXT_NAMES
from haulgrain.sources.csv_records import read_quoted_csv


def snake_case(name: object) -> str:
    """lastUpdateTS -> last_update_ts, 'Ship To (City)' -> ship_to_city."""
    words = re.findall(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]*[a-z0-9]+|[A-Z]+[0-9]*", str(name))
    return "_".join(words).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Snake-case every column; blank or colliding results are errors."""
    names = [snake_case(c) for c in df.columns]
    blank = [old for old, new in zip(df.columns, names) if not new]
    if blank:
        raise ValueError(f"column names with no letters or digits: {blank}")
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide once normalised: {twice}")
    return df.toDF(*names)


def is_text_name(column: str) -> bool:
    return column in TEXT_NAMES or any(part in column for part in TEXT_NAME_PARTS)


def _as_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BooleanType):
        return F.initcap(c.cast("string"))
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e18))
        return F.when(whole, c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def preserve_text(df: DataFrame) -> DataFrame:
    """Identifier-like columns as text, so 123.0 lands as '123' and 'ABC.0' stays."""
    return df.select(*[
        _as_text(F.col(f.name), f.dataType).alias(f.name) if is_text_name(f.name) else F.col(f.name)
        for f in df.schema.fields
    ])


def read_extract(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """CSV columns stay text: types belong to staging, and no pass is spent inferring them.

    Quoted fields may hold commas, doubled quotes and line breaks, in files of any size. A row with too
    few or too many fields, or a file whose header differs from the others', is an error rather than
    shifted or lost text.
    """
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1]
    return read_quoted_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)


def land_extracts(spark: SparkSession, paths: dict[str, str], folder: str) -> DataFrame:
    """Write each extract to ``folder/<table>`` and return a manifest of rows and columns."""
    for table, path in paths.items():
        df = preserve_text(normalize_columns(read_extract(spark, path)))
        df.write.mode("overwrite").option("compression", "snappy").parquet(f"{folder}/{table}")
    frames = []
    for table in paths:
        landed = spark.read.parquet(f"{folder}/{table}")
        frames.append(
            landed.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(table).alias("table_name"), "row_count",
                F.lit(len(landed.columns)).cast("long").alias("column_count"),
            )
        )
    manifest = frames[0]
    for f in frames[1:]:
        manifest = manifest.unionByName(f)
    return manifest


class LandedRaw:
    """Raw layer over landed Parquet folders."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}")
