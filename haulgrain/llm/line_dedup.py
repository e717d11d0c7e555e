"""Operator 9: drop lines that many documents share.

Lines become narrow rows of hash, document and position. They are range-partitioned by hash and
sorted by document and position within it, so the first occurrence of a line in each document is
seen by comparing neighbours as the rows stream by. First occurrences count the documents of a line.
What comes back per document is a run-length coded bitmap of the lines to keep, not text.

A third range column, a bucket of the document, cuts the rows of a very common line into as many
ranges as there are shuffle partitions; the buckets' counts are then added.

A document is a distinct pair of id and text, so repeated rows count once and are all returned. A
null text is one empty line. Null ids are an id like any other. Lines whose key is shorter than
``min_chars`` are always kept. An empty table gives an empty table. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulgrain.llm.tables import lower_ascii, split_join, written

_SPACE = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    return lower_ascii(F.trim(line, F.lit(_SPACE)))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(id, text_hash, drop_runs) of each document that loses lines.

    ``drop_runs`` are ordered runs (first, last) of dropped line positions from 0: the complement of
    the keep bitmap, run-length coded.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    exploded = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"),
                           F.posexplode(_lines(text)).alias("pos", "line"))
    key = exploded.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    narrow = key.filter(F.length("key") >= min_chars).select(
        "id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(9), "key").alias("h2"))
    lines = written(narrow, "lines")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("id", "text_hash"), F.lit(max(8, tasks)))
    ranged = lines.withColumn("bucket", bucket).repartitionByRange("h1", "h2", "bucket")
    stream = Window.partitionBy("h1", "h2", "bucket").orderBy("id", "text_hash", "pos")
    document = F.struct("id", "text_hash")
    first = ~F.lag(document).over(stream).eqNullSafe(document)
    shared = (ranged.select("h1", "h2", first.alias("first")).filter("first")
              .groupBy("h1", "h2").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
              .select("h1", "h2"))

    dropped = split_join(lines, shared, ["h1", "h2"]).groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set("pos")).alias("at"))
    return dropped.select("id", "text_hash", _runs(F.col("at")).alias("drop_runs"))


def _runs(at: Column) -> Column:
    """Ordered distinct positions as runs (first, last)."""
    first = F.filter(at, lambda x, i: (i == 0) | (F.get(at, i - 1) < x - 1))
    last = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (F.get(at, i + 1) > x + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept) for each row of ``docs``; kept is the text that remains."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))
    joined = rows.join(bitmaps, rows["_id"].eqNullSafe(bitmaps["id"]) & (rows["_hash"] == bitmaps["text_hash"]), "left")
    runs = F.coalesce("drop_runs", F.array().cast("array<struct<first:int,last:int>>"))
    parts = joined.select("_id", _lines(F.col("_text")).alias("lines"), runs.alias("runs"))
    # Kept stretches lie between the runs.
    starts = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["last"] + 1))
    ends = F.concat(F.transform("runs", lambda r: r["first"]), F.array(F.size("lines")))
    stretches = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    kept = F.flatten(F.transform(F.filter(stretches, lambda s: s["n"] > 0),
                                 lambda s: F.slice("lines", s["a"] + 1, s["n"])))
    dropped = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    return parts.select(
        F.col("_id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
        F.when(F.size("runs") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Both steps: each row's id, line counts and remaining text."""
    return apply_bitmaps(docs, line_bitmaps(docs, id_col, text_col, min_docs, min_chars), id_col, text_col)
