"""Operator 1: find benchmark passages in documents by a prefix-filtered set join.

A benchmark item is its windows of ten consecutive words (a shorter item is one window). A window is
the set of its word shingles with their places. Exact containment needs every shingle of a window,
so its rarest one is prefix enough:

1. One pass looks up each document shingle among the shingles of the benchmark; the hits are few.
2. Hits give every benchmark shingle its count over the whole corpus. Windows with a shingle that
   never occurs are out; the others keep the rarest shingle and its place.
3. Hits of those shingles become candidates: the window must start inside the text (positional
   bound) and end inside it (length bound).
4. Candidates go to their documents, where the words themselves are compared.

The benchmark's shingles are counted and broadcast only below a limit; beyond it the lookup shuffles.

A document is a distinct pair of id and text; repeated rows are each returned. Null and empty texts
have no words. Items without words or with a null text have no windows; a null item id is left out.
Repeated items count once. Empty tables give no hits, or no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.llm.tables import broadcast_if_small, lower_ascii, words, written

#: A word: ASCII digits and lower-case letters, and anything beyond ASCII.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return words(lower_ascii(text.cast("string")), ITEM_WORD)


def _spans(n: Column, size: Column) -> Column:
    """Starts of all windows of ``size`` in ``n`` places."""
    return F.when(n < size, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - size))


def _shingle(of: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(of, at + j) for j in range(size)))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, window, n): the distinct windows of each item as text, with their number of words."""
    w = items.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("item"), _words(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(window))
    spans = w.select("item", "w", n.alias("n"), F.explode(_spans(F.size("w"), n)).alias("at"))
    return spans.select("item", F.array_join(F.slice("w", F.col("at") + 1, F.col("n")), " ").alias("window"), "n").distinct()


def _window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """(window, n, h, offset): all shingles of each window; windows of fewer words are one shingle."""
    w = windows.select("window", "n").distinct().withColumn("w", F.split("window", " "))
    out = None
    for k in range(1, size + 1):
        fits = (F.col("n") >= size) if k == size else (F.col("n") == k)
        part = w.filter(fits).select("window", "n", "w", F.explode(_spans(F.col("n"), F.lit(k))).alias("offset"))
        part = part.select("window", "n", _shingle(F.col("w"), F.col("offset"), k).alias("h"), "offset")
        out = part if out is None else out.union(part)
    return out


def find_passages(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                  size: int = 3) -> DataFrame:
    """(id, text_hash, n_words, n_hit, n_items, items) for each row of ``docs``; ``items`` are ordered item ids.

    A word is hit if it lies inside any occurrence of a window.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    windows = written(item_windows(items, item_col, item_text_col, window), "windows")
    shingles = written(_window_shingles(windows, size), "shingles")
    wanted = shingles.select("h").distinct()
    n_wanted = wanted.count()
    lengths = [r[0] for r in windows.select(F.least("n", F.lit(size))).distinct().collect()]  # at most ``size`` rows

    at = rows.select("id", "text_hash", _words(F.col("text")).alias("w")).withColumn("n_words", F.size("w"))
    every = F.array().cast("array<struct<at:int,h:bigint>>")
    for k in sorted(lengths):
        every = F.concat(every, _placed(k))
    hits = at.select("id", "text_hash", "n_words", F.inline(every)).join(broadcast_if_small(wanted, n_wanted), "h")
    hits = written(hits.select("id", "text_hash", "n_words", "at", "h"), "hits")

    counted = hits.groupBy("h").agg(F.count("*").alias("found"))
    placed = shingles.join(counted, "h", "left")
    prefix = placed.groupBy("window", "n").agg(
        F.min(F.struct(F.coalesce("found", F.lit(0)).alias("found"), "h", "offset")).alias("first")).filter(
        "first.found > 0").select("window", "n", "first.h", "first.offset")
    candidates = hits.join(prefix, "h").select(
        "id", "text_hash", (F.col("at") - F.col("offset")).alias("start"), "n", "window", "n_words")
    candidates = candidates.filter((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
    by_doc = candidates.groupBy("id", "text_hash").agg(
        F.collect_set(F.struct("start", "n", "window")).alias("candidates"))

    joined = rows.join(by_doc.withColumnsRenamed({"id": "own_id", "text_hash": "own_hash"}),
                       F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left")
    checked = joined.select("id", "text_hash", _words(F.col("text")).alias("w"), "candidates").select(
        "id", "text_hash", F.size("w").cast("long").alias("n_words"),
        F.array_sort(F.filter(F.coalesce("candidates", F.array().cast("array<struct<start:int,n:int,window:string>>")),
                              lambda c: F.array_join(F.slice("w", c["start"] + 1, c["n"]), " ") == c["window"])).alias("found"))
    reach = F.aggregate(
        "found", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end")),
        lambda a, c: F.struct((a["hit"] + F.greatest(F.lit(0), c["start"] + c["n"] - F.greatest(c["start"], a["end"]))).alias("hit"),
                              F.greatest(a["end"], c["start"] + c["n"]).alias("end")))
    checked = written(checked.select("id", "text_hash", "n_words", reach["hit"].cast("long").alias("n_hit"),
                                     F.array_distinct(F.transform("found", lambda c: c["window"])).alias("windows")), "checked")
    named = checked.filter(F.size("windows") > 0).select("id", "text_hash", F.explode("windows").alias("window")).distinct()
    named = named.join(windows.select("window", "item"), "window").groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    named = named.withColumnsRenamed({"id": "own_id", "text_hash": "own_hash"})
    found = checked.join(named, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(F.col("id").alias(id_col), "text_hash", "n_words", "n_hit", F.size(items_of).cast("long").alias("n_items"),
                        items_of.alias("items"))


def _placed(k: int) -> Column:
    """All shingles of k words of column w with their places."""
    w = F.col("w")
    return F.transform(_spans(F.size(w), F.lit(k)), lambda i: F.struct(i.alias("at"), _shingle(w, i, k).alias("h")))
