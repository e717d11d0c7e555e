"""Operator 7: mix sources to target weights on a low-discrepancy schedule.

Sizes are words. The sources' targets are a share of all words, dealt by weight; a target stops at a
multiple of its source's size and the excess goes to the others by weight.

Slot n of the schedule is the point frac(n * golden ratio), computed in whole numbers modulo 2^40;
cumulative targets map it to a source, so any stretch of the schedule holds the sources in their
shares. A source lines its documents up in the order of a hash and cuts the line into blocks of equal
size; the k-th slot of a source takes block k modulo its number of blocks. Prefix sums and ranks are
taken within buckets first and buckets are added up after that, so a source of any size is spread.

Only sizes, ids and counts move; texts are not shuffled. Sources are one row each in the tables of
targets, which one task orders.

Nulls: a null text has size 0 and is never taken; a null source is a source of its own, the last;
null ids are ids. Repeated rows of one id, source and size are one document of their joint size: each
takes an equal part, in the end within its own limit. Empty tables give empty results. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulgrain.llm.tables import WORD, let, written

#: Words in a block.
BLOCK = 64
_POINTS = 1 << 40
#: 2^40 divided by the golden ratio, made odd.
_STEP = 679_535_556_991


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: int) -> DataFrame:
    """(source, source_size, target) from (source, size); sources in order of code points, null last."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(order - 1, F.lit(len(weights))).cast("int"))
    per = per.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * float(limit))
    # Water level: those with the least limit per weight are full first. Level k holds if the first k are full.
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy(F.lit(0)).orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(all_rows) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= F.col("most"))
    first_open = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return per.withColumn("water", first_open).select(
        "source", "source_size", F.least("most", F.coalesce(F.col("water") * F.col("weight"), "most")).alias("target"))


def _running(df: DataFrame, keys: list[str], bucket: str, order: list, value: str, out: str) -> DataFrame:
    """``out``: sum of ``value`` over the rows before, within ``keys``, in order of bucket and ``order``."""
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    named = {k: f"_{k}" for k in [*keys, bucket]}
    sums = sums.withColumnsRenamed(named)
    same = F.lit(True)
    for k, other in named.items():
        same = same & F.col(k).eqNullSafe(F.col(other))
    within = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return df.join(sums, same).withColumn(out, F.col("_own") + F.col("_base")).drop("_own", "_base", *named.values())


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, limit: int = 2, block: int = BLOCK,
                bucket_words: int = 1_000_000) -> DataFrame:
    """(id, source, size, source_size, target, taken, parts) for each row of ``docs``.

    ``parts`` are the stretches of the document's words that are taken, and how often.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")), "sizes")
    goal = written(targets(sizes, weights, share, limit), "targets")
    total = goal.agg(F.sum("target"), F.sum("source_size")).first()
    slots = int(min(share, limit) * (total[1] or 0) // block)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int((total[1] or 0) // bucket_words))

    # Documents in line: where each begins in its source. Equal rows are one stretch.
    shuffle = F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size").cast("string")))
    one = sizes.groupBy("id", "source", "size").agg(F.count("*").alias("copies"))
    one = one.withColumn("words", F.col("size") * F.col("copies")).withColumn("order", shuffle).withColumn(
        "bucket", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") * buckets / (1 << 32)))
    line = _running(one.filter("words > 0"), ["source"], "bucket", ["order", "id", "size"], "words", "start")

    # The schedule: the source of each slot by cumulative targets, in whole points.
    upto = Window.orderBy(F.col("source").asc_nulls_last())
    edges = goal.filter("target > 0").withColumn(
        "to", F.sum("target").over(upto.rowsBetween(Window.unboundedPreceding, 0)) / F.lit(total[0] or 1.0)).withColumn(
        "to", F.when(F.lead("to").over(upto).isNull(), F.lit(_POINTS)).otherwise(F.floor(F.col("to") * F.lit(_POINTS)))).withColumn(
        "from", F.coalesce(F.lag("to").over(upto), F.lit(0)))
    parts = 1024  # points and edges meet in equal parts of the range
    edges = edges.select("source", "from", "to", F.explode(F.sequence(
        F.floor(F.col("from") / (_POINTS // parts)), F.floor((F.col("to") - 1) / (_POINTS // parts)))).alias("part"))
    high, low = F.shiftright(F.col("id"), 20), F.col("id").bitwiseAND((1 << 20) - 1)
    point = (((high * _STEP) % (1 << 20)) * (1 << 20) + low * _STEP) % _POINTS
    slot = spark.range(0, slots).withColumn("point", point).withColumn("part", F.floor(F.col("point") / (_POINTS // parts)))
    slot = slot.join(edges, "part").filter("point >= from and point < to").select(
        "source", F.col("id").alias("slot"), F.floor(F.col("id") / 65536).alias("bucket"), F.lit(1).alias("one"))
    ranked = _running(slot, ["source"], "bucket", ["slot"], "one", "rank")

    blocks = goal.select(F.col("source").alias("_source"), F.ceil(F.col("source_size") / block).cast("long").alias("blocks"))
    times = ranked.join(blocks, F.col("source").eqNullSafe(F.col("_source"))).filter(
        F.col("rank") < F.col("blocks") * limit).groupBy("source", (F.col("rank") % F.col("blocks")).alias("block")).agg(
        F.count("*").alias("times")).withColumnsRenamed({"source": "_source", "block": "_block"})

    pieces = line.select("id", "source", "size", "copies", "start", (F.col("start") + F.col("words")).alias("end"), F.explode(
        F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("words") - 1) / block))).alias("block"))
    overlap = F.least("end", (F.col("block") + 1) * block) - F.greatest("start", F.col("block") * block)
    begin = F.greatest("start", F.col("block") * block) - F.col("start")
    piece = F.struct(begin.alias("from"), (begin + overlap).alias("to"), F.col("times").alias("times"))
    got = pieces.join(times, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))).groupBy(
        "id", "source", "size", "copies").agg(F.sum(overlap * F.col("times")).alias("words"), F.collect_list(piece).alias("pieces"))
    got = got.withColumnsRenamed({c: f"_{c}" for c in ("id", "source", "size")})
    with_goal = sizes.join(goal.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
    out = with_goal.join(got, F.col("id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
                         & (F.col("size") == F.col("_size")), "left")
    taken = F.coalesce(F.floor(F.col("words") / F.col("copies")), F.lit(0)).cast("long")
    # Documents that share a stretch take whole passes, and the rest from their beginning.
    passes = F.floor(taken / F.col("size"))
    shared = F.filter(F.array(F.struct(F.lit(0).cast("long").alias("from"), (taken % F.col("size")).alias("to"), (passes + 1).alias("times")),
                              F.struct((taken % F.col("size")).alias("from"), F.col("size").alias("to"), passes.alias("times"))),
                      lambda x: (x["to"] > x["from"]) & (x["times"] > 0))
    none = F.array().cast("array<struct<from:bigint,to:bigint,times:bigint>>")
    parts = F.when(taken == 0, none).when(F.col("copies") == 1, F.array_sort("pieces")).otherwise(shared)
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", F.col("source_size").cast("long"),
                      "target", taken.alias("taken"), parts.alias("parts"))


def apply_mix(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              limit: int = 2) -> DataFrame:
    """The rows of ``docs`` as often as the plan takes them, with the words that it takes.

    A pass over a document is a row. A pass of all its words has the text as it is, other passes keep the
    words taken with the white space before them. Documents that no slot takes, or without words, go.
    """
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    plan = plan.filter("taken > 0").select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col("size").alias("_size"),
                                           F.col("parts").alias("_parts")).groupBy("_id", "_source", "_size").agg(F.first("_parts").alias("_parts"))
    rows = docs.withColumn("_words", size)
    joined = rows.join(plan, F.col(id_col).eqNullSafe(F.col("_id")) & F.col(source_col).eqNullSafe(F.col("_source"))
                       & (F.col("_words") == F.col("_size")))
    passes = joined.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.lit(limit)))).withColumn(
        "_own", F.filter("_parts", lambda p: p["times"] >= F.col("_pass"))).filter(F.size("_own") > 0)
    taken = F.aggregate("_own", F.lit(0).cast("long"), lambda n, p: n + p["to"] - p["from"])
    spaced = F.regexp_extract_all(text, F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(1))
    partial = let(spaced, lambda w: F.array_join(F.flatten(F.transform(
        "_own", lambda p: F.slice(w, p["from"].cast("int") + 1, (p["to"] - p["from"]).cast("int")))), ""))
    chosen = F.when(taken == F.col("_size"), text).otherwise(F.ltrim(partial, F.lit(" \t\n\x0b\x0c\r")))
    return passes.select(*(chosen.alias(c) if c == text_col else F.col(c) for c in docs.columns))
