"""Key lookups, fallback cascades, match flags and duplicate ranking.

None of these fans rows out: every lookup has one row per key before it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulgrain import contracts

# Rows that cannot match are spread over so many join keys for each shuffle partition.
SPREAD = 16
# Bits of a map of hashed keys, 4 MB whatever the data, and of each of the bitmaps that Spark makes of them.
MAP_BITS, _BITMAP_BITS = 1 << 25, 1 << 15


def newest_per_key(
    df: DataFrame, key: str, order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """One row per non-null ``key``: the one with the greatest ``order`` (nulls lowest).

    An aggregate rather than a ranking window, so each map task sends one row per key.
    """
    best = F.max_by(F.struct(*keep), F.struct(*order)).alias("_best")
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(best)
        .select(key, *[F.col("_best")[c].alias(c) for c in keep])
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def left_lookup(
    df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, strategy: str = "", **take: str
) -> DataFrame:
    """Left join to a one-row-per-key lookup; ``take`` maps new columns to lookup columns.

    ``key`` is a SQL expression of text type. Rows whose key is null cannot match; they are
    spread by a hash of all their columns so that they do not pile up in one task. The hash depends on the row alone, so a re-run task sends
    its rows to the same place.

    Hot non-null keys are split by adaptive execution, which can do so only where both sides
    are shuffled for the join itself. A lookup fresh from its aggregate would be joined in
    place; keying it by an expression makes Spark shuffle its few narrow columns once more.
    ``strategy`` names a join hint for the lookup.
    """
    right = lookup.selectExpr(
        f"concat({lookup_key}, '') AS _rk", *[f"{src} AS _r_{dst}" for dst, src in take.items()]
    )
    keys = SPREAD * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spread = f"concat('\u0001no key ', pmod(xxhash64({columns}), {keys}))"
    # A column of its own: as an expression of the join, a sort would build the text at every comparison.
    # The mark stands for the key's own columns, which are often read for nothing else and then stay out of the shuffle.
    keyed = df.withColumns({"_lk": F.expr(f"coalesce({key}, {spread})"), "_has": F.expr(f"({key}) IS NOT NULL")})
    if strategy:
        right = right.hint(strategy)
    joined = keyed.join(right, F.col("_lk") == F.col("_rk"), "left")
    return joined.withColumns(
        {dst: F.expr(f"if(_has, _r_{dst}, NULL)") for dst in take}
    ).drop("_lk", "_has", "_rk", *[f"_r_{dst}" for dst in take])


def flag_matches(
    df: DataFrame, key: str, parents: DataFrame, parent_key: str, flag: str
) -> DataFrame:
    """Add a boolean: does ``key`` occur in ``parents``? Every row is kept once."""
    keys = distinct_keys(parents, parent_key)
    out = left_lookup(df, key, keys, parent_key, _hit=parent_key)
    return out.withColumn(flag, F.expr("_hit IS NOT NULL")).drop("_hit")


def may_occur(df: DataFrame, key: str, others: DataFrame, other_key: str) -> Column:
    """False if the text ``key`` is surely not in ``others``; true also for keys that share a hash with one.

    A map of hashes of fixed size, made once and sent to the tasks as a value. It is a plain condition, so it reaches the scan.
    """
    def place(k: str) -> Column:
        return F.pmod(F.xxhash64(F.expr(f"string({k})")), F.lit(MAP_BITS))

    at = place(other_key)
    none = df.sparkSession.range(MAP_BITS // _BITMAP_BITS).select(F.col("id").alias("_bucket"), F.lit(None).cast("long").alias("_bit"))
    named = others.where(f"({other_key}) IS NOT NULL").select(
        F.shiftright(at, 15).alias("_bucket"), at.bitwiseAND(_BITMAP_BITS - 1).alias("_bit"))
    maps = none.unionByName(named).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    every = maps.agg(F.transform(F.array_sort(F.collect_list(F.struct("_bucket", "_bits"))), lambda m: m["_bits"]))
    at = place(key)
    bits = F.get(every.scalar(), F.shiftright(at, 15).cast("int"))
    byte = F.substring(bits, F.shiftright(at.bitwiseAND(_BITMAP_BITS - 1), 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(7).cast("int")) == 1


@dataclass(frozen=True)
class Rule:
    """One step of a cascade: ``key`` of the child against a one-row-per-key lookup."""

    label: str
    key: str
    lookup: DataFrame
    lookup_key: str
    target: str


def cascade_match(
    df: DataFrame,
    rules: Sequence[Rule],
    matched: str,
    method: str,
    payload: Sequence[str] = (),
    reread: bool = False,
) -> DataFrame:
    """Match by the first rule that hits; later rules see only keys still unmatched.

    Adds ``matched`` (the target id), ``method`` (the rule's label or UNMATCHED) and, from
    the lookup that hit, each ``payload`` column.

    Where the first key is itself all that it finds, ``reread`` settles most rows without a shuffle: a
    map of hashes of the keys that its lookup lacks tells which rows need the rules. Rows without any
    key match nothing. This reads ``df`` and the
    lookups some times over, so it is for those that are little more than scans.
    """
    first = rules[0]
    if not reread or payload or first.target != first.lookup_key:
        return _by_rules(df, rules, matched, method, payload)
    known = first.lookup.selectExpr(f"{first.lookup_key} AS _known")
    keys = df.selectExpr(f"{first.key} AS _key").where("_key IS NOT NULL").distinct()
    lacking = keys.join(known, F.col("_key") == F.col("_known"), "left_anti")
    may = may_occur(df, first.key, lacking, "_key")
    has, none = F.expr(f"({first.key}) IS NOT NULL"), F.expr(" AND ".join(f"({r.key}) IS NULL" for r in rules))
    settled = (has & ~may) | none
    done = df.where(settled).withColumns({
        matched: F.expr(first.key),
        method: F.when(has, first.label).otherwise(contracts.UNMATCHED),
    })
    return done.unionByName(_by_rules(df.where(~settled), rules, matched, method, payload))


def _by_rules(
    df: DataFrame, rules: Sequence[Rule], matched: str, method: str, payload: Sequence[str]
) -> DataFrame:
    """The rules run over the distinct combinations of keys alone; the rows, however wide, are
    shuffled once to take the answer."""
    keys = [f"_key{i}" for i in range(len(rules))]
    hits = [f"_hit{i}" for i in range(len(rules))]

    def together(names: Sequence[str]) -> str:
        texts = ", ".join(f"coalesce(concat(length({k}), ':', {k}), '-')" for k in names)
        some = " OR ".join(f"({k}) IS NOT NULL" for k in names)
        return f"CASE WHEN {some} THEN concat_ws(';', {texts}) END"

    found = (
        df.selectExpr(*[f"{r.key} AS {k}" for r, k in zip(rules, keys)])
        .where(" OR ".join(f"{k} IS NOT NULL" for k in keys))
        .distinct()
    )
    for i, rule in enumerate(rules):
        still_open = " AND ".join(f"{h} IS NULL" for h in hits[:i])
        key = f"CASE WHEN {still_open} THEN {keys[i]} END" if i else keys[i]
        take = {hits[i]: rule.target, **{f"_{p}{i}": p for p in payload}}
        found = left_lookup(found, key, rule.lookup, rule.lookup_key, **take)
    arms = " ".join(f"WHEN {h} IS NOT NULL THEN '{r.label}'" for r, h in zip(rules, hits))
    # At most one rule hits, so coalesce picks that rule's payload.
    carried = {p: [f"_{p}{i}" for i in range(len(rules))] for p in payload}
    answers = found.select(
        F.expr(together(keys)).alias("_keys"), F.coalesce(*hits).alias("_matched"), F.expr(f"CASE {arms} END").alias("_method"),
        *[F.coalesce(*parts).alias(f"_{p}") for p, parts in carried.items()],
    ).where("_matched IS NOT NULL")
    take = {"_to": "_matched", "_by": "_method", **{f"_with_{p}": f"_{p}" for p in payload}}
    out = left_lookup(df, together([r.key for r in rules]), answers, "_keys", **take)
    return out.withColumns({
        matched: F.col("_to"),
        method: F.coalesce("_by", F.lit(contracts.UNMATCHED)),
        **{p: F.col(f"_with_{p}") for p in payload},
    }).drop("_to", "_by", *[f"_with_{p}" for p in payload])


def unique_rows(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df``, failing while it runs if a key (nulls are equal) has more than one row."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(0).alias("_"), *rest)).alias("_row"))
    shown = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])
    # The check is part of the first key, so no use of the result can leave it out.
    again = F.raise_error(F.concat(F.lit(f"{name} is not one row a key: "), shown))
    checked = F.when(F.col("_n") > 1, again.cast(df.schema[keys[0]].dataType)).otherwise(F.col(keys[0]))
    kept = {c: F.col("_row")[c] for c in rest} | {k: F.col(k) for k in keys} | {keys[0]: checked}
    return one.select(*[kept[c].alias(c) for c in df.columns])


def merge_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of ``left`` with the columns of its row in ``right``; null keys are equal.

    A key with more rows on either side fails the query that reads the result, naming the key.
    """
    ours, theirs = unique_rows(left, keys, "left side"), unique_rows(right, keys, "right side")
    theirs = theirs.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in theirs.columns])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return ours.join(theirs, same, "left").drop(*[f"_r_{k}" for k in keys])


def flag_replaced(
    df: DataFrame, key: str, parent_key: str, counts: str, flag: str
) -> DataFrame:
    """Add a boolean: does a row satisfying ``counts`` name this row's key as its parent?

    Few rows are replaced, so only those that may be are shuffled for the exact answer; the others, however wide, stay.
    """
    parents = df.where(counts).select(parent_key)
    may = may_occur(df, key, parents, parent_key)
    return df.where(~may).withColumn(flag, F.lit(False)).unionByName(flag_matches(df.where(may), key, parents, parent_key, flag))


def first_in_group(df: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """Rows ranked first in their group (nulls form a group).

    The filter on rank 1 lets Spark cut each group down in the map tasks, so a group of any
    size sends at most one row per task to the shuffle.
    """
    w = Window.partitionBy("_group").orderBy(*order)
    return (
        df.withColumn("_group", key)
        .withColumn("_rank", F.row_number().over(w))
        .where("_rank = 1")
        .drop("_group", "_rank")
    )


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns, to end an order where its own columns tie."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


# Rows of a group that one task ranks; larger groups are cut into buckets of about so many.
BUCKET_ROWS = 1_000_000
# Sampled rows for each bucket, and at most for a group.
_SAMPLES, _MOST_SAMPLES = 8, 1 << 16


def rank_in_group(
    df: DataFrame, key: Column, order: Sequence[str], rank: str, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Number the rows of each group 1, 2, ... by ``order`` columns, greatest first and nulls last.

    Nulls form a group. A hash of the whole row ends the order, so only copies of one row tie.

    A group of more than ``bucket_rows`` rows is cut into buckets at bounds taken from a sample of its
    rows. A row's rank is its number in its bucket plus the rows of the buckets before, a prefix sum
    over the buckets' counts. The sample is chosen by the rows' hashes, so every pass finds the same
    bounds and a re-run task repeats its rows. All of it is one lazy plan; where no group is that large,
    adaptive execution drops the parts for large groups.

    The sizes, bounds and prefix sums of large groups are broadcast: one for each ``bucket_rows`` rows.
    """
    place = F.struct(*order, F.bitwise_not(row_hash(df)).alias("_last"))
    keyed = df.withColumn("_group", key).withColumn("_place", place)
    large = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_rows)
    every = F.greatest(F.lit(max(1, bucket_rows // _SAMPLES)), F.ceil(F.col("_n") / _MOST_SAMPLES))
    sampled = _in_group(keyed, large, "inner").where(F.pmod(F.xxhash64("_place"), every) == 0)
    samples = sampled.groupBy("_group").agg(F.sort_array(F.collect_list("_place"), asc=False).alias("_samples"))
    bounds = samples.select(
        "_group", F.filter("_samples", lambda x, i: i % _SAMPLES == _SAMPLES - 1).alias("_bounds"))

    buckets = _in_group(keyed, bounds, "left").withColumn(
        "_bucket", F.when(F.col("_bounds").isNull(), 0).otherwise(_greater(F.col("_bounds"), F.col("_place"))))
    before = Window.partitionBy("_group").orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)
    prefix = (
        _in_group(keyed, bounds, "inner")
        .groupBy("_group", _greater(F.col("_bounds"), F.col("_place")).alias("_pb"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(F.col("_group").alias("_pg"), "_pb", "_before")
    )
    within = Window.partitionBy("_group", "_bucket").orderBy(F.desc("_place"))
    numbered = buckets.drop("_bounds").withColumn("_at", F.row_number().over(within))
    same = F.col("_group").eqNullSafe(F.col("_pg")) & (F.col("_bucket") == F.col("_pb"))
    return numbered.join(F.broadcast(prefix), same, "left").select(
        *df.columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias(rank))


def _in_group(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """Rows with what is known of their group; null is a group. ``groups`` are the large ones only."""
    known = groups.withColumnRenamed("_group", "_large")
    return rows.join(F.broadcast(known), F.col("_group").eqNullSafe(F.col("_large")), how).drop("_large")


def _greater(bounds: Column, value: Column) -> Column:
    """How many of the falling ``bounds`` are greater than ``value``: a search by halves."""
    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.floor((low + high) / 2).cast("int")
        beyond = F.get(bounds, middle) > value
        going = low < high
        return F.struct(F.when(going & beyond, middle + 1).otherwise(low).alias("low"),
                        F.when(going & ~beyond, middle).otherwise(high).alias("high"))

    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(_MOST_SAMPLES.bit_length()))
    return F.aggregate(steps, start, halve, lambda state: state["low"])
