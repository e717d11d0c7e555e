"""Operator 5: licences of files by TF-IDF cosine to templates, and by their directories.

Units are the lines of a text and runs of consecutive lines (headers, up to a little more words than the longest template
for them has), and the whole text (licence files). Empty lines and comment marks do not count. A unit's vector has a
component for each word, weighted by frequency and by rarity over the lines and whole texts of the corpus; words outside
the templates have the greatest rarity.

Three bounds go before the join of units to the sparse template vectors; none loses a match. A unit as close as the
threshold has one of its template's rarest words, as the others are too short a vector: texts without any go at once, and
so do runs. A run's product with any template is at most the sum of its lines' products with the templates' envelope, the
greatest weight that any of them gives a word; its squared length is at least the sum of its lines'. Both add up along a text,
so runs are bounded within its row. The last bound is the exact share of the templates' words in a unit's length.

A match also needs the words of its licence's version (``license_texts``). A file has the licence of its best unit: a whole
text of a licence before notices, and these before a mere reservation of rights. A file without one takes that of the
licence file in its nearest ancestor directory, found by joining the file's ancestor directories to the directories that
have one.

The words and vectors of templates are as many as the templates have, whatever the corpus. Null and
empty texts have no units and can only inherit. A null path has no directory. Ties: the greater
cosine, then the template's name, then the lesser line. Rows that repeat an id and text are all
returned. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulgrain.llm.license_texts import Template, standard
from haulgrain.llm.tables import let, written

#: Words of the longest template that runs of lines are compared with; longer ones are compared with whole texts only.
HEADER_WORDS = 300

_SPLIT = r"[^\x{80}-\x{10FFFF}A-Za-z0-9]+"


def _tokens(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPLIT, -1), "")


def _listed(words) -> str:
    """SQL condition that the lambda variable x is one of ``words``, which have letters and digits only."""
    return f"x IN ({', '.join(repr(w) for w in sorted(words))})" if words else "false"


def _lines(docs: DataFrame) -> Column:
    """Array of (line, w) of a text's lines with words; null for a null text."""
    cut = F.transform(F.split(F.lower("text"), "\n", -1), lambda x, i: F.struct(i.alias("line"), _words(x).alias("w")))
    return F.filter(cut, lambda u: F.size(u["w"]) > 0)


def _rarest(own: Counter, rarity: dict[str, float], threshold: float) -> set[str]:
    """Words of a template of which any unit as close as the threshold has one."""
    square = {w: (n * rarity[w]) ** 2 for w, n in own.items()}
    rest, out = sum(square.values()), set()
    least = rest * threshold ** 2 * (1 - 1e-9)
    for w in sorted(own, key=lambda w: (-rarity[w], w)):
        if rest < least:
            break
        out.add(w)
        rest -= square[w]
    return out


def _runs(lines: DataFrame, longest: int, threshold: float) -> DataFrame:
    """(doc, start, stop): runs of lines up to ``longest`` words that pass the bounds, without whole texts."""
    order = Window.partitionBy("doc").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("doc").orderBy(F.col("line").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines.withColumn("upto", F.sum("n").over(order)).withColumn(
        "next", F.min(F.when(F.col("rare"), F.col("upto"))).over(back))
    # A run begins and ends at a line with words of templates, near enough to a rare one: other lines only lengthen it.
    begins = F.coalesce((F.col("e") > 0) & (F.col("next") - F.col("upto") + F.col("n") <= longest), F.lit(False))
    rows = rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("line", "e", "square", "n", "rare", begins.alias("begins")))).alias("ls"))
    least = threshold ** 2 * (1 - 1e-9)

    def runs(ls: Column) -> Column:
        def from_line(s: Column, i: Column) -> Column:
            start = F.struct(F.lit(0.0).alias("e"), F.lit(0.0).alias("square"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("rare"),
                             F.array().cast("array<int>").alias("stops"))

            def step(acc: Column, x: Column) -> Column:
                e, square, n, rare = acc["e"] + x["e"], acc["square"] + x["square"], acc["n"] + x["n"], acc["rare"] | x["rare"]
                passes = (n <= longest) & rare & (x["e"] > 0) & (e * e >= square * least)
                more = F.struct(e.alias("e"), square.alias("square"), n.alias("n"), rare.alias("rare"), F.when(
                    passes, F.concat(acc["stops"], F.array(x["line"]))).otherwise(acc["stops"]).alias("stops"))
                return F.when(acc["n"] > longest, acc).otherwise(more)

            stops = F.aggregate(F.slice(ls, i + 1, longest), start, step, lambda acc: acc["stops"])
            return F.transform(stops, lambda x: F.struct(s["line"].alias("start"), x.alias("stop")))

        return F.flatten(F.transform(ls, lambda s, i: F.when(s["begins"], from_line(s, i)).otherwise(
            F.array().cast("array<struct<start:int,stop:int>>"))))

    found = rows.select("doc", F.get("ls", F.lit(0))["line"].alias("first"), F.element_at("ls", -1)["line"].alias("last"), F.inline(let(F.col("ls"), runs)))
    return found.filter("start <> first or stop <> last").select("doc", "start", "stop")


def scan_licenses(files: DataFrame, id_col: str = "id", path_col: str = "path", text_col: str = "text",
                  templates: list[tuple[str, str]] | None = None, threshold: float = 0.75) -> DataFrame:
    """(id, license, similarity, line, inherited_from) for each row of ``files``.

    ``line`` is the first line of the header, -1 for the whole text, null without an own licence;
    ``inherited_from`` is the directory, null for an own licence or none.
    """
    templates = standard() if templates is None else [Template(*t) for t in templates]
    spark = files.sparkSession
    counts = [Counter(_tokens(t.text)) for t in templates]
    words = sorted(set().union(*counts))
    text = F.col(text_col).cast("string")
    docs = files.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"),
                        F.xxhash64(text).alias("text_hash"), text.alias("text"))

    total = docs.select(F.sum(F.when(F.col("text").isNotNull(), 1 + F.size(F.split("text", "\n", -1))))).first()[0] or 0
    known = F.expr(f"transform(ls, u -> array_distinct(filter(u.w, x -> {_listed(words)})))")
    units = docs.select(_lines(docs).alias("ls")).select("ls", known.alias("known")).select(F.explode(F.concat(
        F.array(F.array_distinct(F.flatten("known"))), F.when(F.size("ls") > 1, F.col("known")).otherwise(F.array().cast("array<array<string>>")))).alias("w"))
    found = {r["word"]: r["n"] for r in units.select(F.explode("w").alias("word")).groupBy("word").agg(
        F.count("*").alias("n")).collect()}  # a row for each template word at most
    rarity = {w: math.log((1 + total) / (1 + found.get(w, 0))) + 1.0 for w in words}
    other = math.log(1 + total) + 1.0

    vectors, rare, rare_in_runs, longest, envelope = [], set(), set(), 0, {}
    for k, (t, own) in enumerate(zip(templates, counts, strict=True)):
        length = math.sqrt(sum((n * rarity[w]) ** 2 for w, n in own.items())) or 1.0
        n_words, prefix = sum(own.values()), _rarest(own, rarity, threshold)
        in_runs = n_words <= HEADER_WORDS
        rare |= prefix
        if in_runs:
            rare_in_runs |= prefix
            longest = max(longest, n_words * 5 // 4 + 10)
            for w, n in own.items():
                envelope[w] = max(envelope.get(w, 0.0), n * rarity[w] / length)
        order = 2 if t.license == "proprietary" else 0 if t.full else 1
        vectors += [(k, t.license, order, t.needs, in_runs, w, n * rarity[w] / length) for w, n in own.items()]
    vectors = spark.createDataFrame(
        vectors, "template int, license string, rank int, needs string, in_runs boolean, word string, weight double")
    weights = spark.createDataFrame([(w, r, w in rare_in_runs, envelope.get(w, 0.0)) for w, r in rarity.items()], "word string, rarity double, rare boolean, most double")

    # Texts with a rare word of a template, each once, under a number of their own.
    near = docs.select("id", "text_hash", _lines(docs).alias("ls")).filter(F.expr(f"exists(ls, u -> exists(u.w, x -> {_listed(rare)}))"))
    near = written(near.dropDuplicates(["id", "text_hash"]).withColumn("doc", F.monotonically_increasing_id()), "near")
    terms = near.select("doc", F.inline("ls")).select("doc", "line", F.explode("w").alias("word")).groupBy("doc", "line", "word").agg(
        F.count("*").alias("n")).join(F.broadcast(weights), "word", "left")
    terms = written(terms.select("doc", "line", "word", "n", F.col("rarity").isNotNull().alias("known"), F.coalesce("rare", F.lit(False)).alias("rare"),
                                 (F.col("n") * F.coalesce("rarity", F.lit(other))).alias("x"), F.coalesce("most", F.lit(0.0)).alias("most")), "terms")
    inside = F.when(F.col("known"), F.col("x")).otherwise(0.0)
    lines = terms.groupBy("doc", "line").agg(F.sum(F.col("x") * F.col("most")).alias("e"), F.sum(F.col("x") * F.col("x")).alias("square"),
                                             F.sum("n").alias("n"), F.max("rare").alias("rare"))
    unit = ["doc", "start", "stop"]
    # The words of the version, in order.
    of_unit = F.filter("ls", lambda u: (F.col("start") == -1) | u["line"].between(F.col("start"), F.col("stop")))
    spoken = F.array_join(F.flatten(F.transform(of_unit, lambda u: u["w"])), " ")
    kind = F.when((F.col("rank") == 0) & (F.col("start") == -1), -1).otherwise(F.col("rank"))

    def matches(parts: DataFrame) -> DataFrame:
        """(doc, id, text_hash, start, stop, kind, license, cosine) of units, from the words of their lines."""
        summed = parts.groupBy(*unit, "word", "known").agg(F.sum("x").alias("x"))
        vector = summed.groupBy(*unit).agg(F.sum(F.col("x") * F.col("x")).alias("square"), F.sum(inside * inside).alias("inside"), F.collect_list(
            F.when(F.col("known"), F.struct("word", "x"))).alias("terms")).filter(F.col("inside") >= F.col("square") * (threshold ** 2 * (1 - 1e-9)))
        dots = vector.select(*unit, "square", F.inline("terms")).join(F.broadcast(vectors), "word").filter("in_runs or start = -1").groupBy(
            *unit, "template", "license", "rank", "needs").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"), F.max("square").alias("square"))
        close = dots.withColumn("cosine", F.round(F.col("dot") / F.sqrt("square"), 9)).filter(F.col("cosine") >= threshold)
        return close.join(near, "doc").filter(F.regexp_like(spoken, F.col("needs"))).select(
            "doc", "id", "text_hash", "start", "stop", kind.alias("kind"), "license", "cosine")

    whole = written(matches(terms.select("doc", F.lit(-1).alias("start"), F.lit(-1).alias("stop"), "word", "known", "x")), "whole")
    # A whole text of a licence comes before any header, so its runs need no look.
    open_lines = lines.join(whole.filter("kind = -1").select("doc").distinct(), "doc", "left_anti")
    runs = written(_runs(open_lines, longest, threshold), "runs")
    parts = runs.select("doc", "start", "stop", F.explode(F.sequence("start", "stop")).alias("line")).join(terms, ["doc", "line"])
    matched = whole.unionByName(matches(parts.select("doc", "start", "stop", "word", "known", "x")))
    best = F.min_by(F.struct("license", "cosine", F.col("start").alias("line")), F.struct("kind", -F.col("cosine"), "license", "start", "stop"))
    own = written(matched.groupBy("id", "text_hash").agg(best.alias("own")), "own").withColumnsRenamed(
        {"id": "own_id", "text_hash": "own_hash"})

    rows = docs.select("id", "path", "text_hash").join(
        own, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left")
    rows = written(rows.select("id", "path", "own"), "rows")
    # Licence files give their directory a licence.
    folder = F.regexp_extract(F.col("path"), r"^(.*)/[^/]*$", 1)
    named = rows.filter("own.line = -1 and path is not null").select("id", "own", folder.alias("dir")).groupBy("dir").agg(
        F.min_by("own", F.struct(-F.col("own.cosine"), F.col("own.license"), F.col("id"))).alias("dir_own"))
    steps = F.split(folder, "/", -1)
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    open_paths = rows.filter("own is null and path is not null").select("path", F.explode(F.array_distinct(above)).alias("dir")).distinct()
    taken = open_paths.join(named, "dir").groupBy("path").agg(
        F.max_by(F.struct("dir", "dir_own"), F.length("dir")).alias("taken")).withColumnRenamed("path", "_path")
    out = rows.join(taken, F.col("own").isNull() & (F.col("path") == F.col("_path")), "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("own.license", "taken.dir_own.license").alias("license"),
                      F.coalesce("own.cosine", "taken.dir_own.cosine").alias("similarity"), F.col("own.line").alias("line"),
                      F.col("taken.dir").alias("inherited_from"))
