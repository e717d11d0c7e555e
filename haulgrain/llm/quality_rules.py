"""Operator 10: quality rules learned as a decision list.

Each text gets a row of statistics from built-in functions. Over labelled rows, sequential covering
grows a conjunction of thresholds by information gain on two thirds of the rows, prunes it on the
other third, takes away the rows it covers and starts again. The rules become one ordered Spark
conditional expression. A learning step is one aggregate that returns a count for each feature and
bin, so the driver sees a fixed number of rows whatever the size of the corpus.

Labelled rows are bounded by ``max_labelled`` (those with the least hash of their id); statistics and
verdicts cover every row. Nulls: a null text has no words and no lines. Labels that are null, or
not 0 or 1, are left out; of repeated labels each counts. Without labels of both kinds no rule is
learned. Repeated rows are all judged; ids, also null ones, only serve to find the label. An empty
table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.llm.tables import let, written

_SPACE = " \t\n\x0b\x0c\r"
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
            "distinct_share", "mark_share", "line_words"]


def _words(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+", -1))


def _repeated(windows: Column) -> Column:
    """Words in windows of five that occur at least twice, from the windows' hashes in order."""

    def covered(at: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), F.lit(0).cast("long"),
                           lambda n, k: n + F.coalesce(F.least(F.lit(5), F.get(at, k + 1) - F.get(at, k)), F.lit(5)))

    def places(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(ordered, a)["h"] == F.get(ordered, b)["h"], F.lit(False))
        hit = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1),
                       lambda j: same(j, j + 1) | F.when(j > 0, same(j, j - 1)).otherwise(False))
        return F.array_sort(F.transform(hit, lambda j: F.get(ordered, j)["i"]))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        let(ordered, lambda o: let(places(o), covered)))


def _windows(hashes: Column) -> Column:
    """Hashes of the windows of five words; none for fewer words."""
    at = F.sequence(F.lit(0), F.size(hashes) - 5)
    return F.when(F.size(hashes) < 5, F.array().cast("array<long>")).otherwise(
        F.transform(at, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(5)))))


def text_stats(docs: DataFrame, text_col: str = "text", out: str = "stats") -> DataFrame:
    """``docs`` with a struct column of the statistics and features of its texts."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    count = lambda x, pattern: F.regexp_count(x, F.lit(pattern))

    def measure(text: Column, words: Column, windows: Column, lines: Column) -> Column:
        n = F.size(words).cast("long")
        bare = text
        for blank in _SPACE:
            bare = F.replace(bare, F.lit(blank))
        chars = F.length(bare).cast("long")
        symbols = count(text, r"[#*$%&|<>]").cast("long")
        dup = (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
        repeat = _repeated(windows)
        share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
        values = {
            "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeat,
            "words": n.cast("double"), "word_length": share(chars, n), "symbol_share": share(symbols, chars),
            "dup_line_share": share(dup, F.size(lines)), "repeat_share": share(repeat, n),
            "upper_share": share(count(text, "[A-Z]"), chars),
            "distinct_share": share(F.size(F.array_distinct(words)), n),
            "mark_share": share(count(text, "[!?]"), chars), "line_words": share(n, F.size(lines)),
        }
        return F.struct(*(v.alias(k) for k, v in values.items()))

    whole = lambda text: let(
        F.struct(_words(text).alias("w"),
                 F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(_SPACE)) != "").alias("l")),
        lambda s: let(_windows_of(s["w"]), lambda v: measure(text, s["w"], v, s["l"])))
    return docs.withColumn(out, whole(t))


def _windows_of(words: Column) -> Column:
    return let(F.transform(words, lambda w: F.xxhash64(w)), _windows)


@dataclass(frozen=True)
class Condition:
    """``feature`` at least, or below, a threshold."""

    feature: str
    above: bool
    threshold: float

    def on(self, stats: Column) -> Column:
        value = stats[self.feature]
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Condition, ...]


def _holds(rule: Rule, cuts: dict[str, list[float]]) -> Column:
    """The rule over binned features: bin b holds values from cut b - 1 up to cut b."""
    out = F.lit(True)
    for c in rule:
        b = cuts[c.feature].index(c.threshold) + 1
        out = out & (F.col(c.feature) >= b if c.above else F.col(c.feature) < b)
    return out


def _bin(feature: str, cuts: list[float]) -> Column:
    """The number of cuts that are at most the value."""
    return sum((F.when(F.col(feature) >= c, 1).otherwise(0) for c in cuts), F.lit(0))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _least_hashes(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows of least id hash.

    Counts by the leading bits of the hash tell from where on no row is wanted, so that few more rows
    than wanted reach the task that ends the sort, whatever the number of partitions.
    """
    lead = F.shiftright(F.xxhash64("id"), 48)
    upto, cut = 0, None
    for lead_bits, n in sorted(map(tuple, rows.groupBy(lead.alias("lead")).count().collect())):  # 65,536 rows at most
        upto += n
        if upto >= most:
            cut = lead_bits
            break
    rows = rows if cut is None else rows.filter(lead <= cut)
    return rows.orderBy(F.xxhash64("id"), "id", "word_chars", "n_words").limit(most)


def learn_rules(labelled: DataFrame, stats_col: str = "stats", label_col: str = "quality", id_col: str = "doc_id",
                max_labelled: int = 200_000, bins: int = 24, max_rules: int = 8, max_conditions: int = 3,
                min_precision: float = 0.95) -> list[Rule]:
    """An ordered list of rules that reject, from rows with statistics and a 0/1 label (0 is rejected)."""
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), (F.col(label_col) == 0).alias("bad"), f"{stats_col}.*")
    rows = _least_hashes(rows, max_labelled)
    rows = written(rows.select("bad", (F.pmod(F.xxhash64(F.lit(3), "id", "word_chars"), F.lit(3)) < 2).alias("grow"), *FEATURES), "labelled")

    steps = [k / bins for k in range(1, bins)]
    exact = [F.percentile(f, F.lit(steps)).alias(f) for f in FEATURES]
    cuts: dict[str, list[float]] = {f: [] for f in FEATURES}
    for row in rows.groupBy("bad").agg(*exact).collect():  # two rows
        for f in FEATURES:
            cuts[f] = sorted({*cuts[f], *row[f]})
    binned = written(rows.select("bad", "grow", *(_bin(f, cuts[f]).alias(f) for f in FEATURES)), "binned")

    def counts(rule: Rule, done: list[Rule]) -> dict:
        """{(feature, bin): [grow bad, grow good, prune bad, prune good]} of rows that the rule covers."""
        left = binned.filter(_holds(rule, cuts))
        for r in done:
            left = left.filter(~_holds(r, cuts))
        cells = left.select("bad", "grow", F.explode(F.array(*(
            F.struct(F.lit(i).alias("f"), F.col(f).alias("b")) for i, f in enumerate(FEATURES)))).alias("c"))
        found = cells.groupBy("c.f", "c.b").agg(*(
            F.count_if((F.col("grow") == g) & (F.col("bad") == b)).alias(f"k{i}")
            for i, (g, b) in enumerate([(True, True), (True, False), (False, True), (False, False)])))
        return {(FEATURES[r["f"]], r["b"]): [r["k0"], r["k1"], r["k2"], r["k3"]] for r in found.collect()}

    def total(cells: dict) -> list[int]:
        own = [v for (f, _), v in cells.items() if f == FEATURES[0]]
        return [sum(x) for x in zip(*own, strict=True)] if own else [0, 0, 0, 0]

    rules: list[Rule] = []
    cells = counts((), rules)
    while len(rules) < max_rules and total(cells)[0] and total(cells)[1]:
        rule: Rule = ()
        covered = [total(cells)]
        while len(rule) < max_conditions and covered[-1][1]:
            p0, n0 = covered[-1][:2]
            best, pick = 1e-9, None
            for f in FEATURES:
                for k, cut in enumerate(cuts[f], 1):
                    p, n = (sum(v[i] for (g, b), v in cells.items() if g == f and b >= k) for i in (0, 1))
                    for above, a, c in ((True, p, n), (False, p0 - p, n0 - n)):
                        if (gain := _gain(a, c, p0, n0)) > best:
                            best, pick = gain, Condition(f, above, cut)
            if pick is None:
                break
            rule += (pick,)
            cells = counts(rule, rules)
            covered.append(total(cells))
        # Prune: the shortest form that does best on the rows kept back.
        worth = [(c[2] - c[3]) / (c[2] + c[3]) if c[2] + c[3] else -1.0 for c in covered]
        keep = max(range(1, len(covered)), key=lambda k: (worth[k], -k), default=0)
        if not keep or sum(covered[keep][::2]) < min_precision * sum(covered[keep]):
            break
        rules.append(rule[:keep])
        cells = counts((), rules)
    return rules


def rejected(rules: list[Rule], stats: Column) -> Column:
    """The list as one ordered conditional: true at the first rule that holds, else false."""
    out = None
    for rule in rules:
        holds = F.lit(True)
        for c in rule:
            holds = holds & c.on(stats)
        out = F.when(holds, True) if out is None else out.when(holds, True)
    return F.lit(False) if out is None else out.otherwise(False)


def base_failed(stats: Column, min_words: int = 10, max_repeat_percent: int = 20) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (stats["n_words"] < min_words) | (100 * stats["n_repeat_words"] > max_repeat_percent * stats["n_words"])


def rules_from(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
               **learning) -> list[Rule]:
    """Rules from rows (id, stats), a written table, and the labels of some ids."""
    marks = labels.select(F.col(id_col).alias("_label_id"), F.col(label_col).alias("_label"))
    labelled = scored.select(F.col(id_col).alias("_id"), "stats").join(marks, F.col("_id") == F.col("_label_id"))
    return learn_rules(labelled, "stats", "_label", "_id", **learning)


def keeps(rules: list[Rule], stats: Column) -> Column:
    """The verdict on a row's statistics."""
    return ~base_failed(stats) & ~rejected(rules, stats)


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **learning) -> DataFrame:
    """(id, the statistics, base_failed, kept) for each row of ``docs``."""
    scored = written(text_stats(docs.select(id_col, text_col), text_col).select(id_col, "stats"), "stats")
    rules = rules_from(scored, labels, id_col, **learning)
    stats = F.col("stats")
    return scored.select(id_col, *(f"stats.{s}" for s in STATS), base_failed(stats).alias("base_failed"),
                         keeps(rules, stats).alias("kept"))
