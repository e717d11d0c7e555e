"""Licence headers against a brute-force TF-IDF over every run of lines, and hot keys against their plans."""

import math
import random
import re
from collections import Counter

from haulgrain.llm import license_scan
from haulgrain.llm.graph import components
from haulgrain.llm.tables import split_join

TEMPLATES = [("A", "granted to any person under the red licence of the guild"), ("B", "under the blue licence version two of the guild"),
             ("C", "all copies must keep this whole notice"), ("D", "blue")]


def words(text):
    return [w for w in re.split(r"[^\x80-\U0010FFFFA-Za-z0-9]+", text.lower()) if w]


def best_units(docs, threshold):
    """License, cosine and first line of each text: every run of lines and every whole text is compared."""
    split = {k: [(i, words(x)) for i, x in enumerate(t.split("\n")) if words(x)] for k, t in docs.items()}
    total = sum(1 + len(t.split("\n")) for t in docs.values())
    found = Counter()
    for lines in split.values():
        units = [set(w for _, x in lines for w in x)] + ([set(x) for _, x in lines] if len(lines) > 1 else [])
        for unit in units:
            found.update(unit)
    known = {w for _, t in TEMPLATES for w in words(t)}
    rarity = lambda w: math.log((1 + total) / (1 + (found[w] if w in known else 0))) + 1.0
    vectors = [(name, {w: n * rarity(w) for w, n in Counter(words(t)).items()}) for name, t in TEMPLATES]
    longest = max(len(words(t)) for _, t in TEMPLATES) * 5 // 4 + 10
    out = {}
    for k, lines in split.items():
        best = None
        units = [(-1, -1, lines)] if lines else []
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if b - a + 1 < len(lines) and sum(len(x) for _, x in lines[a:b + 1]) <= longest:
                    units.append((lines[a][0], lines[b][0], lines[a:b + 1]))
        for start, stop, unit in units:
            own = {w: n * rarity(w) for w, n in Counter(w for _, x in unit for w in x).items()}
            size = math.sqrt(sum(x * x for x in own.values()))
            for name, vector in vectors:
                length = math.sqrt(sum(x * x for x in vector.values()))
                cosine = round(sum(x * vector.get(w, 0) for w, x in own.items()) / size / length, 9)
                if cosine >= threshold:
                    key = (-cosine, name, start, stop)
                    best = min(best, key) if best else key
        out[k] = (best[1], -best[0], best[2]) if best else None
    return out


def test_headers_as_brute_force(spark):
    r = random.Random(9)
    vocabulary = sorted({w for _, t in TEMPLATES for w in words(t)}) + ["alpha", "beta", "Gamma", "x9", "é"]
    docs = {}
    for i in range(120):
        lines = [r.choice([" ", ", ", " // "]).join(r.choice(vocabulary) for _ in range(r.randint(0, 6))) for _ in range(r.randint(0, 9))]
        if r.random() < 0.7:
            header = words(r.choice(TEMPLATES)[1])
            cut = r.randint(0, len(header))
            lines[1:1] = [" ".join(header[:cut]), "# " + " ".join(header[cut:])]
        docs[i] = "\n".join(lines)
    frame = spark.createDataFrame([(k, None, t) for k, t in docs.items()], "id long, path string, text string").repartition(3)
    for threshold in (0.75, 0.9):
        got = {x["id"]: x for x in license_scan.scan_licenses(frame, templates=TEMPLATES, threshold=threshold).collect()}
        want = best_units(docs, threshold)
        assert sum(x is not None for x in want.values()) > 30
        for k, x in want.items():
            found = got[k]
            assert (found["license"], found["line"]) == ((x[0], x[2]) if x else (None, None)), (k, docs[k], x, found)
            assert x is None or abs(found["similarity"] - x[1]) < 1e-8


def skewed_reads(frame):
    """Reads of a shuffle that adaptive execution split, in the final plan of a query that ran."""
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().count("skewed")


def test_hot_keys_are_split(spark):
    """A star of edges and a common line: the lookup is shuffled for the join, so the hot key is dealt over tasks."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
               "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 6000, 1, 8).selectExpr("if(id % 10 < 8, 7, id) AS u", "id AS v")
        least = rows.groupBy("u").agg({"v": "min"}).withColumnRenamed("min(v)", "m")
        assert skewed_reads(rows.join(least, "u")) == 0
        assert skewed_reads(split_join(rows, least, ["u"])) > 0
        assert sorted(map(tuple, split_join(rows, least, ["u"]).collect())) == sorted(map(tuple, rows.join(least, "u").collect()))
        star = components(spark.range(1, 500).selectExpr("0L AS a", "id AS b"))
        assert {x["component"] for x in star.collect()} == {0} and star.count() == 500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
