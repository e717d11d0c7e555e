"""Decontamination, mixing, line dedup and quality rules against brute force."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from haulgrain.llm import decontamination, line_dedup, quality_rules, source_mix
from haulgrain.llm.tables import written

SCHEMA = "doc_id long, text string, source string, h long, n_words string, key string"
SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def frame(spark, rows):
    """Rows (doc_id, text, source) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "x", None) for r in rows], SCHEMA)


# --- decontamination -------------------------------------------------------------------------

def passages(rows, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        w = pattern.findall(lower(text or ""))
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if w and item is not None else ():
            windows.setdefault(tuple(w[s:s + n]), set()).add(str(item))
    out = []
    for key, text, *_ in rows:
        w, hit, found = pattern.findall(lower(text or "")), set(), set()
        for x, own in windows.items():
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s:s + len(x)]) == x:
                    hit.update(range(s, s + len(x)))
                    found |= own
        out.append((key, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_passages_as_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["a", "b", "c", "Ä1", "d2", "e"]
    say = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(say(r.choice([1, 2, 5, 10, 14])))) for i in range(2, 14)] + [
        (20, None), (21, "  ,; "), (22, "rare x y z"), (None, "a b"), (22, "rare x y z"), (23, "RARE, x-y z")]
    rows = []
    for i in range(40):
        w = say(r.randint(0, 40))
        if r.random() < 0.6:
            w[3:3] = (r.choice(items)[1] or "").split(" ")
        rows.append((i, r.choice([" ", ", ", "\n"]).join(w).replace("a", r.choice("aA")), "s"))
    rows += [(None, "rare X y z rare x y z", "s"), (None, None, None), (7, "rare x y z", "s"), (7, "rare x y z", "s"), (50, "", "s"),
             (51, "b " * 20_000 + "rare x y z", "s")]
    items_frame = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_passages(frame(spark, rows), items_frame)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()]
    assert sorted(got, key=str) == passages(rows, items)


def test_passages_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = [(1, "a b c", "s")]
    assert [r["n_hit"] for r in decontamination.find_passages(frame(spark, rows), none).collect()] == [0]
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.find_passages(frame(spark, []), items).count() == 0


# --- line dedup ------------------------------------------------------------------------------

def deduped(rows, least):
    key = lambda x: lower(x.strip(SPACE))
    docs = Counter()
    for _, text in {(k, t) for k, t, *_ in rows}:
        docs.update({key(x) for x in (text or "").split("\n")})
    out = []
    for k, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not key(x) or docs[key(x)] < least]
        out.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_line_dedup_as_brute_force(spark):
    r = random.Random(4)
    lines = ["", " ", "Hot  line", "hot  line ", "\thot  LINE\r", "É", "é", *(f"line {i}" for i in range(12))]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 9))), "s") for i in range(40)]
    rows += [(None, "hot  line\nx", "s"), (None, None, None), (90, "", "s"), (3, "hot  line", "s"), (3, "hot  line", "s"),
             (91, "\n", "s"), (92, "hot  line\n" * 3_000 + "own", "s")]
    got = line_dedup.dedup_lines(frame(spark, rows), min_docs=10)
    assert sorted(map(tuple, got.collect()), key=str) == deduped(rows, 10)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


# --- mixing ----------------------------------------------------------------------------------

def water(sizes, weights, share, limit):
    """Targets by handing the excess on until none is above its limit."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > limit * sizes[s]}
        for s in full or open_:
            out[s] = limit * sizes[s] if full else level * weight[s]
        if not full:
            break
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def test_mix_meets_its_targets(spark):
    r = random.Random(6)
    rows = [(i, "w " * r.randint(0, 400), r.choice(["b", "b", "b", "b", "a", "c", "É", None])) for i in range(300)]
    rows += [(None, "one two", "tiny"), (900, None, "b"), (901, "", None), (902, "x " * 5_000, "c"), (5, "a b c", "dup"), (5, "a b c", "dup")]
    docs = frame(spark, rows)
    got = written(source_mix.mix_sources(docs, block=8), "mix")
    first = sorted(map(str, got.collect()))
    sizes, taken, goal = Counter(), Counter(), {}
    for row in got.collect():
        sizes[row["source"]] += row["size"]
        taken[row["source"]] += row["taken"]
        goal[row["source"]] = row["target"]
        assert 0 <= row["taken"] <= 2 * row["size"]
    assert len(first) == len(rows)
    want = water(sizes, (3, 1, 2), 1.5, 2)
    for s, size in sizes.items():
        assert goal[s] == pytest.approx(want[s], abs=1e-6)
        assert abs(taken[s] - want[s]) <= 40, s
    assert first == sorted(map(str, source_mix.mix_sources(docs.repartition(7), block=8).collect()))
    mixed = source_mix.apply_mix(docs, got)
    assert mixed.columns == docs.columns
    by_source = {x["source"]: x["n"] for x in mixed.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("n")).collect()}
    assert by_source == {s: n for s, n in taken.items() if n}


def test_mix_of_nothing(spark):
    assert source_mix.mix_sources(frame(spark, [])).count() == 0
    assert [r["taken"] for r in source_mix.mix_sources(frame(spark, [(1, None, None)])).collect()] == [0]


# --- quality rules ---------------------------------------------------------------------------

def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = {i + j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def quality_rows():
    r = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = i % 4 != 0
        w = ["".join(r.choice("abcdeé") for _ in range(r.randint(2, 7))) for _ in range(r.randint(12, 60))]
        if not good:
            w = [x + r.choice(["###", "***", "|"]) for x in w] if i % 8 else [x.upper() + "!!" for x in w]
        if i % 7 == 0:
            w += w[:8]
        rows.append((i, "\n".join(" ".join(w[k:k + 9]) for k in range(0, len(w), 9)), "s"))
        if i % 3:
            labels.append((i, int(good)))
    return rows, labels


def test_quality_rules(spark):
    rows, labels = quality_rows()
    odd = [(None, None, "s"), (None, "", "s"), (1000, "one two", "s"), (1001, "a b c d e " * 2_000, "s"), (1, "x " * 12, "s"),
           (1002, "ab cd\nab cd\n \nef", "s"), (1003, "a b c d e x a b c d e y b c d e x", "s")]
    docs = frame(spark, rows + odd)
    marks = spark.createDataFrame(labels + [(None, 0), (2, None), (3, 7), (4, 1), (4, 1)], "doc_id long, quality int")
    got = quality_rules.quality_verdicts(docs, marks).collect()
    want = sorted(((k, *counts(t)) for k, t, _ in rows + odd), key=str)
    assert sorted((tuple(r)[:6] for r in got), key=str) == want
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    truth = {k: k % 4 != 0 for k, _, _ in rows}
    judged = [(truth[r["doc_id"]], r["kept"]) for r in got if r["doc_id"] in truth and not r["base_failed"]]
    assert sum(a == b for a, b in judged) >= 0.97 * len(judged)


def test_quality_rules_without_labels(spark):
    docs = frame(spark, [(1, "a b c d e f g h i j k", "s"), (2, "a", "s")])
    marks = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted((r["doc_id"], r["kept"]) for r in quality_rules.quality_verdicts(docs, marks).collect()) == [(1, True), (2, False)]
    assert quality_rules.quality_verdicts(frame(spark, []), marks).count() == 0


