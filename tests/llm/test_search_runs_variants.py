"""Top-k search, periodic runs and spelling variants against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulgrain.llm import periodic_runs, spelling_variants, topk_search
from haulgrain.llm.queries import QUERIES, cycle
from haulgrain.llm.suffix_tree import Extensions, SuffixTree

VECTORS = "vec_id long, embedding array<float>, id long, row string, query string, score long"
DOCUMENTS = "doc_id long, text string, id string, n long, words string, runs string, word string"


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", "y", 2) for k, v in rows], VECTORS)


def documents(spark, rows):
    return spark.createDataFrame([(k, t, "x", 1, "y", "z", None) for k, t in rows], DOCUMENTS)


# --- top-k search ----------------------------------------------------------------------------

def best_rows(rows, k, scale=64.0):
    usable = [(key, [max(-2 ** 63, min(2 ** 63 - 1, math.floor(scale * x))) for x in v]) for key, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, (key, v) in enumerate(usable):
        if key is None or key % 20:
            continue
        scored = [(-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(v, w)))), c is None, c or 0, c) for j, (c, w) in enumerate(usable) if j != i]
        out += [(key, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def search(frame, k=20, **more):
    found = topk_search.top_k(frame, F.col("vec_id") % 20 == 0, k, **more)
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"group_terms": 200, "query_terms": 30}])
def test_search_as_brute_force(spark, limits):
    r = random.Random(1)
    rows = [(i, [float(np.float32(r.choice([0, 0, r.gauss(0, 0.2)]))) for _ in range(7)]) for i in range(130)]
    rows += [(140, None), (160, [1.0, None, 1.0]), (180, [float("nan")] * 7), (200, [float("inf"), 1.0]), (220, []), (240, [2.0]),
             (None, [0.5] * 7), (None, [0.5] * 9), (-20, [0.25] * 7), (0, rows[0][1]), (0, rows[0][1]), (41, rows[40][1]),
             (260, [0.0] * 7)]
    assert search(vectors(spark, rows).repartition(3), 5, **limits) == best_rows(rows, 5)


def test_search_of_huge_components(spark):
    big = [3e8, 1e17, -1e17, 3e38, -3e38, 0.0, 1.0]
    rows = [(20 * i, [float(np.float32(x)), 1.0]) for i, x in enumerate(big)] + [(1, [0.5, -0.5])]
    assert search(vectors(spark, rows), 8) == best_rows(rows, 8)


def test_search_of_few_rows(spark):
    assert search(vectors(spark, [])) == []
    assert search(vectors(spark, [(20, [1.0])])) == []
    assert search(vectors(spark, [(20, [1.0]), (3, [2.0])])) == [(20, 1, 3, 64 * 128)]
    same = [(i, [0.5, 0.5]) for i in range(60)]
    assert search(vectors(spark, same)) == best_rows(same, 20)


# --- periodic runs ---------------------------------------------------------------------------

def all_runs(words, least=12):
    found = []
    for q in range(1, len(words) // 2 + 1):
        since = 0
        while since + q < len(words):
            upto = since
            while upto + q < len(words) and words[upto] == words[upto + q]:
                upto += 1
            own = words[since:upto + q]
            if len(own) >= max(least, 2 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                found.append((since, len(own), q))
            since = upto + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated(r, n, letters):
    words = [r.choice(letters) for _ in range(n)]
    for _ in range(r.randint(0, 3)):
        since = r.randrange(n)
        period = r.randint(1, max(1, (n - since) // 2))
        for i in range(since, min(n, since + r.randint(2, 5) * period)):
            words[i] = words[since + (i - since) % period]
    return words


def test_stretches_as_brute_force():
    r = random.Random(2)
    for _ in range(400):
        words = repeated(r, r.randint(2, 70), range(1, r.choice([2, 3, 4, 9])))
        least = r.choice([2, 5, 12])
        assert [tuple(x) for x in periodic_runs.stretch_runs(np.array(words), least).tolist()] == all_runs(words, least)


def test_filter_keeps_every_run():
    r = random.Random(3)
    for _ in range(300):
        parts = [repeated(r, r.randint(1, 60), range(1, r.choice([3, 30]))) for _ in range(3)]
        least = r.choice([2, 5, 12])
        covered = periodic_runs._covered(np.array(sum(parts, [])), np.array([len(p) for p in parts]), least // 2)
        since = 0
        for part in parts:
            found = periodic_runs.document_runs(np.array(part), covered[since:since + len(part)], least)
            assert [tuple(x) for x in found.tolist()] == all_runs(part, least)
            since += len(part)


def test_extensions_as_brute_force():
    r = random.Random(4)
    for _ in range(60):
        text = [r.randint(1, 2) for _ in range(r.randint(1, 90))]
        reach = Extensions(*SuffixTree(text).leaves())
        pairs = [(a, b) for a in range(len(text) + 1) for b in range(len(text) + 1) if a != b]
        want = []
        for a, b in pairs:
            n = 0
            while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                n += 1
            want.append(n)
        assert reach(*(np.array(x) for x in zip(*pairs))).tolist() == want


def test_tour_orders_suffixes():
    r = random.Random(5)
    for _ in range(60):
        text = [r.randint(1, 3) for _ in range(r.randint(0, 50))]
        for backwards in (False, True):
            key = lambda i: [(-x if backwards else x) if x else -9 for x in [*text[i:], 0]]  # noqa: B023, E731
            assert SuffixTree(text).leaves(backwards)[0].tolist() == sorted(range(len(text) + 1), key=key)


def run_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_runs_query_as_brute_force(spark, tmp_path):
    r = random.Random(6)
    rows = []
    for i in range(150):
        words = repeated(r, r.randint(1, 120), ["a", "A", "b\x1cc", "é\x85", "漢", "d.", *map(str, range(r.choice([1, 40])))])
        rows.append((i, r.choice([" ", "\n", "\t\x0b "]).join(words)))
    rows += [(None, "x " * 40), (None, None), (7, None), (8, ""), (9, " \n\r\x0c"), (10, "one two"), (3, rows[3][1]), (3, rows[3][1]), (11, "x" * 30_000)]
    documents(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path))
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted((run_row(*x) for x in rows), key=str)
    assert any(cycle(i, 50) is not None for i in range(150))


def test_long_and_no_documents(spark):
    rows = [(1, "a b c " * 20_000), (2, " ".join(map(str, range(60_000)))), (3, "w " * 30_000)]
    got = {x["doc_id"]: x for x in periodic_runs.find_runs(documents(spark, rows)).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 60_000, 3)] and got[1]["collapsed"] == "a b c"
    assert got[2]["runs"] == [] and got[2]["collapsed"] == rows[1][1]
    assert [tuple(x) for x in got[3]["runs"]] == [(0, 30_000, 1)] and got[3]["collapsed"] == "w"
    assert periodic_runs.find_runs(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(documents(spark, []), min_length=1)


# --- spelling variants -----------------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(counts, ratio=5):
    form, out = {}, []
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root))
    return sorted(out)


@pytest.mark.parametrize("block", [1024, 3])
def test_variants_as_brute_force(spark, block):
    r = random.Random(7)
    counts = {}
    while len(counts) < 500:
        word = "".join(r.choice("abcdé") for _ in range(r.randint(1, 5)))
        for _ in range(3):
            counts.setdefault(word, 5 ** r.randint(1, 8) + r.randint(0, 2))
            at = r.randrange(len(word) + 1)
            word = (word[:at] + r.choice(["", "x", "漢", "a"]) + word[at + r.randint(0, 1):]) or "z"
    counts |= {"k" * 3000: 50, "k" * 2999: 9, "K" + "k" * 2999: 7, "k" * 2998 + "jk": 800}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling_variants.variants(frame, block=block)
    assert sorted(tuple(x) for x in got.select("word", "n", "n_near", "form", "form_n", "root").collect()) == grouped(counts)


def counted(rows, least, every):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{key}:{run}".encode())
            if every and key is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def test_words_as_brute_force(spark, monkeypatch):
    r = random.Random(8)
    words = ["letters", "LETTERS", "Ärgernis", "ärgernis", "naïveté×÷", "shortt", "tinyy", "two-parted", "漢字letters", "ŝletters", "o'clock", "straße"]
    rows = [(i, r.choice([" ", ",", "\n", "\U0001f600"]).join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(40)]
    rows += [(None, "letters " * 9), (None, None), (5, ""), (6, "q" * 40_000), (7, " ".join(["q" * 40_000] * 6)), (1, rows[1][1])]
    for every in (None, 3):
        got = spelling_variants.count_words(documents(spark, rows).repartition(2), every=every)
        assert dict(map(tuple, got.collect())) == counted(rows, 5, every)
    monkeypatch.setattr(spelling_variants, "HELD_WORDS", 3)
    parts = list(spelling_variants._count(6, None)(documents(spark, rows).select("doc_id", "text").toArrow().to_batches()))
    assert len(parts) > 1 and sum(sum(p.column(1).to_pylist()) for p in parts) == sum(counted(rows, 1, None).values())


def test_variants_of_few_words(spark):
    schema = "word string, n long"
    assert spelling_variants.variants(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(x) for x in spelling_variants.variants(spark.createDataFrame([("abc", 5)], schema)).select("word", "form", "root", "n_near").collect()] == [("abc", None, "abc", 0)]
    assert spelling_variants.count_words(documents(spark, [])).count() == 0
