"""N-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from haulgrain.llm import jaccard_join as op
from haulgrain.llm.shingle_hash import shingle_sets

SCHEMA = "doc_id long, text string, component_id string"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (key, *_) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(((k, len(s), least.get(find(i)) if s else k) for i, ((k, *_), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 4)))
    passage = [word() for _ in range(12)]
    rows = []
    for i in range(n):
        kind = r.random()
        if rows and kind < 0.5:
            w = (r.choice(rows)[1] or "").split(" ")
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = word()
            if r.random() < 0.3:
                w = w[:r.randint(1, len(w))]
        else:
            w = [word() for _ in range(r.randint(0, 60))]
            if r.random() < 0.4:
                w[5:5] = passage
        rows.append((i, r.choice([" ", "\n", "\t "]).join(w), "x"))
    return rows


@pytest.mark.parametrize("seed, hot, block", [(1, 1_000_000, 1_000_000), (2, 2, 60)])
def test_components_as_brute_force(spark, seed, hot, block):
    rows = corpus(seed)
    got = op.jaccard_components(spark.createDataFrame(rows, SCHEMA), hot=hot, block=block).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, None), (2, "", "a"), (3, " \n\t", "a"), (4, "One two", "a"), (5, "one  TWO", "b"), (None, "one two", "c"),
            (7, "a b c d e f", "x"), (7, "a b c d e f", "x"), (8, "a b c d e f", "x"), (9, long, None), (10, long + " end", None),
            (None, "x y z x y z q", None), (None, "x y z x y z q", None)]
    got = op.jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(spark):
    got = op.jaccard_components(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0


def test_prefix_tree_finds_all_links():
    r = random.Random(5)
    sets = [np.array(sorted({r.randrange(40) for _ in range(r.randint(1, 25))})) for _ in range(150)]
    sets = [np.array(x) for x in {tuple(s) for s in sets}]
    tree, mark = op.PrefixTree(sets), np.zeros(40, bool)
    for i, s in enumerate(sets):
        mark[:] = False
        mark[s] = True
        want = [j for j, t in enumerate(sets) if 4 * len(set(s) & set(t)) >= 3 * len(set(s) | set(t))]
        assert sorted(tree.linked(s, mark, (3, 4)).tolist()) == want, i


def test_hashes_do_not_depend_on_the_batch():
    texts = ["a b c d e f", None, "", "É é x Y z", "b", "A B  C d e f"]
    whole = {}
    for first, values, at in shingle_sets(pa.array(texts)):
        for i in range(len(at) - 1):
            whole[first + i] = values[at[i]:at[i + 1]].tolist()
    for i, t in enumerate(texts):
        (_, values, at), = shingle_sets(pa.array(["pad x", t, "z"]).slice(1, 1))
        assert values.tolist() == whole[i]
    assert whole[0] == whole[5] and len(whole[3]) == 1 and whole[1] == []
