"""The corpus pipeline stage by stage on a small corpus."""

import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from haulgrain.llm.tables import written


def corpus():
    r = random.Random(9)
    say = lambda n: " ".join("".join(r.choice("abcdefg") for _ in range(r.randint(2, 6))) for _ in range(n))
    item = say(15)
    rows, labels = [], []
    for i in range(150):
        text = say(r.randint(20, 80))
        if i % 5 == 0:
            text = " ".join(w + "###" for w in text.split())
        labels.append((i, int(i % 5 != 0), 0))
        rows.append((i, text))
    rows[3] = (3, rows[2][1])  # a copy
    rows[4] = (4, rows[2][1] + " end")  # a near copy
    rows[7] = (7, rows[7][1] + " " + item)  # a leak
    rows += [(200, None), (201, ""), (None, say(30)), (8, rows[8][1])]
    docs = [(k, t, "en", f"src{(k or 0) % 3}", len(t or ""), "extra") for k, t in rows]
    return docs, labels, [(0, item)]


def test_stages(spark, tmp_path):
    docs, labels, items = corpus()
    here = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, stats string").write.parquet(f"{here}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{here}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{here}/benchmark.parquet")
    table = spark.read.parquet(f"{here}/documents.parquet")
    columns, left = table.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        table = written(stage(spark, table, here), name)
        left[name] = sorted((r[0] for r in table.select("doc_id").collect()), key=str)
        if name != "token_files":
            assert table.columns == columns
        if name == "source_mix":
            assert table.filter(F.length("text") != F.col("n_chars")).count() == 0
            mixed = table.count()
    good = [k for k, *_ in docs if k is None or k < 150 and k % 5]
    assert left["quality_rules"] == sorted(good, key=str)
    alone = [k for k in set(good) if k not in (3, 4)]
    assert left["near_duplicates"] == sorted(alone, key=str)
    assert left["decontamination"] == sorted((k for k in alone if k != 7), key=str)
    assert set(left["source_mix"]) <= set(left["decontamination"]) and len(left["token_files"]) == mixed


def test_near_duplicates_of_odd_ids(spark):
    r = random.Random(4)
    say = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    one, two, three, four, long = say(40), say(40), say(40), say(40), say(30_000)
    rows = [(5, one), (9, one + " end"), (None, one), (None, one), (5, two), (7, two), (None, three), (None, three), (None, three + " end"),
            (3, four), (3, four), (3, four + " end"), (None, None), (None, None), (4, ""), (6, " \n"), (11, long), (10, "x " + long), (12, "x")]
    docs = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id long, text string, first_id int, text_hash int").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((x[0], x[1]) for x in got.collect()), key=str)
    classes = [r for r in kept if r[1] and r[1].strip()]
    assert sorted((r for r in kept if r not in classes), key=str) == sorted([(None, None), (None, None), (4, ""), (6, " \n")], key=str)
    # One row of each class: by least id, rows without an id only where no other is.
    assert len(classes) == 6 and {(5, one), (5, two), (10, "x " + long), (12, "x")} <= set(classes)
    assert sum(k is None and t.startswith(three) for k, t in classes) == 1 and sum(k == 3 for k, t in classes) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data here")
def test_run_on_empty_documents(spark, tmp_path):
    schema = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
