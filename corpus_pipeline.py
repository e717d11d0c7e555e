"""A corpus pipeline of five stages over the documents table; see STAGES and run()."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrain.llm import decontamination, jaccard_join, quality_rules, source_mix, token_files
from haulgrain.llm.tables import fresh_name, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts have too few words and go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = fresh_name(docs, "stats")
    scored = written(quality_rules.text_stats(docs, out=stats), "scored")
    narrow = scored.select("doc_id", F.col(stats).alias("stats"))
    rules = quality_rules.rules_from(narrow, labels)
    return scored.filter(quality_rules.keeps(rules, F.col(stats))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of least id, null ids last, then of least text hash.

    Rows without words are in no group and stay. Of rows with the same id and text one stays; rows that
    share an id but not their text are judged apart.
    """
    return jaccard_join.first_of_classes(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_passages(docs, items).filter("n_hit > 0").select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(found["hit_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["hit_hash"])
    return docs.join(found, same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with the words that it takes; n_chars follows the text."""
    mixed = source_mix.apply_mix(docs, source_mix.mix_sources(docs))
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else mixed


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; a row for each document in them."""
    import public_tokenizers

    return token_files.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


#: (name, function of (spark, docs, sf_dir)); each result is written and is the next one's docs.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("source_mix", mix),
    ("token_files", tokens),
]

#: The stages learn, hash and tokenize, which SQL does not express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
