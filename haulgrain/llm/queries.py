"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrain.llm import (
    decontamination,
    html_extraction,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    periodic_runs,
    quality_rules,
    secret_scan,
    source_mix,
    spelling_variants,
    token_files,
    topk_search,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    words = secret_scan.tokenizer_words(public_tokenizers.path("word_bpe_49k.json"))
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"), dictionary=words)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_guess", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
                        "spans", F.size("bits").cast("long").alias("n_scored"), F.round(F.array_max("bits"), 3).alias("most_bits"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_pages(_table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand in for files in the folders of their source and language."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string"))
    files = _table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan.scan_licenses(files, "doc_id")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix_sources(_table(spark, sf_dir, "documents")).drop("source", "parts")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def cycle(doc_id, n: int) -> np.ndarray | None:
    """Which of ``n`` words stands at each place: for a tenth of the ids, words repeat from some place on."""
    if doc_id is None or not n:
        return None
    tenth, last = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if last:
        return None
    since = tenth % n
    period = 1 + (n - since) // (3 + tenth % 8)
    place = np.arange(n)
    place[since:] = since + (place[since:] - since) % period
    return place


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_table(spark, sf_dir, "documents"), remap=cycle)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.count_words(_table(spark, sf_dir, "documents"), every=199)
    return spelling_variants.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_files": op3_token_files,
    "op4_html_extraction": op4_html_extraction,
    "op5_license_scan": op5_license_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_source_mix": op7_source_mix,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_topk_search": op11_topk_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}
