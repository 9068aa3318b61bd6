"""One query for each operator of this package, over its whole table, and the
oracle SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import (bpe, decontaminate, html_mincut, license_scan, line_dedup, prefix_trie, quality,
                         quality_zstd, shard, simhash, toxicity, url_filter, vector_codes)

TOKENIZER = "byte_bpe_50k.json"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file that the installed package of public tokenizers names."""
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def op1_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.extract(_read(spark, sf_dir, "pages")) \
        .withColumn("n_chars", F.length("text").cast("bigint"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components_of(_read(spark, sf_dir, "documents"), shingle=3)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_read(spark, sf_dir, "documents"),
                                 _read(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.deduplicate(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "text", F.col("_lines").alias("n_lines"),
                       F.col("_removed").alias("n_removed"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_read(spark, sf_dir, "documents"), tokenizer_path())


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the shards, reads them back and digests what stands in them."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = shard.read_shards(spark, shard.write_shards(docs), docs.schema)
    rows = rows.select("doc_id", shard.size_of(F.col("text")).alias("size"),
                       F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       "_shard", "_bucket", "_place")
    return shard.with_slots(rows).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        shard.shard_of(F.col("doc_id"), shard.SHARDS + 1).alias("grown_shard"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_read(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_read(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_read(spark, sf_dir, "conversations"))


def op13_quality_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_zstd.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_mincut": op1_html_mincut,
    "op2_simhash": op2_simhash,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_filter": op4_url_filter,
    "op5_line_dedup": op5_line_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_toxicity": op7_toxicity,
    "op8_bpe": op8_bpe,
    "op9_shards": op9_shards,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_quality_zstd": op13_quality_zstd,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op4_url_filter": url_filter.oracle(),
    "op11_vector_codes": vector_codes.oracle(),
    "op12_prefix_trie": prefix_trie.oracle(),
}
