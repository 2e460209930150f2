"""One query per operator, over its whole table, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import (
    decontaminate,
    divergence,
    near_dedup,
    perspectives,
    prefix_trie,
    quality,
    reshard,
    sim_hash,
    suffix_dedup,
    toxicity,
)
from tidegauge.llm.bpe import bpe_digest
from tidegauge.llm.token_output import read_digests, write_tokens
from tidegauge.llm.url_filter import Rule, judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The public word-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_tokens(table(spark, sf_dir, "documents"), word_bpe(), end_id=2)
    return read_digests(spark, path).withColumnRenamed("key", "doc_id")


def op2_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OLD_SHARDS = NEW_SHARDS = 8


def op4_min_flow_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From shards by source, which are as uneven as the sources, to even ones."""
    docs = table(spark, sf_dir, "documents")
    by_source = F.pmod(F.xxhash64("source"), F.lit(OLD_SHARDS))
    layout = reshard.write_layout(docs, by_source)
    even = reshard.reshard(layout, OLD_SHARDS, NEW_SHARDS, reshard.text_size(F.col("text")))
    read = even.rows.select(
        "doc_id",
        reshard.text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        "__shard",
        "__block",
    )
    return reshard.with_slots(even, read, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("__shard").alias("shard"),
        F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perspectives.render_perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return found.withColumn("mask", F.array_join(spans, ","))


def op6_near_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"), word_bpe())


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), "crc32(CAST({} AS STRING)) % 5 = 0"
    learned = ~F.expr(fold.format("__key"))
    field = toxicity.train(docs, table(spark, sf_dir, "labels"), only=learned)
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return toxicity.score_toxicity(docs, field).select(
        "doc_id",
        F.coalesce(F.expr(fold.format("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(spans, ",").alias("spans"),
    )


URL_RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_audit(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_sim_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim_hash.sim_classes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_token_blocks": op1_token_blocks,
    "op2_repeated_strings": op2_repeated_strings,
    "op3_benchmark_leaks": op3_benchmark_leaks,
    "op4_min_flow_shards": op4_min_flow_shards,
    "op5_perspectives": op5_perspectives,
    "op6_near_classes": op6_near_classes,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_quality_rules": op8_quality_rules,
    "op9_toxic_spans": op9_toxic_spans,
    "op10_url_verdicts": op10_url_verdicts,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sim_components": op13_sim_components,
}
ORACLE_SQL: dict[str, str] = {
    "op5_perspectives": perspectives.SQL,
    "op11_source_divergence": divergence.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
