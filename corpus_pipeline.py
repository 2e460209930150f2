"""A training corpus from raw documents, stage by stage.

Each stage reads the whole table its predecessor left, as Parquet, and its
decisions take effect: rejected rows are gone, cut texts are shorter. A column
``n_chars`` follows the text. The last stage returns the codec's digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, near_dedup, quality, suffix_dedup
from tidegauge.llm.bpe import bpe_digest
from tidegauge.llm.queries import table, word_bpe
from tidegauge.llm.shared import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the model accept."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dedup.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of strings that occur more than once."""
    cut = suffix_dedup.drop_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and the decoded text."""
    return bpe_digest(docs, word_bpe())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("bpe_codec", bpe_codec),
]

#: Model fits, components and corpus-wide matches are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
