"""From documents to packed windows: quality, near-duplicates, repeated passages, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillsift.llm import decontam, packing, quality, simhash, suffix
from quillsift.llm.common import saved, temporary
from quillsift.llm.op2_quality import KEPT


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score of quality is at least KEPT."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model, *docs.columns, score="__score").filter(f"`__score` >= {KEPT}").drop("__score")


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates, on shingles of five words."""
    return simhash.without_copies(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that an earlier one has."""
    return suffix.without_repeats(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 4096 token ids."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good), ("near_duplicates", different), ("repeated_passages", unrepeated), ("benchmark_passages", unleaked), ("packing", packed)]

#: SQL expresses none of these stages over whole tables; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark):
            docs = saved(stage(spark, docs, sf_dir), f"stage-{name}", lasting=True)
    return STAGES[-1][1](spark, docs, sf_dir)
