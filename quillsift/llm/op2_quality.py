"""op2: the quality of all documents, learned from positives and unlabelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality

#: The least score of a document that is kept.
KEPT = 0.3


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return quality.scored(docs, model, "doc_id").select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= KEPT, 1).otherwise(0).alias("predicted"))
