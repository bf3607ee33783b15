"""op8: the language of all documents, by words and n-grams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    found = langid.predicted(docs, langid.learn(docs, rest != 1), "doc_id")
    return found.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
