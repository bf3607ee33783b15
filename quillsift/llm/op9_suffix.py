"""op9: bytes of all documents that a document with a smaller doc_id has too, in strings of 50."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import suffix


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.removal(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
