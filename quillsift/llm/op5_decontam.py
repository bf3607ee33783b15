"""op5: benchmark items in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits and item_bytes: a row for each document and each item that it holds."""
    return decontam.leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
