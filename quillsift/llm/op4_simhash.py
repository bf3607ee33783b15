"""op4: fingerprints of all documents and the components of their links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import simhash


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
