"""op10: the visible text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", F.length("text").cast("bigint").alias("n_chars"), "text")
