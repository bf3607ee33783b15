"""op3: all documents in windows of 4096 token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import packing


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
