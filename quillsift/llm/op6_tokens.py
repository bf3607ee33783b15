"""op6: token ids of all documents, coded, written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import huffman


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files, _ = huffman.store(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    return huffman.read_files(files)
