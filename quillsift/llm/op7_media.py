"""op7: all texts as images in tar shards, with metadata and features read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import media
from .common import saved


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = media.store(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    places = media.catalogue(rows)
    known = saved(media.features(places).join(media.metadata(places), "digest"), "media-known")
    return rows.select("doc_id", "n_bytes", "digest").join(known, "digest").drop("digest")
