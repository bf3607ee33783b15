"""op1: all pages as WARC records, written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import warc

SQL = """WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)"""


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(spark.read.parquet(f"{sf_dir}/pages.parquet"))).drop("url")
