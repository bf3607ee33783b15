"""Incremental forms: a stream of attempts or decisions keeps a table of the latest row of each key; staleness against a table; counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import blank, strip, text
from ..operators.incremental import latest
from ..sources import folders

#: Parts of a table of latest rows: a batch writes those anew that its keys fall into.
PARTS = 64


def keep_latest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], parts: int = PARTS, **trigger) -> StreamingQuery:
    """Keeps the table of latest rows at path, dealt by a hash of the keys into parts that must not change.

    A batch writes a new version of the parts it touches, then the list of all parts' versions: until that is there,
    readers see the table as it was, and a batch that is run again, or whose stream begins anew with another checkpoint, goes on from
    there. order must tell the rows of a key apart. Versions that neither the last nor the last but one list names are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("__part", part_of(keys, parts))
        batch.persist()
        try:
            touched = [r[0] for r in rows.select("__part").distinct().collect()]  # at most `parts` numbers
            if not touched:
                return
            before, old = listed(spark, path), versions(spark, path)
            version = max(old, default=-1) + 1
            known = [p for p in touched if p in before]
            if known:
                earlier = spark.read.schema(batch.schema).parquet(*[f"{path}/rows/version={before[p]}/__part={p}" for p in known])
                rows = earlier.withColumn("__part", part_of(keys, parts)).unionByName(rows)
            target = f"{path}/rows/version={version}"
            latest(rows, keys, *order).repartition("__part").write.mode("overwrite").partitionBy("__part").parquet(target)
            now = before | dict.fromkeys(touched, version)
            spark.createDataFrame(sorted(now.items()), "part int, version int").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists/version={version}")
            for v in old[:-1]:
                folders.delete(spark, f"{path}/lists/version={v}")
            needed = set(now.values()) | set(before.values())
            for name in folders.names(spark, f"{path}/rows"):
                if name.startswith("version=") and int(name[8:]) not in needed:
                    folders.delete(spark, f"{path}/rows/{name}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def part_of(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the lists that are whole, ascending."""
    found = [n for n in folders.names(spark, f"{path}/lists") if n.startswith("version=")]
    return sorted(int(n[8:]) for n in found if folders.exists(spark, f"{path}/lists/{n}/_SUCCESS"))


def listed(spark: SparkSession, path: str) -> dict[int, int]:
    """The version of each part in the last list."""
    found = versions(spark, path)
    return {r.part: r.version for r in spark.read.parquet(f"{path}/lists/version={found[-1]}").collect()} if found else {}


def read_latest(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table of latest rows; empty before the first batch."""
    now = listed(spark, path)
    if not now:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/rows/version={v}/__part={p}" for p, v in sorted(now.items())])


def stale_stream(snapshots: DataFrame, live: DataFrame, key: str, signature: str) -> DataFrame:
    """Rows of a stream whose signature is blank, or not the one that a table has now, each with the reason: a join of stream and table, without state."""
    now = live.select(key, F.col(signature).alias("__live"))
    own, then = strip(text(signature)), strip(text("__live"))
    reason = F.when(F.col("__live").isNull(), "missing_live_row").when(blank(signature), "blank_signature").when(own != then, "signature_mismatch")
    return snapshots.join(now, key, "left").withColumn("stale_reason", reason).filter("stale_reason is not null").drop("__live")


def counts_by_window(stream: DataFrame, time: str, key: str, late: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Counts of a key by window of event time; rows later than the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
