"""State that grows by batches: latest rows, upserts, appends, staleness, samples. Order is a column, never the layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, strip, text


def latest(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The last row of each key."""
    return ranked(df, keys, [F.col(o).desc() if isinstance(o, str) else o.desc() for o in order])


def earliest(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key."""
    return ranked(df, keys, [F.col(o).asc() if isinstance(o, str) else o.asc() for o in order])


def ranked(df: DataFrame, keys: list[str], order: list[Column], most: int = 1) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= most).drop("__rank")


def occurrence(df: DataFrame, keys: list[str], *order: str, name: str = "occurrence") -> DataFrame:
    """Numbers the rows of each key from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))


def append_new(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows, then new rows whose key is not there; missing columns are null."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows, and old rows whose key is not among them."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def merge_extra(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows with the columns that only the known table has."""
    extra = [c for c in known.columns if c not in rows.columns]
    return rows.join(known.select(key, *extra), key, "left")


def backfill(rows: DataFrame, known: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Own values where they are not blank, else those known."""
    other = known.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    out = rows.join(other, key, "left")
    return out.withColumns({c: F.when(~blank(c), F.col(c)).otherwise(F.col(f"__{c}")) for c in columns}).drop(*[f"__{c}" for c in columns])


def stale(snapshot: DataFrame, live: DataFrame, key: str, signature: str) -> DataFrame:
    """Keys whose signature is blank, missing among the live rows, or different there."""
    now = live.select(key, F.col(signature).alias("__live"))
    out = snapshot.join(now, key, "left")
    reason = F.when(F.col("__live").isNull(), "missing_live_row").when(blank(signature), "blank_signature").when(strip(text(signature)) != strip(text("__live")), "signature_mismatch")
    return out.withColumn("stale_reason", reason).filter("stale_reason is not null").drop("__live")


def reset_stale(df: DataFrame, status: str, signature: str, previous: str) -> DataFrame:
    """Status after a new snapshot: excluded rows and resolved rows with another signature are pending again."""
    s = F.lower(strip(text(status)))
    changed = strip(text(signature)) != strip(text(previous))
    reset = (s == "excluded") | ((s == "resolved") & changed)
    return df.withColumn("__reset", reset).withColumns({status: F.when(F.col("__reset"), "pending").otherwise(F.col(status)), "reset_reason": F.when(F.col("__reset"), "quality_snapshot_changed").otherwise("")}).drop("__reset")


def hash_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows in the order of a hash of key and seed: the same rows in any layout."""
    return df.withColumn("__h", F.md5(F.concat(F.col(key).cast("string"), F.lit("|" + seed)))).orderBy("__h", key).limit(n).drop("__h")


def extend_subset(df: DataFrame, covered: DataFrame, key: str, target: int, seed: str) -> DataFrame:
    """The covered rows, and as many others in the order of a hash as the target lacks."""
    have = df.join(covered.select(key), key, "left_semi")
    missing = max(0, target - have.count())
    return have.unionByName(hash_sample(df.join(covered.select(key), key, "left_anti"), key, missing, seed))


def mark(df: DataFrame, ids: DataFrame, key: str, flag: str, reason: str, why: str) -> DataFrame:
    """Flags the rows of these ids; their reason is set where it is blank."""
    hit = ids.select(key).distinct().withColumn("__hit", F.lit(True))
    out = df.join(hit, key, "left")
    out = out.withColumns({flag: F.coalesce(F.col("__hit"), F.col(flag)), reason: F.when(F.col("__hit") & blank(reason), why).otherwise(F.col(reason))})
    return out.drop("__hit")


def apply_decisions(df: DataFrame, decisions: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values of a decision table over those of the rows, where it has one for the key."""
    other = decisions.select(key, F.lit(True).alias("__has"), *[F.col(c).alias(f"__{c}") for c in columns])
    out = df.join(other, key, "left")
    return out.withColumns({c: F.when(F.col("__has"), F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).drop("__has", *[f"__{c}" for c in columns])
