"""Segments of an entity's pages: those on many pages are kept once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, strip, text

BLANK_LINE = r"\n\s*\n"


def split(df: DataFrame, entity: str, page: str, order: str, content: str, splitter: str = BLANK_LINE) -> DataFrame:
    """A row for each segment: its place, raw text, folded text's digest and length."""
    parts = F.filter(F.transform(F.split(text(content), splitter), strip), lambda x: x != "")
    rows = df.select(entity, F.col(page).alias("page"), F.col(order).alias("page_order"), F.posexplode(parts).alias("pos", "raw"))
    flat = collapse(F.col("raw"))
    return rows.withColumns({"normalized": flat, "digest": F.sha1(flat)})


def threshold(pages: Column, ratio: float) -> Column:
    """Pages that make a segment a duplicate; in doubles."""
    return F.greatest(F.lit(2), F.ceil(pages.cast("double") * F.lit(float(ratio))).cast("bigint"))


def duplicates(segments: DataFrame, entity: str, pages: DataFrame, least_chars: int, ratio: float, retain: bool = True) -> DataFrame:
    """Digests on so many of an entity's pages, with the page that keeps them. pages: entity and its number, page_total. A segment's length and preview are shuffled, not its text."""
    one = segments.filter(F.length("normalized") >= least_chars).groupBy(entity, "digest", "page").agg(F.min("page_order").alias("page_order"), F.max(F.length("normalized")).cast("bigint").alias("length"), F.max(F.substring("normalized", 1, 240)).alias("preview"))
    counted = one.groupBy(entity, "digest").agg(
        F.count("*").alias("page_count"),
        F.min_by("page", F.struct("page_order", "page")).alias("kept_page"),
        F.max("length").alias("length"),
        F.max("preview").alias("preview"),
    )
    out = counted.join(pages, entity).filter(F.col("page_count") >= threshold(F.col("page_total"), ratio)).drop("page_total")
    return out if retain else out.withColumn("kept_page", F.lit(None).cast(segments.schema["page"].dataType))


def flagged(segments: DataFrame, duplicate: DataFrame, entity: str) -> DataFrame:
    """Segments with is_duplicate and removed."""
    out = segments.join(duplicate.select(entity, "digest", "kept_page", F.lit(True).alias("__dup")), [entity, "digest"], "left")
    dup = F.coalesce("__dup", F.lit(False))
    return out.withColumns({"is_duplicate": dup, "removed": dup & ~F.coalesce(F.col("kept_page") == F.col("page"), F.lit(False))}).drop("__dup", "kept_page")


def pages(flags: DataFrame, entity: str, joiner: str = "\n\n") -> DataFrame:
    """Each page rebuilt from the segments it keeps, with counts of segments and characters."""
    kept = F.array_sort(F.collect_list(F.when(~F.col("removed"), F.struct("pos", "raw"))))
    length = F.length("raw")
    return flags.groupBy(entity, "page", "page_order").agg(
        F.count("*").alias("segments_total"),
        F.count_if(~F.col("removed")).alias("segments_kept"),
        F.count_if("removed").alias("segments_removed"),
        (F.sum(length) + len(joiner) * (F.count("*") - 1)).alias("chars_raw"),
        F.coalesce(F.sum(F.when(~F.col("is_duplicate"), length)), F.lit(0)).cast("bigint").alias("usable_chars"),
        F.array_join(F.transform(kept, lambda x: x["raw"]), joiner).alias("content"),
    )


def summary(rebuilt: DataFrame, entity: str) -> DataFrame:
    """Totals of each entity."""
    total = lambda c: F.sum(c).alias(c)
    return rebuilt.groupBy(entity).agg(F.count("*").alias("pages_written"), total("segments_total"), total("segments_removed"), total("chars_raw"), F.sum(F.length("content")).alias("chars_cleaned"), total("usable_chars"))
