"""Text tables and documents: CSV as text, JSON, page files, robots and sitemaps, positioned words; and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip, text


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV with a header, every column as text; a missing value is an empty text."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.csv(path)
    return df.select([F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c.lstrip("﻿")) for c in df.columns])


def read_or_empty(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with these columns, empty texts for those it lacks; an empty table if there is none."""
    empty = spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    try:
        df = read_csv(spark, path)
        found = df.columns
    except Exception as e:  # Spark's own error for a path that does not exist
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty
    return df.withColumns({c: F.lit("") for c in columns if c not in found}).select(*columns)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files with their entity (the folder) and name."""
    rows = spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())
    name = F.regexp_extract("path", r"([^/]+)/([^/]+)$", 2)
    return rows.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("entity"), name.alias("page"), F.regexp_extract(name, r"^(\d+)", 1).try_cast("int").alias("page_order"), F.col("value").alias("content"))


def robots_sitemaps(robots: Column | str) -> Column:
    """The addresses of `Sitemap:` lines, comments aside."""
    lines = F.transform(F.split(text(robots), r"\r\n|\r|\n"), lambda x: strip(F.regexp_replace(x, "#.*$", "")))
    urls = F.transform(F.filter(lines, lambda x: x.rlike("(?i)^sitemap:")), lambda x: strip(F.regexp_replace(x, "(?i)^sitemap:", "")))
    return F.array_distinct(F.filter(urls, lambda x: x != ""))


def sitemap_entries(xml: Column | str) -> Column:
    """Entries of a sitemap or its index: loc, lastmod, priority and whether loc is a sitemap itself. By patterns, so bad XML gives what it has."""
    entries = F.regexp_extract_all(text(xml), F.lit(r"(?is)(<(?:\w+:)?(?:url|sitemap)>.*?</(?:\w+:)?(?:url|sitemap)>)"), 1)
    tag = lambda x, t: strip(F.regexp_extract(x, rf"(?is)<(?:\w+:)?{t}>(.*?)</(?:\w+:)?{t}>", 1))
    rows = F.transform(entries, lambda x: F.struct(F.replace(tag(x, "loc"), F.lit("&amp;"), F.lit("&")).alias("loc"), tag(x, "lastmod").alias("lastmod"), tag(x, "priority").try_cast("double").alias("priority"), x.rlike(r"(?i)^<(?:\w+:)?sitemap>").alias("is_index")))
    return F.filter(rows, lambda x: x["loc"] != "")


def robots_allows(robots: Column | str, path: Column) -> Column:
    """Whether the rules for all agents allow a path: the longest prefix decides, allowing wins ties. Unreadable rules allow."""
    block = F.regexp_extract(text(robots), r"(?is)user-agent:\s*\*\s*\n(.*?)(?:\n\s*user-agent:|\z)", 1)
    rule = lambda kind: F.filter(F.transform(F.regexp_extract_all(block, F.lit(rf"(?im)^\s*{kind}:[ \t]*([^\s#]*)"), 1), lambda x: x), lambda x: (x != "") & path.startswith(x))
    longest = lambda a: F.coalesce(F.array_max(F.transform(a, F.length)), F.lit(-1))
    return longest(rule("allow")) >= longest(rule("disallow"))


def links(html: Column | str, base: Column) -> Column:
    """Addresses of the links of a page, made absolute against its own."""
    found = F.regexp_extract_all(text(html), F.lit(r"""(?is)<a\s[^>]*?href=["']([^"'#]+)"""), 1)
    root = F.regexp_extract(base, r"^([A-Za-z][\w+.\-]*://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "/")

    def absolute(x: Column) -> Column:
        return F.when(x.rlike("(?i)^https?://"), x).when(x.startswith("//"), F.concat(F.regexp_extract(base, "^([a-z]+:)", 1), x)).when(x.startswith("/"), F.concat(root, x)).when(x.rlike(r"(?i)^[a-z][\w+.\-]*:"), F.lit(None).cast("string")).otherwise(F.concat(folder, x))

    return F.array_compact(F.transform(F.transform(found, strip), absolute))


def table_lines(words: DataFrame, name_end: float = 455, place_end: float = 535) -> DataFrame:
    """Rows of a table without rules, from words (page, top, x0, text): lines by rounded height, columns by x0; names above a marked line are carried into it."""
    line = words.withColumn("line", F.round(F.col("top") * 10).cast("bigint"))
    col = lambda cond: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("x0", "text")))), lambda w: w["text"]), " ")
    rows = line.groupBy("page", "line").agg(col(F.col("x0") < name_end).alias("name"), col((F.col("x0") >= name_end) & (F.col("x0") < place_end)).alias("place"), col(F.col("x0") >= place_end).alias("category"))
    order = Window.partitionBy("page").orderBy("line")
    marked = F.col("category") != ""
    island = F.coalesce(F.sum(F.when(marked, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "name"))), lambda x: x["name"]), " ")
    return rows.withColumn("island", island).groupBy("page", "island").agg(F.trim(names).alias("name"), F.max("place").alias("place"), F.max("category").alias("category"), F.max("line").alias("line")).filter("category <> ''").drop("island")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header; the committer puts them in place all at once or not at all."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def write_buckets(df: DataFrame, path: str, column: str = "bucket") -> None:
    """A folder for each value of a column; folders of other values stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
