"""URL candidates of an entity: merged, ranked under caps per section, and searched pages rolled up by domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import UrlRules
from ..functions import urls
from ..functions.coerce import lastmod
from ..functions.text import text


def merge(df: DataFrame, entity: str, url: str = "url", order: str = "ord") -> DataFrame:
    """One row for each entity and identity: the first URL, https before http; the first priority; the latest time; all sources."""
    u = urls.normalize(F.col(url))
    rows = df.withColumns({"__url": u, "__key": urls.identity(F.col(url)), "__ts": lastmod("lastmod")}).filter("__key <> ''")
    rank = F.struct((urls.scheme(F.col("__url")) != "https").alias("a"), F.col(order).alias("b"))
    out = rows.groupBy(F.col(entity), F.col("__key").alias("identity")).agg(
        F.min_by("__url", rank).alias("url"),
        F.min(order).alias(order),
        F.min_by("priority", F.when(F.col("priority").isNotNull(), F.col(order))).alias("priority"),
        F.max("__ts").alias("lastmod"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.count("*").alias("merged"),
    )
    return out


def capped(df: DataFrame, entity: str, cap: int, keep: int) -> DataFrame:
    """Rank and decision of the pages kept: by score, depth, length of path and URL; at most cap of a section before any overflow."""
    key = [F.col("score").desc(), F.col("depth").asc(), F.length(urls.path(F.col("url"))).asc(), F.col("url").asc()]
    inner = F.row_number().over(Window.partitionBy(entity, "section").orderBy(*key))
    over = df.withColumn("__over", inner > cap)
    outer = F.row_number().over(Window.partitionBy(entity).orderBy(F.col("__over").asc(), *key))
    return over.withColumn("rank", outer.cast("bigint")).filter(F.col("rank") <= keep).withColumn("decision", F.when(F.col("__over"), "keep_after_section_cap").otherwise("keep")).drop("__over")


def search_score(url: Column, title: Column, name: Column, rules: UrlRules) -> Column:
    """How likely a found page is the entity's own."""
    domain, p = F.lower(urls.authority(url)), F.regexp_replace(urls.path(url), "^/+|/+$", "")
    words = F.filter(F.split(F.lower(text(name)), r"\s+"), lambda w: F.length(w) > 3)
    hits = lambda t, by: F.aggregate(words, F.lit(0), lambda a, w: a + F.when(F.contains(t, w), by).otherwise(0))
    depth = F.size(F.filter(F.split(p, "/"), lambda x: x != ""))
    return F.when(domain.endswith(".ch"), 10).otherwise(0) - F.when(listed(urls.bare_host(url), rules.aggregators), 50).otherwise(0) + hits(domain, 15) + hits(F.lower(text(title)), 5) + F.when(p == "", 10).when(depth == 1, 4).otherwise(-6)


def listed(host: Column, domains: tuple[str, ...]) -> Column:
    """Whether a host is one of the domains or below one."""
    out = F.lit(False)
    for d in domains:
        out = out | (host == d) | host.endswith("." + d)
    return out


# Words of paths that are seldom an entity's entrance.
SIDE_PAGES = ("spenden", "donate", "news", "blog", "events", "event")


def page_priority(url: Column, rules: UrlRules) -> Column:
    p = F.regexp_replace(F.lower(urls.path(url)), "^/+|/+$", "")
    has = lambda words: p.rlike("|".join(words))
    return F.when(p == "", 100).when(has(rules.near_root), 80).when(has(SIDE_PAGES), 30).otherwise(60)


def by_domain(pages: DataFrame, entity: str, rules: UrlRules) -> DataFrame:
    """Domains of an entity's found pages (url, score, ord): score, canonical page, and their rank."""
    rows = pages.withColumns({"domain": urls.registrable(urls.bare_host(F.col("url"))), "__p": page_priority(F.col("url"), rules), "__root": F.regexp_replace(urls.path(F.col("url")), "^/+|/+$", "") == ""})
    out = rows.groupBy(entity, "domain").agg(
        (F.max("score") + F.least(F.lit(6), 3 * (F.count("*") - 1)) + F.when(F.bool_or("__root"), 3).otherwise(0)).cast("bigint").alias("domain_score"),
        F.max_by("url", F.struct("__p", "score", (-F.col("ord")).alias("o"))).alias("page"),
        F.min("ord").alias("first_ord"),
    )
    rank = F.row_number().over(Window.partitionBy(entity).orderBy(F.col("domain_score").desc(), "first_ord"))
    return out.withColumn("rank", rank.cast("bigint"))


def best(domains: DataFrame, entity: str) -> DataFrame:
    """The best domain of each entity and its lead over the second; alone, its own score."""
    first = lambda c: F.max(F.when(F.col("rank") == 1, F.col(c)))
    second = F.max(F.when(F.col("rank") == 2, F.col("domain_score")))
    return domains.groupBy(entity).agg(first("domain").alias("domain"), first("page").alias("page"), first("domain_score").alias("score"), (first("domain_score") - F.coalesce(second, F.lit(0))).alias("gap"))


def cascade(rows: DataFrame, first: str, second: str, accept: int = 40, agree: int = 20, rules: UrlRules = UrlRules()) -> DataFrame:
    """Decision on two providers' best pages (`<p>_page`, `<p>_score`): the first alone, the second alone, both agreeing, or review."""
    a, b = F.col(f"{first}_score"), F.col(f"{second}_score")
    same = F.coalesce(urls.agree(F.col(f"{first}_page"), F.col(f"{second}_page"), rules), F.lit(False))
    stage = F.when(a >= accept, f"{first}_auto").when(b >= accept, f"{second}_auto").when(same & (b >= agree), f"{second}_{first}_agree").otherwise("manual_review")
    top = F.greatest(F.coalesce(a, F.lit(-10_000)), F.coalesce(b, F.lit(-10_000)))
    return rows.withColumns(
        {
            "stage": stage,
            "url": F.when(stage == f"{first}_auto", F.col(f"{first}_page")).when(stage == "manual_review", F.when(top >= 0, F.coalesce(F.col(f"{first}_page"), F.col(f"{second}_page"))).otherwise("")).otherwise(F.col(f"{second}_page")),
            "confidence": F.when(stage != "manual_review", "high").when(top >= 0, "low").otherwise("none"),
            "needs_review": stage == "manual_review",
        }
    )


def wants_second_search(score: Column, gap: Column, domain: Column, rules: UrlRules, least: int = 25, lead: int = 8) -> Column:
    """Whether a first search was not conclusive."""
    return score.isNull() | listed(domain, rules.aggregators) | (score < least) | (gap < lead)
