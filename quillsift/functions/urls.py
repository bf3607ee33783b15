"""URLs: parts, canonical forms, scope, technical exclusions, scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import UrlRules
from .coerce import lastmod
from .text import UMLAUTS, replaced, strip, text

START = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def authority(c: Column) -> Column:
    return F.regexp_extract(c, START + r"//([^/?#]*)", 1)


def path(c: Column) -> Column:
    return F.regexp_extract(c, START + r"(?://[^/?#]*)?([^?#]*)", 1)


def query(c: Column) -> Column:
    return F.regexp_extract(c, r"\?([^#]*)", 1)


def fragment(c: Column) -> Column:
    return F.regexp_extract(c, "#(.*)$", 1)


def host(c: Column) -> Column:
    """Lower case, without a port."""
    return F.regexp_replace(F.lower(authority(c)), r":\d*$", "")


def bare_host(c: Column) -> Column:
    return F.regexp_replace(host(c), r"^www\.", "")


def normalize(c: Column) -> Column:
    """http and https URLs without query and fragment, `/` for no path; others are empty."""
    u = strip(text(c))
    p = path(u)
    whole = F.concat(scheme(u), F.lit("://"), authority(u), F.when(p == "", "/").otherwise(p))
    return F.when(scheme(u).isin("http", "https") & (authority(u) != ""), whole).otherwise("")


def identity(c: Column) -> Column:
    """Host and path of the normal form: schemes and ports do not tell URLs apart, www does."""
    n = normalize(c)
    return F.when(n == "", "").otherwise(F.concat(host(n), path(n)))


# Suffixes of two labels.
MULTI = ("co.uk", "org.uk", "gov.uk", "ac.uk", "com.au", "org.au", "net.au", "co.jp", "co.nz")


def registrable(h: Column) -> Column:
    """The last two labels, three under suffixes of two."""
    labels = F.filter(F.split(h, r"\."), lambda x: x != "")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - (k - 1), F.lit(1)), F.lit(k)), ".")
    return F.when(n <= 2, h).when(last(2).isin(*MULTI), last(3)).otherwise(last(2))


def decoded(c: Column) -> Column:
    """Percent escapes and pluses decoded where the text allows it, lower case, umlauts spelled out."""
    t = strip(F.lower(text(c)))
    return replaced(F.coalesce(F.try_url_decode(t), F.replace(t, F.lit("+"), F.lit(" "))), UMLAUTS)


def segments(c: Column) -> Column:
    return F.filter(F.split(path(c), "/"), lambda x: x != "")


def depth(c: Column) -> Column:
    return F.size(segments(c))


def canonical(segment: Column, rules: UrlRules) -> Column:
    s = F.regexp_replace(F.replace(decoded(segment), F.lit("_"), F.lit("-")), r"\s+", "-")
    cut = F.lit(None).cast("string")
    for suffix in rules.page_suffixes:
        cut = F.coalesce(cut, F.when(s.endswith(suffix), F.substring(s, F.lit(1), F.length(s) - len(suffix))))
    return F.regexp_replace(F.coalesce(cut, s), "^-+|-+$", "")


def canonicals(c: Column, rules: UrlRules) -> Column:
    return F.transform(segments(c), lambda s: canonical(s, rules))


def tokens(canonical_segment: Column) -> Column:
    return F.filter(F.split(canonical_segment, "[^a-z0-9]+"), lambda x: x != "")


def strings(values) -> Column:
    values = sorted(values) if isinstance(values, (set, frozenset)) else list(values)
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def section(canon: Column, rules: UrlRules) -> Column:
    """The first segment that is not a language, `root` for none."""
    first = F.element_at(canon, 1)
    return F.when(F.size(canon) == 0, "root").when(first.isin(*rules.languages) & (F.size(canon) > 1), F.try_element_at(canon, F.lit(2))).otherwise(first)


def id_like(canonical_segment: Column) -> Column:
    return canonical_segment.rlike("^[a-f0-9]{10,}$") | canonical_segment.rlike("^[a-z0-9]{20,}$")


def first_of(items: Column) -> Column:
    """The first entry that is not null."""
    return F.try_element_at(F.filter(items, lambda x: x.isNotNull()), F.lit(1))


def technical_reason(c: Column, rules: UrlRules) -> Column:
    """Why a URL is no page to rank, by the first check that fires; empty for none."""
    p, canon = decoded(path(c)), canonicals(c, rules)
    joined = F.array_join(canon, "/")
    any_of = lambda s: F.lit(False) if not rules.exclude_patterns else s.rlike("^(?:" + "|".join(rules.exclude_patterns) + ")")

    def of(s: Column) -> Column:
        hits = F.array_sort(F.array_intersect(tokens(s), strings(rules.exclude)))
        return (
            F.when(s.rlike(r"^(?:www\.)?[a-z0-9-]+(?:\.[a-z0-9-]+)+$"), F.concat(F.lit("embedded_hostname:"), s))
            .when(F.size(hits) > 0, F.concat(F.lit("exclude_tokens:"), F.array_join(hits, "|")))
            .when(any_of(s), F.concat(F.lit("exclude_regex:"), s))
        )

    reasons = [F.when(p.endswith(e), F.lit(f"non_html_extension:{e}")) for e in rules.extensions]
    reasons.append(first_of(F.transform(canon, of)))
    reasons.append(F.when((F.size(canon) > 0) & any_of(joined), F.concat(F.lit("exclude_regex_path:"), joined)))
    first, second = F.try_element_at(canon, F.lit(1)), F.try_element_at(canon, F.lit(2))
    reasons.append(F.when(first.isin(*rules.technical_roots), F.concat(F.lit("technical_root:"), first)))
    reasons += [F.when((first == a) & (second == b), F.lit(f"technical_pair:{a}/{b}")) for a, b in rules.technical_pairs]
    return F.coalesce(*reasons, F.lit(""))


def hits(values: Column, allowed) -> Column:
    return F.array_sort(F.array_distinct(F.array_intersect(values, strings(allowed))))


def patterns_hit(canon: Column, patterns, skip: Column | None = None) -> Column:
    """How many distinct patterns match the start of some segment that is not to be skipped."""

    def found(pattern: str) -> Column:
        if skip is None:
            return F.exists(canon, lambda s: s.rlike(f"^(?:{pattern})"))
        return F.exists(F.arrays_zip(canon.alias("s"), skip.alias("k")), lambda z: ~z["k"] & z["s"].rlike(f"^(?:{pattern})"))

    out = F.lit(0)
    for p in patterns:
        out = out + F.when(found(p), 1).otherwise(0)
    return out


def score(url: Column, seed: Column, priority: Column, modified: Column, stale_before: Column, rules: UrlRules, canon: Column | None = None, every: Column | None = None) -> dict[str, Column]:
    """Score, reasons, depth and section of a candidate page, by its URL alone. canon and every: its segments and tokens, if there are columns of them."""
    canon, n = canonicals(url, rules) if canon is None else canon, depth(url)
    every = F.array_distinct(F.flatten(F.transform(canon, tokens))) if every is None else every
    first = F.try_element_at(canon, F.lit(1))
    favor, penal = hits(every, rules.favor), hits(every, rules.penalize)
    generic = F.transform(canon, lambda s, i: s.isin(*rules.generic) & (i > 0))
    favored, penalized = patterns_hit(canon, rules.favor_patterns, generic), patterns_hit(canon, rules.penalize_patterns)
    year = path(url).rlike(r"/(20\d{2}|19\d{2})/")
    long, ids = F.size(F.filter(canon, lambda s: F.length(s) >= 40)), F.size(F.filter(canon, id_like))
    bonus = F.coalesce(F.bround((priority - F.lit(0.5)) * 6.0, 0).cast("int"), F.lit(0))
    stale = F.coalesce(lastmod(modified) < stale_before, F.lit(False))
    start = F.when(url == seed, 20).when(n == 0, 18).when((n == 1) & first.isin(*rules.languages), 10).otherwise(0)
    penalty = F.least(F.lit(20), 7 * F.size(penal)) + F.least(F.lit(10), 5 * penalized) + F.when(year, 5).otherwise(0)
    deep = F.when(n == 3, 2).when(n == 4, 5).when(n == 5, 9).when(n >= 6, 14).otherwise(0)
    total = start + F.least(F.lit(24), 6 * F.size(favor)) + F.least(F.lit(12), 6 * favored) - F.least(F.lit(20), penalty) - deep - F.least(F.lit(6), 2 * long) - F.least(F.lit(8), 4 * ids) + bonus - F.when(stale, 2).otherwise(0)
    reasons = F.array_compact(
        F.array(
            F.when(url == seed, "normalized_seed").when(n == 0, "homepage").when((n == 1) & first.isin(*rules.languages), "language_root"),
            F.when(F.size(favor) > 0, F.concat(F.lit("favor_tokens:"), F.array_join(favor, "|"))),
            F.when(favored > 0, "favor_regex"),
            F.when(F.size(penal) > 0, F.concat(F.lit("penalize_tokens:"), F.array_join(penal, "|"))),
            F.when(penalized > 0, "penalize_regex"),
            F.when(year, "penalize_archive_year"),
            F.when(n >= 6, "depth:6+").when(n >= 3, F.concat(F.lit("depth:"), n.cast("string"))),
            F.when(long > 0, F.concat(F.lit("long_segments:"), long.cast("string"))),
            F.when(ids > 0, F.concat(F.lit("id_like_segments:"), ids.cast("string"))),
            F.when(bonus != 0, F.concat(F.lit("priority:"), F.format_string("%.2f", priority))),
            F.when(stale, "lastmod_stale"),
        )
    )
    return {"score": total, "reasons": reasons, "depth": n, "section": section(canon, rules)}


def with_score(df: DataFrame, url: str, seed: Column, priority: Column, modified: Column, stale_before: Column, rules: UrlRules) -> DataFrame:
    """The table with the columns of score(); what several of them need is computed once."""
    df = df.withColumn("__canon", canonicals(F.col(url), rules))
    df = df.withColumn("__every", F.array_distinct(F.flatten(F.transform("__canon", tokens))))
    return df.withColumns(score(F.col(url), seed, priority, modified, stale_before, rules, F.col("__canon"), F.col("__every"))).drop("__canon", "__every")


def boundary_of(segs: Column, rules: UrlRules) -> Column:
    """The place from 0 of the first segment that names a boundary, -1 for none."""
    return F.array_position(F.transform(segs, lambda s: F.arrays_overlap(tokens(canonical(s, rules)), strings(rules.boundary))), F.lit(True)) - 1


def with_scope(df: DataFrame, url: str, rules: UrlRules) -> DataFrame:
    """The table with the columns of scope(), step by step: each step reads columns, not the steps before it again."""
    df = df.withColumn("__n", normalize(F.col(url)))
    df = df.withColumn("__segs", segments(F.col("__n")))
    df = df.withColumn("__boundary", boundary_of(F.col("__segs"), rules))
    prefix, reason = prefix_and_reason(F.col("__segs"), F.col("__boundary"), rules)
    df = df.withColumns({"__prefix": prefix, "__reason": reason})
    df = df.withColumn("__scaffold", scaffold_only(F.col("__prefix"), rules))
    return df.withColumns(scoped(F.col("__n"), F.col("__prefix"), F.col("__reason"), F.col("__scaffold"))).drop("__n", "__segs", "__boundary", "__prefix", "__reason", "__scaffold")


def scope(c: Column, rules: UrlRules) -> dict[str, Column]:
    """The part of a site that a seed URL stands for: its URL, mode, path prefix, and why."""
    n = normalize(c)
    segs = segments(n)
    prefix, reason = prefix_and_reason(segs, boundary_of(segs, rules), rules)
    return scoped(n, prefix, reason, scaffold_only(prefix, rules))


def prefix_and_reason(segs: Column, boundary: Column, rules: UrlRules) -> tuple[Column, Column]:
    count = F.size(segs)
    at_boundary = (boundary >= 0) & ~((boundary == 0) & (count > 1))
    parents = F.slice(segs, F.lit(1), F.greatest(boundary, F.lit(0)).cast("int"))
    named = decoded(F.try_element_at(segs, (boundary + 1).cast("int")))
    joined = lambda a: F.concat(F.lit("/"), F.array_join(a, "/"), F.lit("/"))
    first, last = F.try_element_at(segs, F.lit(1)), F.try_element_at(segs, F.lit(-1))
    above = F.slice(segs, F.lit(1), F.greatest(count - 1, F.lit(0)))
    prefix = (
        F.when(count == 0, "/")
        .when(at_boundary & (boundary > 0), joined(parents))
        .when(at_boundary, "/")
        .when((count == 1) & decoded(first).isin(*rules.languages), joined(segs))
        .when(count == 1, "/")
        .when(F.contains(last, F.lit(".")), joined(above))
        .otherwise(joined(segs))
    )
    reason = (
        F.when(count == 0, "root_seed")
        .when(at_boundary & (boundary > 0), F.concat(F.lit("promoted_before_boundary:"), named))
        .when(at_boundary, F.concat(F.lit("promoted_to_host_root:"), named))
        .when((count == 1) & decoded(first).isin(*rules.languages), "language_root_seed")
        .when(count == 1, "single_leaf_promoted_to_host_root")
        .when(F.contains(last, F.lit(".")), "file_leaf_promoted_to_parent")
        .otherwise("kept_path_prefix")
    )
    return prefix, reason


def scaffold_only(prefix: Column, rules: UrlRules) -> Column:
    """Whether a path is made of scaffold and language segments alone."""
    left = F.filter(F.split(prefix, "/"), lambda x: x != "")
    return (prefix != "/") & F.forall(left, lambda s: canonical(s, rules).isin(*rules.scaffold, *rules.languages))


def scoped(n: Column, prefix: Column, reason: Column, scaffold: Column) -> dict[str, Column]:
    reason = F.when(scaffold, F.concat(F.lit("scaffold_promoted_to_host_root:"), reason)).otherwise(reason)
    prefix = F.when(scaffold, "/").otherwise(prefix)
    some = n != ""
    return {
        "seed_url": F.when(some, F.concat(scheme(n), F.lit("://"), authority(n), prefix)).otherwise(""),
        "scope_mode": F.when(~some, "").when(prefix == "/", "host").otherwise("path_prefix"),
        "path_prefix": F.when(some, prefix).otherwise(""),
        "scope_reason": F.when(some, reason).otherwise("invalid_or_unsupported_url"),
    }


def final_scope(c: Column) -> dict[str, Column]:
    """The scope of a reviewed URL: its host for the root, else exactly its path."""
    n = normalize(c)
    root = path(n) == "/"
    return {
        "seed_url": n,
        "scope_mode": F.when(n == "", "").when(root, "host").otherwise("path_prefix"),
        "path_prefix": F.when(n == "", "").when(root, "/").otherwise(path(n)),
        "scope_reason": F.when(n == "", "invalid_or_unsupported_url").when(root, "final_url_root").otherwise("final_url_path_prefix"),
    }


def in_scope(url: Column, seed_host: Column, prefix: Column, subdomains: bool = False) -> Column:
    h, p = host(url), path(url)
    same = h == seed_host
    if subdomains:
        same = same | h.endswith(F.concat(F.lit("."), seed_host))
    return same & ((prefix == "/") | p.startswith(prefix) | (p == F.regexp_replace(prefix, "/$", "")))


def slash_only(a: Column, b: Column) -> Column:
    """Whether two URLs differ in slashes at the end of the path alone."""
    a, b = strip(text(a)), strip(text(b))
    bare = lambda u: F.regexp_replace(path(u), "/+$", "")
    same = (scheme(a) == scheme(b)) & (F.lower(authority(a)) == F.lower(authority(b))) & (query(a) == query(b)) & (fragment(a) == fragment(b))
    return (a != "") & (b != "") & (a != b) & same & (bare(a) == bare(b))


def material_change(a: Column, b: Column) -> Column:
    return ~slash_only(a, b) & (strip(text(a)) != strip(text(b)))


def match_path(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(path(c)), "/+", "/"), "^/|/$", "")


def near_root(p: Column, rules: UrlRules) -> Column:
    return (p == "") | p.isin(*rules.near_root)


def agree(a: Column, b: Column, rules: UrlRules) -> Column:
    """Whether two URLs mean the same site's page, or both its entrance."""
    da, db, pa, pb = registrable(bare_host(a)), registrable(bare_host(b)), match_path(a), match_path(b)
    return (da != "") & (da == db) & ((pa == pb) | near_root(pa, rules) & near_root(pb, rules))


def probes(c: Column) -> Column:
    """URLs to try for a seed: as it is, the other scheme, with and without www."""
    n = normalize(c)
    a, p = authority(n), path(n)
    other = F.when(F.lower(a).startswith("www."), F.substring(a, F.lit(5), F.length(a))).otherwise(F.concat(F.lit("www."), a))
    swapped = F.when(scheme(n) == "https", "http").otherwise("https")
    make = lambda s, h: F.concat(s, F.lit("://"), h, p)
    return F.array_distinct(F.array(n, make(swapped, a), make(scheme(n), other), make(swapped, other)))
