"""Queries: URLs of pages and of their links."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import UrlRules
from ..functions import text as T
from ..functions import urls as U
from ..operators import candidates as cand
from ..operators import screening
from ..sources.files import links
from .base import query

#: Rules with words of the driver's invented languages, so that each kind of rule has something to do.
RULES = UrlRules(
    languages=("de", "en", "fr", "it", "es"),
    aggregators=("example.org",),
    favor=("about", "mission", "team", "contact", "projects", "the", "of", "and"),
    favor_patterns=("about", "who-we", "th[aeo]"),
    penalize=("news", "blog", "archive", "tag", "reouha"),
    penalize_patterns=("news-", "er[a-z]+ing"),
    exclude=("login", "cart", "search", "privacy", "feed", "que"),
    exclude_patterns=("wp-", "page-[0-9]+", "z[a-z]{2}$"),
)
Q = lambda words: ", ".join(f"'{w}'" for w in words)
SCHEME = lambda u: f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
AUTHORITY = lambda u: f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
PATH = lambda u: f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/?#]*)?([^?#]*)', 2)"
HOST = lambda u: f"regexp_replace(lower({AUTHORITY(u)}), ':[0-9]*$', '')"
BARE = lambda u: f"regexp_replace({HOST(u)}, '^www\\.', '')"
NORMAL = lambda u: f"CASE WHEN {SCHEME(u)} IN ('http','https') AND {AUTHORITY(u)} <> '' THEN {SCHEME(u)} || '://' || {AUTHORITY(u)} || CASE WHEN {PATH(u)} = '' THEN '/' ELSE {PATH(u)} END ELSE '' END"
IDENTITY = lambda u: f"CASE WHEN ({NORMAL(u)}) = '' THEN '' ELSE {HOST(u)} || CASE WHEN {PATH(u)} = '' THEN '/' ELSE {PATH(u)} END END"
LABELS = lambda h: f"string_split({h}, '.')"
DOMAIN = lambda h: f"CASE WHEN len({LABELS(h)}) <= 2 THEN {h} WHEN array_to_string({LABELS(h)}[-2:], '.') IN ({Q(U.MULTI)}) THEN array_to_string({LABELS(h)}[-3:], '.') ELSE array_to_string({LABELS(h)}[-2:], '.') END"
SEGMENTS = lambda u: f"list_filter(string_split({PATH(u)}, '/'), lambda x: x <> '')"
#: Of driver URLs: ASCII, without escapes; so decoding is lower case and umlauts alone.
DECODED = lambda x: f"replace(replace(replace(replace(trim(replace(lower({x}), '+', ' ')), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss')"
CANON = lambda x: f"regexp_replace(regexp_replace(replace({DECODED(x)}, '_', '-'), '\\.(html|htm|php|aspx|asp|jsp)$', ''), '^-+|-+$', '', 'g')"
TOKENS = lambda c: f"list_filter(regexp_split_to_array({c}, '[^a-z0-9]+'), lambda t: t <> '')"
LINKS = f"""SELECT page_id, url, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href WHEN href LIKE '/%' THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || href END AS link, ord
FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"#]+)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"#]+)"', 1), 1) AS ord FROM pages)"""
CANDIDATES = f"""SELECT {BARE('url')} AS site, {NORMAL('link')} AS url, {CANON(f"coalesce({SEGMENTS('link')}[1], '')")} AS seg, {TOKENS(CANON(f"coalesce({SEGMENTS('link')}[1], '')"))} AS toks, len({SEGMENTS('link')}) AS depth, page_id, ord FROM ({LINKS}) WHERE link IS NOT NULL"""


def link_rows(table):
    """The links of all pages: their site, address and place."""
    rows = table("pages").select("page_id", "url", F.posexplode(links("html", F.col("url"))).alias("pos", "link"))
    return rows.select(U.bare_host(F.col("url")).alias("site"), U.normalize(F.col("link")).alias("url"), "page_id", (F.col("pos") + 1).cast("bigint").alias("ord"))


def scored(table):
    """Each site's distinct links with score, depth and section."""
    rows = link_rows(table).groupBy("site", "url").agg(F.min(F.struct("page_id", "ord")).alias("first"))
    return U.with_score(rows, "url", F.lit(""), F.lit(None).cast("double"), F.lit(""), F.lit("2024-01-01").cast("timestamp"), RULES)


@query(f"SELECT page_id, {NORMAL('url')} AS normal, {IDENTITY('url')} AS identity FROM pages")
def url_normalize(table):
    return table("pages").select("page_id", U.normalize(F.col("url")).alias("normal"), U.identity(F.col("url")).alias("identity"))


@query(f"SELECT page_id, {BARE('url')} AS host, {DOMAIN(BARE('url'))} AS domain FROM pages")
def registrable_domain(table):
    host = U.bare_host(F.col("url"))
    return table("pages").select("page_id", host.alias("host"), U.registrable(host).alias("domain"))


@query(f"""WITH r AS (SELECT lang, {NORMAL('url')} AS u, {IDENTITY('url')} AS k, page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE (page_id % 10) / 10.0 END AS priority, CASE WHEN page_id % 2 = 0 THEN 'sitemap' ELSE 'links' END AS source FROM (SELECT *, {SEGMENTS('url')}[1] AS lang FROM pages) p)
SELECT lang AS entity, k AS identity, arg_min(u, (CASE WHEN u LIKE 'https%' THEN 0 ELSE 1 END) * 1000000000 + page_id) AS url, min(page_id) AS ord, arg_min(priority, page_id) FILTER (WHERE priority IS NOT NULL) AS priority, array_to_string(list_sort(list(DISTINCT source)), '+') AS sources, count(*) AS merged FROM r GROUP BY 1, 2""")
def url_identity_dedup(table):
    rows = table("pages").select(F.try_element_at(U.segments(F.col("url")), F.lit(1)).alias("entity"), "url", F.col("page_id").alias("ord"), F.when(F.expr("page_id % 3 <> 0"), (F.col("page_id") % 10) / 10.0).alias("priority"), F.lit("").alias("lastmod"), F.when(F.expr("page_id % 2 = 0"), "sitemap").otherwise("links").alias("source"))
    out = cand.merge(rows, "entity")
    return out.select("entity", "identity", "url", "ord", "priority", F.array_join("sources", "+").alias("sources"), "merged")


@query(f"""WITH r AS (SELECT page_id, {NORMAL('url')} AS n, {SEGMENTS('url')} AS s FROM pages),
p AS (SELECT *, CASE WHEN len(s) = 0 THEN '/' WHEN len(s) = 1 AND s[1] IN ({Q(RULES.languages)}) THEN '/' || s[1] || '/' WHEN len(s) = 1 THEN '/' WHEN contains(s[-1], '.') THEN '/' || array_to_string(s[1:len(s)-1], '/') || '/' ELSE '/' || array_to_string(s, '/') || '/' END AS pre,
CASE WHEN len(s) = 0 THEN 'root_seed' WHEN len(s) = 1 AND s[1] IN ({Q(RULES.languages)}) THEN 'language_root_seed' WHEN len(s) = 1 THEN 'single_leaf_promoted_to_host_root' WHEN contains(s[-1], '.') THEN 'file_leaf_promoted_to_parent' ELSE 'kept_path_prefix' END AS why FROM r),
q AS (SELECT *, pre <> '/' AND len(list_filter(string_split(pre, '/'), lambda x: x <> '' AND x NOT IN ({Q(RULES.languages + RULES.scaffold)}))) = 0 AS bare FROM p)
SELECT page_id, regexp_extract(n, '^(https?://[^/]*)', 1) || CASE WHEN bare THEN '/' ELSE pre END AS seed_url, CASE WHEN bare OR pre = '/' THEN 'host' ELSE 'path_prefix' END AS scope_mode, CASE WHEN bare THEN '/' ELSE pre END AS path_prefix, CASE WHEN bare THEN 'scaffold_promoted_to_host_root:' || why ELSE why END AS scope_reason FROM q""")
def url_scope(table):
    return U.with_scope(table("pages").select("page_id", "url"), "url", RULES).drop("url")


@query(f"SELECT page_id, {NORMAL('url')} AS seed_url, 'path_prefix' AS scope_mode, {PATH('url')} AS path_prefix, 'final_url_path_prefix' AS scope_reason FROM pages")
def url_final_scope(table):
    return table("pages").select("page_id", *[c.alias(k) for k, c in U.final_scope(F.col("url")).items()])


@query(f"""WITH r AS (SELECT page_id, url, {NORMAL('url')} AS n, {PATH('url')} AS p FROM pages)
SELECT CASE WHEN url = n THEN 'unchanged' ELSE 'changed' END AS outcome, len(list_filter(string_split(p, '/'), lambda x: x <> '')) > 0 AS needs_review, count(*) AS n, count(*) FILTER (WHERE page_id % 4 <> 0) AS pending FROM r GROUP BY 1, 2""")
def url_norm_report(table):
    u = F.col("url")
    rows = table("pages").select("page_id", F.when(U.material_change(u, U.normalize(u)), "changed").otherwise("unchanged").alias("outcome"), (U.depth(u) > 0).alias("needs_review"))
    return rows.groupBy("outcome", "needs_review").agg(F.count("*").alias("n"), F.count_if(F.expr("page_id % 4 <> 0")).alias("pending"))


CONFIDENCE = f"""WITH r AS (SELECT page_id, {SEGMENTS('url')} AS s, CASE WHEN contains({SEGMENTS('url')}[-1], '.') THEN 'file_leaf_promoted_to_parent' ELSE 'kept_path_prefix' END AS why0 FROM pages),
v AS (SELECT page_id, lower(s[1]) AS seg, CASE WHEN why0 = 'file_leaf_promoted_to_parent' THEN 'scaffold_promoted_to_host_root:' || why0 ELSE why0 END AS why, (page_id % 10) < CASE s[1] WHEN 'en' THEN 2 WHEN 'de' THEN 10 ELSE 5 END AS yes FROM r),
a AS (SELECT why, count(*) FILTER (WHERE yes) AS y, count(*) AS t FROM v GROUP BY 1), b AS (SELECT seg, count(*) FILTER (WHERE yes) AS y, count(*) AS t FROM v GROUP BY 1),
j AS (SELECT page_id, seg, why, a.y / a.t AS ra, a.t AS ta, b.y / b.t AS rb, b.t AS tb FROM v JOIN a USING (why) JOIN b USING (seg)),
k AS (SELECT *, CASE WHEN why LIKE 'scaffold%' THEN 3 WHEN why = 'kept_path_prefix' THEN 1 ELSE 2 END AS c0 FROM j),
l AS (SELECT *, CASE WHEN seg IN ({Q(RULES.high_segments)}) AND c0 < 3 THEN 3 ELSE c0 END AS c1 FROM k),
m AS (SELECT *, CASE WHEN ta >= 3 AND ra >= 0.9 AND c1 < 3 THEN 3 WHEN ta >= 3 AND ra <= 0.2 THEN 1 ELSE c1 END AS c2 FROM l),
n AS (SELECT *, CASE WHEN tb >= 3 AND rb >= 0.9 AND c2 < 3 THEN 3 WHEN tb >= 3 AND rb <= 0.2 THEN 1 ELSE c2 END AS c3 FROM m)
SELECT page_id, CASE c3 WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS confidence FROM n"""


@query(CONFIDENCE)
def url_norm_confidence(table):
    u = F.col("url")
    rows = U.with_scope(table("pages").select("page_id", "url"), "url", RULES).select("page_id", F.col("scope_reason").alias("why"), F.lower(F.try_element_at(U.segments(u), F.lit(1))).alias("seg"), U.depth(u).alias("depth"))
    limit = F.when(F.col("seg") == "en", 2).when(F.col("seg") == "de", 10).otherwise(5)
    rows = rows.withColumn("yes", (F.col("page_id") % 10) < limit)
    stats = lambda k, a: rows.groupBy(k).agg(F.count_if("yes").alias(f"{a}_yes"), F.count("*").alias(f"{a}_total"))
    rows = rows.join(stats("why", "r"), "why").join(stats("seg", "s"), "seg")
    how = screening.confidence(F.lit(None), F.col("why"), F.col("seg"), F.col("depth"), (F.col("r_yes"), F.col("r_total")), (F.col("s_yes"), F.col("s_total")), RULES.high_segments)
    return rows.select("page_id", how.alias("confidence"))


@query(f"SELECT site, url, page_id, ord FROM ({CANDIDATES})")
def link_candidates(table):
    return link_rows(table)


TECHNICAL = f"""CASE WHEN regexp_extract(lower(url), '(\\.pdf|\\.jpg|\\.png|\\.zip|\\.xml|\\.css|\\.js)$', 1) <> '' THEN 'non_html_extension:' || regexp_extract(lower(url), '(\\.pdf|\\.jpg|\\.png|\\.zip|\\.xml|\\.css|\\.js)$', 1)
WHEN regexp_full_match(seg, '(www\\.)?[a-z0-9-]+(\\.[a-z0-9-]+)+') THEN 'embedded_hostname:' || seg
WHEN len(list_intersect(toks, [{Q(RULES.exclude)}])) > 0 THEN 'exclude_tokens:' || array_to_string(list_sort(list_intersect(list_distinct(toks), [{Q(RULES.exclude)}])), '|')
WHEN regexp_matches(seg, '^(wp-|page-[0-9]+|z[a-z]{{2}}$)') THEN 'exclude_regex:' || seg WHEN seg IN ({Q(RULES.technical_roots)}) THEN 'technical_root:' || seg ELSE '' END"""


@query(f"SELECT reason, count(*) AS n FROM (SELECT {TECHNICAL} AS reason FROM ({CANDIDATES})) GROUP BY 1")
def technical_exclusions(table):
    return link_rows(table).select(U.technical_reason(F.col("url"), RULES).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


HIT = lambda words: f"len(list_intersect(list_distinct(toks), [{Q(words)}]))"
SCORE = f"""(CASE WHEN depth = 0 THEN 18 WHEN depth = 1 AND seg IN ({Q(RULES.languages)}) THEN 10 ELSE 0 END + least(24, 6 * {HIT(RULES.favor)})
+ least(12, 6 * (CAST(regexp_matches(seg, '^about') AS INT) + CAST(regexp_matches(seg, '^who-we') AS INT) + CAST(regexp_matches(seg, '^th[aeo]') AS INT)))
- least(20, least(20, 7 * {HIT(RULES.penalize)}) + least(10, 5 * (CAST(regexp_matches(seg, '^news-') AS INT) + CAST(regexp_matches(seg, '^er[a-z]+ing') AS INT))))
- least(6, 2 * CAST(length(seg) >= 40 AS INT)) - least(8, 4 * CAST(regexp_full_match(seg, '[a-f0-9]{{10,}}') OR regexp_full_match(seg, '[a-z0-9]{{20,}}') AS INT)))"""
SCORED = f"SELECT site, url, any_value({SCORE}) AS score, any_value(CASE WHEN depth = 0 THEN 'root' ELSE seg END) AS section, any_value(depth) AS depth FROM ({CANDIDATES}) GROUP BY site, url"


@query(f"SELECT site, url, CAST(score AS BIGINT) AS score, CAST(depth AS BIGINT) AS depth, section FROM ({SCORED})")
def url_score(table):
    return scored(table).select("site", "url", F.col("score").cast("bigint").alias("score"), F.col("depth").cast("bigint").alias("depth"), "section")


@query(f"""WITH s AS (SELECT regexp_extract(site, '([^.]+\\.[^.]+)$', 1) AS entity, * FROM ({SCORED})), o AS (SELECT *, row_number() OVER (PARTITION BY entity, section ORDER BY score DESC, depth, length({PATH('url')}), url) > 2 AS ov FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ov, score DESC, depth, length({PATH('url')}), url) AS rank FROM o)
SELECT entity, url, section, rank, CASE WHEN ov THEN 'keep_after_section_cap' ELSE 'keep' END AS decision FROM r WHERE rank <= 40""")
def url_rank_section_cap(table):
    rows = scored(table).withColumn("entity", F.regexp_extract("site", r"([^.]+\.[^.]+)$", 1))
    return cand.capped(rows, "entity", 2, 40).select("entity", "url", "section", "rank", "decision")


FOUND = f"""SELECT page_id, url, string_split({PATH('url')}, '/')[2] AS entity, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
(CASE WHEN {BARE('url')} = 'example.org' OR {BARE('url')} LIKE '%.example.org' THEN -50 ELSE 0 END + CASE WHEN contains(lower({AUTHORITY('url')}), 'example') THEN 15 ELSE 0 END + CASE WHEN contains(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), 'that') THEN 5 ELSE 0 END + CASE WHEN contains(lower({AUTHORITY('url')}), 'that') THEN 15 ELSE 0 END
+ CASE WHEN contains(lower(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), 'example') THEN 5 ELSE 0 END + CASE len({SEGMENTS('url')}) WHEN 0 THEN 10 WHEN 1 THEN 4 ELSE -6 END) AS score FROM pages"""
ROLLUP = f"""WITH f AS ({FOUND}), d AS (SELECT *, {DOMAIN(BARE('url'))} AS domain, CASE WHEN regexp_matches(trim(lower({PATH('url')}), '/'), '{"|".join(RULES.near_root)}') THEN 80 WHEN regexp_matches(lower({PATH('url')}), 'spenden|donate|news|blog|events|event') THEN 30 ELSE 60 END AS pri FROM f),
g AS (SELECT entity, domain, max(score) + least(6, 3 * (count(*) - 1)) AS domain_score, arg_max(url, pri * 1000000000000 + CAST(score AS BIGINT) * 1000000000 - page_id) AS page, min(page_id) AS first_ord FROM d GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY domain_score DESC, first_ord) AS rank FROM g)"""


def found_pages(table):
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return table("pages").select(F.col("page_id").alias("ord"), "url", F.try_element_at(U.segments(F.col("url")), F.lit(1)).alias("entity"), cand.search_score(F.col("url"), title, F.lit("That of Example"), RULES).alias("score"))


@query(ROLLUP + " SELECT entity, domain, CAST(domain_score AS BIGINT) AS domain_score, page, rank FROM r")
def search_domain_rollup(table):
    return cand.by_domain(found_pages(table), "entity", RULES).select("entity", "domain", "domain_score", "page", "rank")


@query(ROLLUP + " SELECT entity, max(domain) FILTER (WHERE rank = 1) AS domain, CAST(max(domain_score) FILTER (WHERE rank = 1) AS BIGINT) AS score, CAST(max(domain_score) FILTER (WHERE rank = 1) - coalesce(max(domain_score) FILTER (WHERE rank = 2), 0) AS BIGINT) AS gap FROM r GROUP BY 1")
def search_best_gap(table):
    return cand.best(cand.by_domain(found_pages(table), "entity", RULES), "entity").select("entity", "domain", "score", "gap")


NEAR = lambda p: f"({p} = '' OR {p} IN ({Q(RULES.near_root)}))"
MPATH = lambda u: f"regexp_replace(regexp_replace(lower({PATH(u)}), '/+', '/', 'g'), '^/|/$', '', 'g')"
AGREE = lambda a, b: f"({DOMAIN(BARE(a))} <> '' AND {DOMAIN(BARE(a))} = {DOMAIN(BARE(b))} AND ({MPATH(a)} = {MPATH(b)} OR ({NEAR(MPATH(a))} AND {NEAR(MPATH(b))})))"


@query(f"""WITH r AS (SELECT page_id, url AS web_page, CASE WHEN page_id % 5 = 0 THEN regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') ELSE 'https://other.example.com/about' END AS llm_page, CAST(page_id % 60 AS INT) AS web_score, CAST((page_id * 7) % 50 AS INT) AS llm_score FROM pages),
s AS (SELECT *, CASE WHEN web_score >= 40 THEN 'web_auto' WHEN llm_score >= 40 THEN 'llm_auto' WHEN {AGREE('web_page', 'llm_page')} AND llm_score >= 20 THEN 'llm_web_agree' ELSE 'manual_review' END AS stage FROM r)
SELECT page_id, stage, CASE WHEN stage IN ('web_auto', 'manual_review') THEN web_page ELSE llm_page END AS url, CASE WHEN stage <> 'manual_review' THEN 'high' ELSE 'low' END AS confidence, stage = 'manual_review' AS needs_review FROM s""")
def search_cascade_stage(table):
    u = F.col("url")
    rows = table("pages").select("page_id", u.alias("web_page"), F.when(F.expr("page_id % 5 = 0"), F.regexp_replace(F.regexp_replace(u, "[?#].*$", ""), "/$", "")).otherwise("https://other.example.com/about").alias("llm_page"), (F.col("page_id") % 60).cast("int").alias("web_score"), ((F.col("page_id") * 7) % 50).cast("int").alias("llm_score"))
    return cand.cascade(rows, "web", "llm", rules=RULES).select("page_id", "stage", "url", "confidence", "needs_review")


@query(f"""WITH r AS (SELECT page_id, url, {DOMAIN(BARE('url'))} AS dom, {MPATH('url')} AS p FROM pages)
SELECT a.page_id AS a, b.page_id AS b FROM r a JOIN r b ON a.dom = b.dom AND a.p = b.p AND a.page_id < b.page_id""")
def urls_agree_pairs(table):
    rows = table("pages").select("page_id", U.registrable(U.bare_host(F.col("url"))).alias("dom"), U.match_path(F.col("url")).alias("p"))
    a, b = rows.select(F.col("page_id").alias("a"), "dom", "p"), rows.select(F.col("page_id").alias("b"), "dom", "p")
    return a.join(b, ["dom", "p"]).filter("a < b").select("a", "b")


@query(f"SELECT page_id, lower({SEGMENTS('url')}[1]) || '-' || regexp_replace({SEGMENTS('url')}[-1], '[^a-z0-9]+', '_', 'g') AS slug, len(list_distinct([url, url || '/'])) AS variants, regexp_matches(url, '[?#]') AS has_tail FROM pages")
def url_slug(table):
    u = F.col("url")
    segs = U.segments(u)
    return table("pages").select("page_id", F.concat(T.slug(F.try_element_at(segs, F.lit(1))), F.lit("-"), F.regexp_replace(F.try_element_at(segs, F.lit(-1)), "[^a-z0-9]+", "_")).alias("slug"), F.size(F.array_distinct(F.array(u, F.concat(u, F.lit("/"))))).cast("bigint").alias("variants"), ((U.query(u) != "") | (U.fragment(u) != "")).alias("has_tail"))


@query(f"SELECT page_id, list_distinct([{NORMAL('url')}]) [1] AS first_probe, CAST(4 AS BIGINT) AS probes FROM pages")
def seed_probes(table):
    p = U.probes(F.col("url"))
    return table("pages").select("page_id", F.element_at(p, 1).alias("first_probe"), F.size(p).cast("bigint").alias("probes"))


@query(f"SELECT page_id, {HOST('url')} LIKE '%.example.com' AND {PATH('url')} LIKE '/en/%' AS in_scope FROM pages")
def scope_members(table):
    return table("pages").select("page_id", (U.in_scope(F.col("url"), F.lit("example.com"), F.lit("/en/"), True)).alias("in_scope"))
