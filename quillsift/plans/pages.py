"""Queries: pages, their quality, attempts, segments, evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import content as C
from ..functions import text as T
from ..operators import evidence, screening, segments
from ..operators import incremental as inc
from ..sources import files
from .base import query

TITLE = "trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g'))"
LANG = "regexp_extract(html, '(?is)<html[^>]*\\blang=[\"'']([^\"'']*)[\"'']', 1)"
PLAIN = "trim(regexp_replace(regexp_replace({0}, '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
NO_SCRIPTS = "regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
NO_FRAME = f"regexp_replace(regexp_replace(regexp_replace({NO_SCRIPTS}, '(?is)<nav[^>]*>.*?</nav>', ' ', 'g'), '(?is)<footer[^>]*>.*?</footer>', ' ', 'g'), '(?is)<header[^>]*>.*?</header>', ' ', 'g')"


@query(f"SELECT page_id, {TITLE} AS title, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'About ' || page_id END AS description, CASE WHEN page_id % 2 = 0 THEN 'https://c.example/' || page_id ELSE '' END AS canonical, {LANG} AS lang FROM pages")
def page_metadata(table):
    i = F.col("page_id").cast("string")
    head = F.concat(F.when(F.expr("page_id % 3 <> 0"), F.concat(F.lit("<META name='description' x content=' About "), i, F.lit(" '>"))).otherwise(""), F.when(F.expr("page_id % 2 = 0"), F.concat(F.lit('<link rel="canonical" href="https://c.example/'), i, F.lit('">'))).otherwise('<link rel="next" href="x">'))
    return table("pages").select("page_id", F.concat("html", head).alias("html")).select("page_id", *[c.alias(k) for k, c in C.metadata("html").items()])


@query(f"SELECT page_id, md5({PLAIN.format(NO_FRAME)}) AS digest, length({PLAIN.format(NO_FRAME)}) AS n FROM pages")
def plain_text(table):
    t = C.plain_text("html")
    return table("pages").select("page_id", F.md5(t).alias("digest"), F.length(t).cast("bigint").alias("n"))


MARKED = "CASE page_id % 7 WHEN 0 THEN html || '<div id=\"__next\">' WHEN 1 THEN html || '<noscript>Please ENABLE JavaScript</noscript>' WHEN 2 THEN 'x' || repeat('<script></script>', 12) WHEN 3 THEN html || 'window.__NUXT__; createRoot (a)' ELSE html END"


@query(f"""WITH h AS (SELECT page_id, {MARKED} AS html FROM pages), m AS (SELECT page_id, [CASE WHEN regexp_matches(html, '(?i)id\\s*=\\s*["'']__next["'']') THEN 'id___next' END, CASE WHEN contains(lower(html), 'window.__nuxt__') THEN 'window_nuxt' END, CASE WHEN contains(lower(html), 'data-reactroot') THEN 'data_reactroot' END,
CASE WHEN regexp_matches(html, '(?i)hydrateRoot\\s*\\(') THEN 'hydrate_root' END, CASE WHEN regexp_matches(html, '(?i)createRoot\\s*\\(') THEN 'create_root' END,
CASE WHEN regexp_matches(lower(regexp_extract(html, '(?is)<noscript[^>]*>(.*?)</noscript>', 1)), 'javascript') AND regexp_matches(lower(regexp_extract(html, '(?is)<noscript[^>]*>(.*?)</noscript>', 1)), 'required|enable') THEN 'noscript_js_required' END,
CASE WHEN len(regexp_extract_all(html, '(?i)<script[ />]')) >= 10 AND length({PLAIN.format(NO_SCRIPTS)}) < 500 THEN 'script_heavy_low_text' END] AS marks FROM h)
SELECT page_id, array_to_string(list_filter(marks, lambda x: x IS NOT NULL), ',') AS markers FROM m""")
def render_markers(table):
    k, h = F.col("page_id") % 7, F.col("html")
    html = F.when(k == 0, F.concat(h, F.lit('<div id="__next">'))).when(k == 1, F.concat(h, F.lit("<noscript>Please ENABLE JavaScript</noscript>"))).when(k == 2, F.lit("x" + "<script></script>" * 12)).when(k == 3, F.concat(h, F.lit("window.__NUXT__; createRoot (a)"))).otherwise(h)
    return table("pages").select("page_id", F.array_join(C.render_markers(html, F.lit("")), ",").alias("markers"))


LINES = "list_filter(list_transform(string_split(regexp_replace(t, '\\r\\n|\\r', chr(10), 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '')"
TOKENS = "list_filter(regexp_split_to_array(lower(t), '[^a-z0-9]+'), lambda x: x <> '')"
QUALITY = f"""(CASE WHEN t = '' THEN 0 ELSE greatest(0, least(100, CASE WHEN length(t) >= 2000 THEN 35 WHEN length(t) >= 1200 THEN 25 WHEN length(t) >= 600 THEN 15 WHEN length(t) >= 300 THEN 5 ELSE 0 END
+ CASE WHEN len(list_filter(regexp_split_to_array(t, '\\n\\s*\\n'), lambda x: trim(x) <> '')) >= 5 THEN 10 WHEN len(list_filter(regexp_split_to_array(t, '\\n\\s*\\n'), lambda x: trim(x) <> '')) >= 2 THEN 5 ELSE 0 END
+ CASE WHEN regexp_matches(t, '(?m)^\\s{{0,3}}#{{1,6}}\\s+\\S') THEN 10 ELSE 0 END + CASE WHEN len(regexp_extract_all(t, '[.!?]+')) >= 12 THEN 5 ELSE 0 END + CASE WHEN title <> '' THEN 5 ELSE 0 END
- CASE WHEN list_sum(list_transform(regexp_extract_all(t, '\\[([^\\]]+)\\]\\([^\\)]+\\)', 1), lambda x: length(trim(x)))) / greatest(length(t), 1) > 0.45 THEN 20 ELSE 0 END
- CASE WHEN len({LINES}) > 0 AND (len({LINES}) - len(list_distinct({LINES}))) / len({LINES}) > 0.30 THEN 10 ELSE 0 END
- CASE WHEN len({TOKENS}) > 0 AND len(list_filter({TOKENS}, lambda x: x IN ({", ".join(f"'{w}'" for w in C.BOILERPLATE)}))) / len({TOKENS}) > 0.35 THEN 10 ELSE 0 END)) END)"""


@query(f"""WITH r AS (SELECT doc_id, trim(text, E' \\n\\t\\r') AS t, CASE WHEN lang = 'en' THEN 'x' ELSE '' END AS title FROM documents), s AS (SELECT doc_id, {QUALITY} AS score FROM r)
SELECT doc_id, CAST(score AS BIGINT) AS score, CASE WHEN score >= 35 THEN 'ok' ELSE 'low' END AS quality, CASE WHEN score >= 35 THEN '' ELSE 'score_below_threshold:' || CAST(score AS VARCHAR) || '<35' END AS reason FROM s""")
def content_quality_score(table):
    rows = C.with_quality(table("documents"), "text", F.when(F.col("lang") == "en", "x").otherwise(""), F.lit("")).select("doc_id", F.col("score").cast("bigint").alias("score"))
    grade, why = C.graded(F.col("score"))
    return rows.select("doc_id", "score", grade.alias("quality"), why.alias("reason"))


@query(f"""WITH r AS (SELECT page_id, {TITLE} AS title, {PLAIN.format(NO_FRAME)} AS a, {PLAIN.format(NO_SCRIPTS)} AS b FROM pages), s AS (SELECT page_id, (SELECT {QUALITY} FROM (SELECT a AS t)) AS sa, (SELECT {QUALITY} FROM (SELECT b AS t)) AS sb FROM r)
SELECT page_id, CASE WHEN sb >= 35 THEN 'whole' WHEN sa = greatest(sa, sb) THEN 'body' ELSE 'whole' END AS extractor, CAST(CASE WHEN sb >= 35 THEN sb ELSE greatest(sa, sb) END AS BIGINT) AS score, sa < 35 AND sb > sa AS second_wins FROM s""")
def best_extractor(table):
    title = C.metadata("html")["title"]
    whole = T.collapse(F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)[^>]*>.*?</\1>", " "), "(?s)<[^>]*>", " "))
    rows = table("pages").select("page_id", title.alias("title"), C.plain_text("html").alias("a"), whole.alias("b"))
    rows = C.with_quality(C.with_quality(rows, "a", F.col("title"), F.lit(""), "body"), "b", F.col("title"), F.lit(""), "whole")
    best = C.best_extractor({"body": F.col("body"), "whole": F.col("whole")}, preferred="whole")
    return rows.select("page_id", best.alias("extractor"), F.when(best == "whole", F.col("whole")).otherwise(F.col("body")).cast("bigint").alias("score"), C.rendered_wins(F.col("body"), F.col("whole")).alias("second_wins"))


ATTEMPTS = "SELECT user_id AS org, event_type || '-' || CAST(event_id % 4 AS VARCHAR) AS url, event_id, CASE WHEN value > 60 THEN 'failed' WHEN value > 30 THEN 'skipped' ELSE 'success' END AS status, CASE WHEN value > 45 THEN 'timeout' WHEN value > 30 THEN 'already_success' ELSE '' END AS detail, CASE WHEN event_id % 3 = 0 OR user_id % 5 = 0 THEN 'low' ELSE 'ok' END AS quality FROM events"


def attempts(table):
    """Events as attempts to fetch pages."""
    v = F.col("value")
    return table("events").select(F.col("user_id").alias("org"), F.concat_ws("-", "event_type", (F.col("event_id") % 4).cast("string")).alias("url"), "event_id", F.when(v > 60, "failed").when(v > 30, "skipped").otherwise("success").alias("status"), F.when(v > 45, "timeout").when(v > 30, "already_success").otherwise("").alias("detail"), F.when(F.expr("event_id % 3 = 0 or user_id % 5 = 0"), "low").otherwise("ok").alias("quality"))


LATEST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org, url ORDER BY event_id DESC) AS r FROM ({ATTEMPTS})) WHERE r = 1"


@query(f"SELECT org, url, event_id, status FROM ({LATEST})")
def scrape_manifest_latest(table):
    return inc.latest(attempts(table), ["org", "url"], "event_id").select("org", "url", "event_id", "status")


@query(f"SELECT status, detail, count(*) AS n, count(DISTINCT org) AS orgs, max(event_id) AS last FROM ({ATTEMPTS}) GROUP BY 1, 2")
def attempt_and_failure_counts(table):
    return attempts(table).groupBy("status", "detail").agg(F.count("*").alias("n"), F.count_distinct("org").alias("orgs"), F.max("event_id").alias("last"))


@query(f"""WITH g AS (SELECT org, count(*) AS total_count, count(*) FILTER (WHERE status = 'success' OR (status = 'skipped' AND detail = 'already_success')) AS success_count,
count(*) FILTER (WHERE (status = 'success' OR (status = 'skipped' AND detail = 'already_success')) AND quality = 'low') AS low_count FROM ({LATEST}) GROUP BY 1)
SELECT org, total_count, success_count, CASE WHEN success_count = 0 THEN 0 ELSE low_count END AS low_count, CASE WHEN success_count = 0 THEN 'no_success_pages' WHEN low_count >= success_count THEN 'all_success_low_quality' ELSE '' END AS reason, success_count = 0 OR low_count >= success_count AS flagged FROM g""")
def scrape_quality_flags(table):
    last = inc.latest(attempts(table), ["org", "url"], "event_id")
    return screening.scrape_quality(last, "org", "status", "detail", "quality").select("org", "total_count", "success_count", "low_count", "reason", "flagged")


SPLIT = """SELECT source, doc_id AS page, unnest(s) AS raw, generate_subscripts(s, 1) - 1 AS pos FROM (SELECT source, doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)"""
SEG = f"""WITH s AS ({SPLIT}), n AS (SELECT *, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS flat FROM s), h AS (SELECT *, sha1(flat) AS digest FROM n), t AS (SELECT source, count(*) AS total FROM documents GROUP BY 1),
d AS (SELECT source, digest, count(DISTINCT page) AS page_count, min(page) AS kept_page, max(flat) AS flat FROM h WHERE length(flat) >= 20 GROUP BY 1, 2),
u AS (SELECT d.* FROM d JOIN t USING (source) WHERE page_count >= greatest(2, CAST(ceil(CAST(total AS DOUBLE) * CAST(0.02 AS DOUBLE)) AS BIGINT))),
f AS (SELECT h.*, u.digest IS NOT NULL AS dup, u.digest IS NOT NULL AND u.kept_page <> h.page AS gone FROM h LEFT JOIN u ON h.source = u.source AND h.digest = u.digest),
p AS (SELECT source, page, count(*) AS segments_total, count(*) FILTER (WHERE NOT gone) AS segments_kept, count(*) FILTER (WHERE gone) AS segments_removed, sum(length(raw)) + 2 * (count(*) - 1) AS chars_raw,
coalesce(sum(length(raw)) FILTER (WHERE NOT dup), 0) AS usable_chars, coalesce(string_agg(raw, chr(10) || chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS content FROM f GROUP BY 1, 2)"""


def segmented(table):
    """Documents as pages of their source; lines as segments."""
    docs = table("documents")
    segs = segments.split(docs, "source", "doc_id", "doc_id", "text", "\n")
    dup = segments.duplicates(segs, "source", docs.groupBy("source").agg(F.count("*").alias("page_total")), 20, 0.02)
    return segs, dup


@query(SEG + " SELECT source, page, segments_total, segments_kept, segments_removed, CAST(chars_raw AS BIGINT) AS chars_raw, CAST(usable_chars AS BIGINT) AS usable_chars, md5(content) AS content FROM p")
def segment_dedup_pages(table):
    segs, dup = segmented(table)
    return segments.pages(segments.flagged(segs, dup, "source"), "source").select("source", "page", "segments_total", "segments_kept", "segments_removed", "chars_raw", "usable_chars", F.md5("content").alias("content"))


@query(SEG + " SELECT source, digest, page_count, kept_page, CAST(length(flat) AS BIGINT) AS length, substr(flat, 1, 240) AS preview FROM u")
def segment_duplicates_audit(table):
    return segmented(table)[1].select("source", "digest", "page_count", "kept_page", "length", "preview")


@query(SEG + " SELECT source, count(*) AS pages_written, CAST(sum(segments_total) AS BIGINT) AS segments_total, CAST(sum(segments_removed) AS BIGINT) AS segments_removed, CAST(sum(chars_raw) AS BIGINT) AS chars_raw, CAST(sum(length(content)) AS BIGINT) AS chars_cleaned, CAST(sum(usable_chars) AS BIGINT) AS usable_chars FROM p GROUP BY 1")
def segment_dedup_summary(table):
    segs, dup = segmented(table)
    return segments.summary(segments.pages(segments.flagged(segs, dup, "source"), "source"), "source")


FLAT = lambda c: f"trim(regexp_replace(regexp_replace(lower(replace(replace(replace(replace(replace(replace(replace({c}, 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'Ä', 'ae'), 'Ö', 'oe'), 'Ü', 'ue'), 'ß', 'ss')), '[^a-z0-9\\s-]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH r AS (SELECT doc_id, ' ' || {FLAT('text')} || ' ' AS t, CASE doc_id % 3 WHEN 0 THEN 'thing (of) that' WHEN 1 THEN 'The with [x]' ELSE 'zzzz qqqq' END AS name, CASE doc_id % 2 WHEN 0 THEN 'the' ELSE 'Nowhere' END AS place, 'https://www.thatorg.example.com/' AS url FROM documents),
n AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN contains(t, ' thing of that ') OR contains(t, ' thing that ') WHEN 1 THEN contains(t, ' the with x ') OR contains(t, ' the with ') ELSE false END AS name_exact,
CASE doc_id % 3 WHEN 0 THEN contains(t, ' thing ') AND contains(t, ' that ') WHEN 1 THEN false ELSE contains(t, ' zzzz ') AND contains(t, ' qqqq ') END AS name_tokens, contains(t, ' ' || lower(place) || ' ') AS located, doc_id % 3 = 0 AS hint FROM r),
s AS (SELECT *, CASE WHEN name_exact THEN 65 WHEN name_tokens THEN 40 ELSE 0 END + CASE WHEN located THEN 25 ELSE 0 END + CASE WHEN hint THEN 10 ELSE 0 END AS rule_score, doc_id % 4 = 0 AS belongs, (doc_id % 10) * 11 AS answer FROM n)
SELECT doc_id, name_exact, name_tokens, located, CAST(least(100, rule_score) AS BIGINT) AS rule_score, CASE WHEN (name_exact AND located) OR (rule_score >= 25 AND belongs AND answer >= 80) THEN 'confirmed' ELSE 'review_required' END AS status,
CASE WHEN (name_exact AND located) OR (rule_score >= 25 AND belongs AND answer >= 80) THEN 'high' WHEN rule_score >= 25 THEN CASE WHEN answer >= 50 THEN 'medium' ELSE 'low' END WHEN rule_score >= 40 THEN 'medium' ELSE 'low' END AS confidence FROM s""")
def verify_name_location(table):
    k = F.col("doc_id") % 3
    rows = table("documents").select("doc_id", screening.padded("text").alias("key"), F.when(k == 0, "thing (of) that").when(k == 1, "The with [x]").otherwise("zzzz qqqq").alias("name"), F.when(F.expr("doc_id % 2 = 0"), "the").otherwise("Nowhere").alias("place"), F.lit("https://www.thatorg.example.com/").alias("url"))
    found = screening.named("name", F.col("key"))
    rows = rows.select("doc_id", found["name_exact"].alias("name_exact"), found["name_tokens"].alias("name_tokens"), screening.placed("place", F.col("key")).alias("located"), screening.domain_hint("name", F.col("url")).alias("hint"))
    rows = rows.withColumn("rule_score", screening.rule_score(F.col("name_exact"), F.col("name_tokens"), F.col("located"), F.col("hint")).cast("bigint"))
    out = screening.verify(F.col("name_exact"), F.col("located"), F.col("rule_score"), F.expr("doc_id % 4 = 0"), (F.col("doc_id") % 10) * 11)
    return rows.select("doc_id", "name_exact", "name_tokens", "located", "rule_score", out["status"].alias("status"), out["confidence"].alias("confidence"))


@query("""WITH r AS (SELECT source, doc_id, text, coalesce(sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents)
SELECT source, doc_id, CAST(length(substr(text, 1, CAST(9000 - b AS BIGINT))) AS BIGINT) AS n, md5(substr(text, 1, CAST(9000 - b AS BIGINT))) AS digest FROM r WHERE b < 9000""")
def clip_content_budget(table):
    out = evidence.clipped(table("documents"), "source", ["doc_id"], "text", 9000)
    return out.select("source", "doc_id", F.length("clipped").cast("bigint").alias("n"), F.md5("clipped").alias("digest"))


COUNT = lambda t, w: f"len(regexp_extract_all({t}, '(?i)\\b{w}\\b'))"


@query(f"""WITH r AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS file_order, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents),
c AS (SELECT source, file_order, {COUNT('t', 'that')} + {COUNT('t', 'with')} AS match_count, trim(substr(t, 1, 400)) AS cut FROM r WHERE length(t) >= 60),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY match_count DESC, file_order) AS rank FROM c WHERE cut <> '')
SELECT source, CAST(rank AS BIGINT) AS rank, CAST(file_order AS BIGINT) AS file_order, match_count, md5(cut) AS snippet FROM k WHERE rank <= 6""")
def keyword_snippets(table):
    out = evidence.snippets(table("documents"), "source", "doc_id", "text", terms=["that", "with"], least=60, chars=400, most=6)
    return out.select("source", F.col("rank").cast("bigint").alias("rank"), F.col("file_order").cast("bigint").alias("file_order"), "match_count", F.md5("snippet").alias("snippet"))


@query()
def budgeted_snippets(table):
    out = evidence.snippets(table("documents"), "source", "doc_id", "text", terms=["that"], matches_only=True, chars=300, most=12, total=1000)
    return out.select("source", F.col("rank").cast("bigint").alias("rank"), F.col("file_order").cast("bigint").alias("file_order"), "match_count", "snippet")


XML = "'<urlset><url><loc>' || url || '</loc><lastmod>2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '</lastmod><priority>0.' || CAST(page_id % 10 AS VARCHAR) || '</priority></url></urlset>'"


@query("SELECT page_id, replace(url, '&', '&') AS loc, '2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS lastmod, (page_id % 10) / 10.0 AS priority, false AS is_index, page_id % 10 >= 5 OR url NOT LIKE '%/en/%' AS allowed, ['https://a.example/s.xml'] AS sitemaps FROM pages")
def sitemaps_and_robots(table):
    xml = F.concat(F.lit("<urlset><url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"), F.lit("</lastmod><priority>0."), (F.col("page_id") % 10).cast("string"), F.lit("</priority></url></urlset>"))
    robots = F.when(F.expr("page_id % 10 >= 5"), F.lit("User-agent: *\nDisallow: /private\nSitemap: https://a.example/s.xml # all")).otherwise(F.lit("# none\nUser-agent: *\nDisallow: /en/\nsitemap:https://a.example/s.xml"))
    rows = table("pages").select("page_id", F.inline(files.sitemap_entries(xml)), files.robots_allows(robots, F.regexp_extract("url", "^https?://[^/]+([^?#]*)", 1)).alias("allowed"), files.robots_sitemaps(robots).alias("sitemaps"))
    return rows


@query("""WITH w AS (SELECT o_custkey AS page, o_orderkey AS k, o_orderstatus AS s, o_orderpriority AS p, count(*) FILTER (WHERE o_orderkey % 5 = 0) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island FROM orders)
SELECT page, CAST(max(k) FILTER (WHERE k % 5 = 0) * 10 AS BIGINT) AS line, trim(string_agg('n ' || s, ' ' ORDER BY k)) AS name, max(p) FILTER (WHERE k % 5 = 0) AS place, 'a' AS category FROM w GROUP BY page, island HAVING count(*) FILTER (WHERE k % 5 = 0) > 0""")
def positioned_rows(table):
    orders = table("orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").cast("double").alias("top"), "o_orderkey", "o_orderstatus", "o_orderpriority")
    word = lambda df, x, t: df.select("page", "top", F.lit(x).alias("x0"), t.alias("text"))
    marked = orders.filter("o_orderkey % 5 = 0")
    words = word(orders, 10.0, F.lit("n")).unionByName(word(orders, 50.0, F.col("o_orderstatus"))).unionByName(word(marked, 460.0, F.col("o_orderpriority"))).unionByName(word(marked, 600.0, F.lit("a")))
    return files.table_lines(words).select("page", "line", "name", "place", "category")
