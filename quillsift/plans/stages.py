"""Queries: normalised URLs, work queues, prepared pages, outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stages as S
from ..operators.screening import CODES
from .base import query
from .web import AUTHORITY, RULES, link_rows

SITES = "SELECT c_custkey AS id, CASE c_custkey % 8 WHEN 0 THEN '' WHEN 1 THEN 'ftp://x.org/' WHEN 2 THEN 'https://n' || c_nationkey || '.org' WHEN 3 THEN 'https://n' || c_nationkey || '.org/' WHEN 4 THEN 'https://n' || c_nationkey || '.org/?a=1' WHEN 5 THEN 'https://n.org/club/x' || c_custkey WHEN 6 THEN 'https://n.org/leaf' ELSE 'http://n.org/de/' END AS url, c_acctbal FROM customer"


def sites(table):
    """Customers with websites of all kinds."""
    k, n = F.col("c_custkey") % 8, F.col("c_nationkey").cast("string")
    host = F.concat(F.lit("https://n"), n, F.lit(".org"))
    url = F.when(k == 0, "").when(k == 1, "ftp://x.org/").when(k == 2, host).when(k == 3, F.concat(host, F.lit("/"))).when(k == 4, F.concat(host, F.lit("/?a=1"))).when(k == 5, F.concat(F.lit("https://n.org/club/x"), F.col("c_custkey").cast("string"))).when(k == 6, "https://n.org/leaf").otherwise("http://n.org/de/")
    return table("customer").select(F.col("c_custkey").alias("id"), url.alias("url"), "c_acctbal")


OUTCOMES = f"""SELECT id, url, CASE id % 8 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 5 THEN url || '/' WHEN 6 THEN 'https://n.org/' WHEN 7 THEN 'http://n.org/' WHEN 3 THEN url WHEN 4 THEN replace(url, '?a=1', '') ELSE url || '/' END AS normalized_url,
CASE id % 8 WHEN 0 THEN 'no_website' WHEN 1 THEN 'invalid_or_unsupported_url' WHEN 5 THEN 'kept_path_prefix' WHEN 6 THEN 'single_leaf_promoted_to_host_root' WHEN 7 THEN 'scaffold_promoted_to_host_root:language_root_seed' ELSE 'root_seed' END AS scope_reason,
id % 8 IN (4, 6, 7) AS changed, id % 8 >= 5 AS review_needed, CASE id % 8 WHEN 0 THEN 'no_website' WHEN 1 THEN 'invalid_or_unsupported_url' WHEN 2 THEN 'trailing_slash_only' WHEN 3 THEN 'already_root_domain' WHEN 4 THEN 'changed' ELSE 'path_requires_review' END AS unchanged_indicator,
CASE WHEN id % 8 IN (0, 1) THEN 'none' WHEN id % 8 = 5 THEN 'low' WHEN id % 8 = 6 THEN 'medium' WHEN id % 8 = 7 THEN 'high' ELSE 'very_high' END AS confidence FROM ({SITES})"""


@query(f"SELECT id, normalized_url, scope_reason, changed, review_needed, unchanged_indicator, confidence FROM ({OUTCOMES})")
def url_norm_outcomes(table):
    return S.normalised(sites(table), "url", RULES).select("id", "normalized_url", "scope_reason", "changed", "review_needed", "unchanged_indicator", "confidence")


REASON = "CASE WHEN id % 9 = 0 THEN 'other' WHEN id % 10 = 0 THEN 'no code' ELSE '' END"
DECIDED = "CASE WHEN id % 11 = 0 THEN 'excluded' WHEN id % 13 = 0 THEN 'custom_url' ELSE '' END"


def reasons(rows):
    i = F.col("id")
    return rows.withColumn("reason", F.when(i % 9 == 0, "other").when(i % 10 == 0, "no code").otherwise(""))


@query(f"""WITH r AS (SELECT *, {REASON} AS reason, {DECIDED} AS d, CASE WHEN id % 13 = 0 THEN 'https://own/' ELSE '' END AS f FROM ({OUTCOMES})), v AS (SELECT *, upper(reason) IN ('OTHER') AS gone, CASE WHEN d = 'excluded' AND upper(reason) <> 'OTHER' THEN '' ELSE d END AS k FROM r)
SELECT id, CASE WHEN gone THEN '' WHEN NOT review_needed THEN CASE WHEN normalized_url <> '' THEN normalized_url ELSE url END ELSE f END AS final, CASE WHEN gone THEN CASE WHEN d = '' THEN 'excluded' ELSE d END WHEN NOT review_needed AND k = '' THEN CASE WHEN normalized_url <> '' THEN 'auto_resolved' WHEN url <> '' THEN 'auto_keep_original' ELSE '' END ELSE k END AS decision FROM v""")
def url_norm_final(table):
    i = F.col("id")
    rows = reasons(S.normalised(sites(table), "url", RULES)).withColumns({"decision": F.when(i % 11 == 0, "excluded").when(i % 13 == 0, "custom_url").otherwise(""), "final": F.when(i % 13 == 0, "https://own/").otherwise("")})
    return S.finalised(rows, "url", "normalized_url", "review_needed", "reason", "decision", "final").select("id", "final", "decision")


@query(f"""WITH r AS (SELECT *, {REASON} AS reason, CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN 'high' ELSE 'low' END AS conf, CASE id % 5 WHEN 0 THEN '' WHEN 1 THEN 'no_match' WHEN 2 THEN 'search_error' ELSE 'matched' END AS reg, CASE id % 3 WHEN 0 THEN 'blocked' WHEN 1 THEN 'no_urls' ELSE 'ready' END AS prep, CASE id % 2 WHEN 0 THEN 'seed_unreachable' ELSE 'ok' END AS rob, CASE id % 7 WHEN 0 THEN 'approved' WHEN 1 THEN 'deferred' ELSE '' END AS st FROM ({OUTCOMES})),
v AS (SELECT *, upper(trim(reason)) IN ({", ".join(f"'{c}'" for c in CODES)}) AS gone, prep = 'blocked' OR (prep = 'no_urls' AND rob = 'seed_unreachable') AS crit FROM r)
SELECT count(*) FILTER (WHERE conf = '' AND NOT gone) AS discovery, count(*) FILTER (WHERE (url = '' OR review_needed) AND NOT gone) AS website, count(*) FILTER (WHERE reg = '' AND NOT gone) AS registry, count(*) FILTER (WHERE reg IN ('no_match', 'search_error') AND NOT gone) AS registry_review,
count(*) FILTER (WHERE review_needed AND NOT gone) AS normalisation, count(*) FILTER (WHERE crit AND (CASE WHEN st = '' THEN 'pending' ELSE st END) NOT IN ('approved', 'excluded', 'not_required')) AS readiness FROM v""")
def review_queues(table):
    i = F.col("id")
    rows = reasons(S.normalised(sites(table), "url", RULES)).withColumns(
        {
            "conf": F.when(i % 4 == 0, "").when(i % 4 == 1, "high").otherwise("low"),
            "reg": F.when(i % 5 == 0, "").when(i % 5 == 1, "no_match").when(i % 5 == 2, "search_error").otherwise("matched"),
            "prep": F.when(i % 3 == 0, "blocked").when(i % 3 == 1, "no_urls").otherwise("ready"),
            "rob": F.when(i % 2 == 0, "seed_unreachable").otherwise("ok"),
            "st": F.when(i % 7 == 0, "approved").when(i % 7 == 1, "deferred").otherwise(""),
            "final": F.lit(""),
        }
    )
    ready = S.readiness(rows, "prep", "rob", "st")
    in_queue = S.critical_readiness("prep", "rob") & ~F.col("st").isin("approved", "excluded", "not_required")
    return ready.agg(
        F.count_if(S.needs_discovery("conf", "reason")).alias("discovery"),
        F.count_if(S.needs_website_review("url", "review_needed", "reason")).alias("website"),
        F.count_if(S.needs_registry("reg", "reason")).alias("registry"),
        F.count_if(~F.upper("reason").isin(*CODES) & F.col("reg").isin("no_match", "search_error")).alias("registry_review"),
        F.count_if(S.unresolved_normalisation("review_needed", "final", "reason")).alias("normalisation"),
        F.count_if(in_queue).alias("readiness"),
    )


STATUS = "SELECT d.doc_id AS id, CASE d.doc_id % 4 WHEN 0 THEN 'manual' WHEN 1 THEN 'manual_llm' ELSE 'automatic' END AS origin, CASE WHEN d.doc_id % 3 = 0 THEN 'https://x/' ELSE '' END AS url, CASE d.doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'review_required' WHEN 2 THEN 'confirmed' ELSE 'url_changed_needs_rescrape' END AS status, CASE WHEN d.doc_id % 17 = 0 THEN 'OTHER' ELSE '' END AS reason, quality IS NOT NULL AS has FROM documents d LEFT JOIN labels l USING (doc_id)"


def statuses(table):
    i = F.col("doc_id")
    return table("documents").select(i.alias("id"), F.when(i % 4 == 0, "manual").when(i % 4 == 1, "manual_llm").otherwise("automatic").alias("origin"), F.when(i % 3 == 0, "https://x/").otherwise("").alias("url"), F.when(i % 5 == 0, "").when(i % 5 == 1, "review_required").when(i % 5 == 2, "confirmed").otherwise("url_changed_needs_rescrape").alias("status"), F.when(i % 17 == 0, "OTHER").otherwise("").alias("reason"), (i % 5 == 1).alias("review"), F.lit("").alias("why"))


def cleaned(table):
    """Labelled documents as entities with cleaned text."""
    return S.eligible(table("labels").select(F.col("doc_id").alias("id"), F.lit("ok").alias("s"), F.lit("5").alias("n")), "id", "s", "n")


@query(f"""WITH r AS (SELECT *, origin IN ('manual', 'manual_llm') AND url <> '' AND status IN ('', 'review_required', 'url_changed_needs_rescrape') AS hit FROM ({STATUS}))
SELECT id, CASE WHEN hit THEN 'confirmed' ELSE status END AS status, NOT hit AND id % 5 = 1 AND reason <> 'OTHER' AS queued, has AND reason <> 'OTHER' AND (CASE WHEN hit THEN 'confirmed' ELSE status END) IN ('', 'url_changed_needs_rescrape') AS pending FROM r""")
def verify_queues(table):
    rows = S.confirm_manual(statuses(table), "origin", ["url"], "status", "review", "why")
    queued = S.mismatch_queue(rows, "review", "reason").select("id", F.lit(True).alias("q"))
    pending = S.verify_pending(rows, cleaned(table), "id", "status", "reason").select("id", F.lit(True).alias("p"))
    out = rows.join(queued, "id", "left").join(pending, "id", "left")
    return out.select("id", "status", F.coalesce("q", F.lit(False)).alias("queued"), F.coalesce("p", F.lit(False)).alias("pending"))


@query(f"SELECT count(*) AS blocking FROM ({STATUS}) WHERE has AND reason = '' AND status <> 'confirmed'")
def verify_gate(table):
    return S.verify_gate(statuses(table), cleaned(table), "id", "status", "reason")


@query(f"""WITH r AS (SELECT *, CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN 'waiting_for_clean_text' ELSE 'auto_accepted' END AS auto FROM ({STATUS}))
SELECT id, CASE WHEN reason = '' AND NOT has AND auto = '' THEN 'waiting_for_clean_text' WHEN reason = '' AND has AND auto = 'waiting_for_clean_text' THEN '' ELSE auto END AS auto FROM r""")
def waiting_rows(table):
    i = F.col("id")
    rows = statuses(table).withColumn("auto", F.when(i % 3 == 0, "").when(i % 3 == 1, "waiting_for_clean_text").otherwise("auto_accepted"))
    return S.waiting(rows, cleaned(table), "id", "auto", "reason").select("id", "auto")


FETCH = """SELECT event_id, CASE event_id % 40 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connect' END AS err, CASE event_id % 20 WHEN 2 THEN 403 WHEN 3 THEN 503 WHEN 4 THEN 404 WHEN 5 THEN 401 ELSE 200 END AS http, CASE event_id % 15 WHEN 3 THEN 'image/png' WHEN 4 THEN 'text/plain; charset=x' WHEN 6 THEN 'application/pdf' ELSE 'text/html' END AS kind,
CASE WHEN event_id % 2 = 0 THEN 'body' ELSE '' END AS body, v * 2 % 70 AS bs, v % 60 AS ss, CASE WHEN event_id % 7 = 0 THEN '' ELSE 'text' END AS st, CASE event_id % 3 WHEN 0 THEN 'success' WHEN 1 THEN 'error' END AS rs, CASE event_id % 6 WHEN 1 THEN 'Failed to launch' WHEN 2 THEN 'off' WHEN 4 THEN 'timeout' WHEN 5 THEN 'off' ELSE '' END AS rd, v * 3 % 70 AS sc,
CASE WHEN event_id % 11 = 0 THEN '' ELSE 'rendered' END AS rt, CASE WHEN event_id % 4 = 0 THEN 'poor_static_extraction:markers=a,b' ELSE 'poor_static_extraction' END AS trig FROM (SELECT event_id, CAST(floor(value) AS INT) AS v FROM events)"""


@query(f"""WITH r AS ({FETCH}), c AS (SELECT *, CASE WHEN err = 'timeout' THEN 'network_timeout' WHEN err = 'connect' THEN 'network_dns_failure' WHEN http IN (401, 403) THEN 'http_' || http WHEN http >= 500 THEN 'http_5xx' WHEN http <> 200 THEN 'http_other' END AS code, CASE WHEN err IS NOT NULL THEN 'broken' WHEN http = 404 THEN 'http_404' ELSE '' END AS why,
CASE kind WHEN 'application/pdf' THEN CASE WHEN body = '' THEN 'pdf_text_extraction_failed' ELSE 'non_html:application_pdf' END WHEN 'image/png' THEN 'non_html_unsupported:image/png' ELSE CASE WHEN body = '' THEN 'text_like_content_empty' ELSE 'non_html:text/plain' END END AS nh FROM r),
k AS (SELECT *, CASE WHEN code IS NOT NULL AND rs = 'success' THEN 'A' WHEN code IS NOT NULL THEN 'B' WHEN kind <> 'text/html' AND kind <> 'image/png' AND body <> '' THEN 'C' WHEN kind <> 'text/html' THEN 'D' WHEN ss >= 35 THEN 'E' WHEN rs = 'success' AND sc > ss THEN 'F' WHEN rs = 'success' THEN 'G' WHEN st <> '' THEN 'H' ELSE 'I' END AS k FROM c),
s AS (SELECT *, CASE WHEN k IN ('A', 'F') THEN sc WHEN k = 'C' THEN bs WHEN k IN ('B', 'D') THEN 0 ELSE ss END AS score, CASE WHEN k IN ('A', 'B') THEN 'http_failure_fallback:' || code END AS fallback FROM k)
SELECT event_id, CASE WHEN k IN ('B', 'D', 'I') THEN 'failed' ELSE 'success' END AS status, CASE k WHEN 'B' THEN code WHEN 'D' THEN 'non_html_response' WHEN 'I' THEN 'playwright_render_failed' ELSE '' END AS failure, CASE k WHEN 'B' THEN CASE WHEN why = '' OR rd = '' THEN why || rd ELSE why || '; ' || rd END WHEN 'D' THEN nh WHEN 'I' THEN rd ELSE '' END AS detail,
CASE WHEN k IN ('A', 'B', 'F', 'I') THEN 'playwright' ELSE 'static' END AS mode, CAST(score AS BIGINT) AS score, CAST(CASE WHEN k IN ('A', 'B', 'D') THEN 0 WHEN k = 'C' THEN bs ELSE ss END AS BIGINT) AS static_score, CAST(CASE WHEN k IN ('A', 'F', 'G') THEN sc WHEN k IN ('B', 'I') THEN 0 END AS BIGINT) AS rendered_score,
CASE WHEN k IN ('B', 'D', 'I') THEN '' WHEN k = 'H' OR score < 35 THEN 'low' ELSE 'ok' END AS quality,
CASE WHEN k IN ('B', 'D', 'I') THEN '' WHEN k = 'H' THEN 'low_score_static:' || ss || ';render_' || CASE WHEN rd = 'Failed to launch' THEN 'unavailable:' ELSE 'failed:' END || rd WHEN score >= 35 THEN '' ELSE CASE k WHEN 'A' THEN fallback WHEN 'C' THEN nh ELSE 'low_score_after_render:selected=' || score END || ';score_below_threshold:' || score || '<35' END AS quality_reason,
CASE WHEN k IN ('A', 'B') THEN fallback WHEN k = 'C' THEN nh WHEN k IN ('F', 'G', 'I') THEN trig WHEN k = 'H' THEN trig || ':render_fallback=' || rd ELSE '' END AS trigger,
CASE WHEN k IN ('B', 'D') THEN '' WHEN k IN ('A', 'F') THEN CASE WHEN rt = '' THEN 'stub' ELSE rt END WHEN k = 'C' THEN body WHEN k = 'G' AND st = '' THEN 'stub' ELSE st END AS content FROM s""")
def scrape_outcome(table):
    i, v = F.col("event_id"), F.floor("value").cast("int")
    marks = F.when(i % 4 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    out = S.outcome(
        table("events"),
        error=F.when(i % 40 == 0, "timeout").when(i % 40 == 1, "connect"),
        message=F.lit("broken"),
        http=F.when(i % 20 == 2, 403).when(i % 20 == 3, 503).when(i % 20 == 4, 404).when(i % 20 == 5, 401).otherwise(200),
        content_type=F.when(i % 15 == 3, "image/png").when(i % 15 == 4, "text/plain; charset=x").when(i % 15 == 6, "application/pdf").otherwise("text/html"),
        body=F.when(i % 2 == 0, "body").otherwise(""),
        body_score=v * 2 % 70,
        static_score=v % 60,
        static_text=F.when(i % 7 == 0, "").otherwise("text"),
        rendered_status=F.when(i % 3 == 0, "success").when(i % 3 == 1, "error"),
        rendered_detail=F.when(i % 6 == 1, "Failed to launch").when(i % 6 == 4, "timeout").when(i % 3 == 2, "off").otherwise(""),
        rendered_score=v * 3 % 70,
        rendered_text=F.when(i % 11 == 0, "").otherwise("rendered"),
        markers=marks,
        stub=F.lit("stub"),
    )
    scores = {c: F.col(c).cast("bigint") for c in ("score", "static_score", "rendered_score")}
    return out.withColumns(scores).select("event_id", "status", "failure", "detail", "mode", *scores, "quality", "quality_reason", "trigger", "content")


@query("""WITH g AS (SELECT user_id, count(*) FILTER (WHERE value > 5) AS a, count(*) FILTER (WHERE value > 5 AND value <= 60) AS s, count(*) FILTER (WHERE value > 60) AS f, count(*) FILTER (WHERE value <= 5) AS k FROM (SELECT user_id, CASE WHEN user_id % 4 = 0 AND value <= 60 THEN 90 WHEN user_id % 16 = 1 THEN 1 ELSE value END AS value FROM events) GROUP BY 1)
SELECT user_id, CASE WHEN a = 0 AND k > 0 THEN 'already_success' WHEN s > 0 THEN 'success:' || s || '/' || a ELSE 'failed:' || f || '/' || a END AS outcome FROM g""")
def entity_outcomes(table):
    v = F.col("value")
    rows = table("events").withColumn("value", F.expr("case when user_id % 4 = 0 and value <= 60 then 90 when user_id % 16 = 1 then 1 else value end")).groupBy("user_id").agg(F.count_if(v > 5).alias("a"), F.count_if((v > 5) & (v <= 60)).alias("s"), F.count_if(v > 60).alias("f"), F.count_if(v <= 5).alias("k"))
    return rows.select("user_id", S.entity_outcome(F.col("a"), F.col("s"), F.col("f"), F.col("k")).alias("outcome"))


@query("""WITH RECURSIVE e AS (SELECT o_custkey AS entity, o_orderkey AS a, o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_orderkey % 40 END AS b FROM orders UNION ALL SELECT o_custkey, o_orderkey + 1, o_orderkey + 2 FROM orders), w AS (SELECT DISTINCT entity, 'n' || a AS url, 'n' || b AS link FROM e),
s AS (SELECT entity, min(url) AS url FROM w GROUP BY 1), r AS (SELECT entity, url, 0 AS step FROM s UNION SELECT w.entity, w.link, r.step + 1 FROM r JOIN w ON r.entity = w.entity AND r.url = w.url WHERE r.step < 3)
SELECT entity, url, CAST(min(step) AS BIGINT) AS step FROM r GROUP BY 1, 2""")
def follow_links(table):
    k = F.col("o_orderkey")
    node = lambda c: F.concat(F.lit("n"), c.cast("string"))
    orders = table("orders").select(F.col("o_custkey").alias("entity"), "o_orderkey")
    rows = orders.select("entity", node(k).alias("url"), node(k + F.when(k % 3 == 0, 1).otherwise(k % 40)).alias("link")).unionByName(orders.select("entity", node(k + 1).alias("url"), node(k + 2).alias("link"))).distinct()
    return S.follow(rows, rows.groupBy("entity").agg(F.min("url").alias("url")), 3).select("entity", "url", F.col("step").cast("bigint").alias("step"))


@query("""WITH a AS (SELECT o_custkey AS e, o_orderkey AS ord, o_orderkey % 7 AS u FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT o_custkey AS e, o_orderkey AS ord, o_orderkey % 7 AS u FROM orders WHERE o_orderkey % 2 = 1),
n AS (SELECT b.*, row_number() OVER (PARTITION BY b.e, b.u ORDER BY b.ord) AS k FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.e = b.e AND a.u = b.u)),
h AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY ord) AS h FROM b), c AS (SELECT e, count(*) AS n FROM a GROUP BY 1), m AS (SELECT n.e, n.ord, n.u, row_number() OVER (PARTITION BY n.e ORDER BY n.ord) AS i, coalesce(c.n, 0) AS have, h.h FROM n JOIN h USING (e, ord) LEFT JOIN c ON c.e = n.e WHERE n.k = 1)
SELECT e, ord, 'u' || u AS url FROM a UNION ALL SELECT e, ord, 'u' || u FROM m WHERE have + i <= 8 OR (have >= 8 AND h = 1)""")
def merge_results(table):
    rows = table("orders").select(F.col("o_custkey").alias("e"), F.col("o_orderkey").alias("ord"), F.concat(F.lit("u"), (F.col("o_orderkey") % 7).cast("string")).alias("url"))
    return S.merged_results(rows.filter("ord % 2 = 0"), rows.filter("ord % 2 = 1"), "e", 8).select("e", "ord", "url")


@query(f"""WITH l AS (SELECT site, count(DISTINCT url) AS n FROM (SELECT regexp_replace(regexp_replace(lower({AUTHORITY('url')}), ':[0-9]*$', ''), '^www\\.', '') AS site, link AS url FROM (SELECT url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href="([^"#]+)"', 1)) AS link FROM pages)) GROUP BY 1)
SELECT site, CASE WHEN n >= 8 THEN 'ready' WHEN n % 2 = 0 THEN 'blocked' ELSE 'no_urls' END AS status FROM l""")
def prepare_status(table):
    rows = link_rows(table).groupBy("site").agg(F.count_distinct("url").alias("n"))
    rows = rows.withColumns({"seed": F.lit("https://x/"), "allowed": (F.col("n") >= 8) | (F.col("n") % 2 == 1), "kept": F.when(F.col("n") >= 8, F.col("n")).otherwise(0)})
    return rows.select("site", S.prepared(rows, "site", "seed", "allowed", "kept", "n").alias("status"))


@query("""WITH s AS (SELECT o_orderpriority AS step, CAST(substr(o_orderpriority, 1, 1) AS INT) AS ord, count(*) AS excluded FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL), g AS (SELECT CASE WHEN step IN ('1-URGENT', '2-HIGH') THEN 'checks' ELSE step END AS stage, CAST(sum(excluded) AS BIGINT) AS excluded, min(ord) AS ord FROM s GROUP BY 1)
SELECT stage, excluded, CAST(100000 - sum(excluded) OVER (ORDER BY ord) AS BIGINT) AS leaving, CAST(100000 - sum(excluded) OVER (ORDER BY ord) + excluded AS BIGINT) AS entering FROM g""")
def diagram_stages(table):
    steps = table("orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_orderpriority").alias("step"), F.substring("o_orderpriority", 1, 1).cast("int").alias("ord")).agg(F.count("*").alias("excluded"))
    return S.diagram(steps, {"checks": ["1-URGENT", "2-HIGH"]}, 100_000).select("stage", "excluded", "leaving", "entering")


@query("""SELECT event_id, event_id % 3 = 0 AS belongs, CAST(CASE event_id % 4 WHEN 0 THEN 100 WHEN 1 THEN 0 WHEN 2 THEN 55 ELSE 0 END AS BIGINT) AS score, CASE WHEN event_id % 2 = 0 THEN 'https://x.org' ELSE '' END AS url FROM events""")
def website_answers(table):
    i = F.col("event_id")
    raw = F.concat(F.lit('```json {"belongs": '), F.when(i % 3 == 0, "true").when(i % 3 == 1, '"no"').otherwise("null"), F.lit(', "score": '), F.when(i % 4 == 0, "250").when(i % 4 == 1, "-3").when(i % 4 == 2, '"55.9"').otherwise('"x"'), F.lit(', "url": "'), F.when(i % 2 == 0, "https://x.org").otherwise("none"), F.lit('"} ```'))
    out = S.answer_of(raw)
    return table("events").select("event_id", out["belongs"].alias("belongs"), out["score"].cast("bigint").alias("score"), out["url"].alias("url"))
