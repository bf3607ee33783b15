"""Queries: shown values, signs of fetches, places and forms, queues, questions read from files, gates and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import content as C
from ..functions import text as T
from ..operators import candidates, evidence, incremental, match, rules, screening
from ..operators import stages as S
from ..questions import read_question
from .base import query
from .decisions import STATE, state
from .web import RULES


@query(f"""SELECT o_orderkey, replace(format('{{:,}}', CAST(round_even(o_totalprice, 0) AS BIGINT)), ',', '''') AS price, strftime(CAST(o_orderdate AS TIMESTAMP), '%d.%m.%Y %H:%M') AS day, regexp_extract('q' || o_orderkey || '_x', '^(q\\d+)', 1) AS question,
'https://s.example/?q=' || replace(o_orderpriority, ' ', '+') AS search, printf('%03d-%s-%s.md', CAST(o_orderkey % 1000 AS INT), 'hostexample-' || replace(lower(o_orderpriority), ' ', '-') || 'x' || o_orderkey, substr(sha1('https://Host.example/' || replace(o_orderpriority, ' ', '_') || '/x' || o_orderkey || '?q=1'), 1, 8)) AS filename, CASE WHEN o_orderkey < 1024 THEN o_orderkey || ' B' ELSE printf('%.1f', o_orderkey / 1024.0) || ' KB' END AS size, CASE WHEN o_orderkey = 0 THEN '0 B' ELSE printf('%.1f TB', CAST(o_orderkey AS DOUBLE)) END AS large, len(regexp_extract_all(o_orderpriority || ' x', '\\S+')) AS words,
printf('s%02d_%s', CAST(o_orderkey % 100 AS INT), substr(trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g'), '_'), 1, 24)) AS snippet, trim(regexp_replace(regexp_replace('"' || o_orderpriority || '"!', '["]', '', 'g'), '[^\\w\\s-]', ' ', 'g')) AS searched, trim(regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', ' ', 'g')) AS place FROM orders""")
def shown_values(table):
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    return table("orders").select(
        "o_orderkey",
        T.thousands(F.col("o_totalprice")).alias("price"),
        T.shown_time(F.col("o_orderdate").cast("string")).alias("day"),
        T.question_key(F.concat(F.lit("q"), k.cast("string"), F.lit("_x"))).alias("question"),
        T.search_url(p, "https://s.example/?q=").alias("search"),
        T.page_filename(k % 1000, F.concat(F.lit("https://Host.example/"), F.replace(p, F.lit(" "), F.lit("_")), F.lit("/x"), k.cast("string"), F.lit("?q=1"))).alias("filename"),
        T.byte_size(k, largest="KB").alias("size"),
        T.byte_size(k.cast("double") * float(1 << 40)).alias("large"),  # whole numbers end at key 2 ** 23
        T.count_words(F.concat(p, F.lit(" x"))).cast("bigint").alias("words"),
        T.snippet_id(k % 100, p).alias("snippet"),
        T.sanitize_search(F.concat(F.lit('"'), p, F.lit('"!'))).alias("searched"),
        T.place_key(p).alias("place"),
    )


@query("""WITH r AS (SELECT c_custkey, CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(c_nationkey * 3 - 36 AS DOUBLE) AS lat FROM customer)
SELECT c_custkey, round((lon + 180) / 360 * 1024, 6) AS x, round((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 1024, 6) AS y FROM r""")
def map_tiles(table):
    x, y = T.tile((F.col("c_custkey") % 360 - 180).cast("double"), (F.col("c_nationkey") * 3 - 36).cast("double"), 10)
    return table("customer").select("c_custkey", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("""WITH r AS (SELECT event_id, event_type, CASE event_type WHEN 'error' THEN 'timeout' WHEN 'click' THEN 'connect' ELSE 'other' END AS kind, CASE event_id % 3 WHEN 0 THEN 'SSL: bad certificate' WHEN 1 THEN 'Executable doesn''t exist at /x' ELSE 'refused' END AS message,
CASE event_id % 5 WHEN 0 THEN '001-start.md' WHEN 1 THEN '007-Kontakt.md' WHEN 2 THEN '012-news.md' ELSE '020-x.md' END AS page FROM events)
SELECT event_id, CASE kind WHEN 'timeout' THEN 'network_timeout' WHEN 'connect' THEN CASE WHEN event_id % 3 = 0 THEN 'tls_error' ELSE 'network_dns_failure' END ELSE 'unexpected_exception' END AS failure, event_id % 3 = 1 AS no_browser,
CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 3 ELSE 2 END AS tier, CASE WHEN event_type = 'view' THEN 'poor_static_extraction:markers=a,b' ELSE 'poor_static_extraction' END AS trigger,
'# Low-content page' || chr(10) || '- URL: u' || chr(10) || '- Content-Type: text/html' || CASE WHEN event_type <> 'view' THEN chr(10) || '- Title: ' || event_type ELSE '' END || CASE WHEN event_id % 2 = 0 THEN chr(10) || '- Description: d' ELSE '' END || chr(10) || '- Language: de' AS stub,
CASE WHEN event_id % 4 <= 1 OR event_id % 8 = 6 THEN 'body' ELSE '' END AS other, CASE event_id % 4 WHEN 0 THEN 'non_html:text/plain' WHEN 1 THEN 'non_html:application/json' WHEN 3 THEN 'non_html_unsupported:unknown' ELSE CASE WHEN event_id % 8 = 2 THEN 'non_html_unsupported:image/png' ELSE 'non_html:application_pdf' END END AS reason FROM r""")
def fetch_signs(table):
    i, kind = F.col("event_id"), F.col("event_type")
    error = F.when(kind == "error", "timeout").when(kind == "click", "connect").otherwise("other")
    message = F.when(i % 3 == 0, "SSL: bad certificate").when(i % 3 == 1, "Executable doesn't exist at /x").otherwise("refused")
    page = F.when(i % 5 == 0, "001-start.md").when(i % 5 == 1, "007-Kontakt.md").when(i % 5 == 2, "012-news.md").otherwise("020-x.md")
    marks = F.when(kind == "view", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    media = F.when(i % 4 == 0, "text/plain; charset=utf-8").when(i % 4 == 1, "application/json").when(i % 8 == 2, "image/png").when(i % 8 == 6, "application/pdf").otherwise("")
    other, reason = S.other_content(media, F.lit(" body "))
    return table("events").select(
        "event_id",
        C.failure(error, message).alias("failure"),
        C.no_browser(message).alias("no_browser"),
        C.page_tier(page).alias("tier"),
        C.render_trigger(marks).alias("trigger"),
        C.minimal(F.when(kind != "view", kind), F.when(i % 2 == 0, " d "), F.lit(None), F.lit("de"), F.lit("u"), F.lit("text/html"), F.lit("")).alias("stub"),
        other.alias("other"),
        reason.alias("reason"),
    )


@query("""WITH r AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN ' france ' WHEN 1 THEN 'Frankreich' WHEN 2 THEN 'South of France' WHEN 3 THEN 'Deutschland (West)' WHEN 4 THEN '' ELSE 'Nowhere' END AS t FROM customer)
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'FRANCE' WHEN 1 THEN 'FRANCE' WHEN 2 THEN 'FRANCE' WHEN 3 THEN 'GERMANY' END AS place, CASE c_custkey % 4 WHEN 0 THEN 'Verein' WHEN 1 THEN 'Aktiengesellschaft' WHEN 2 THEN 'Besondere Rechtsform' END AS form,
c_custkey % 5 = 0 OR c_custkey % 7 = 0 OR c_custkey % 5 < 2 OR c_custkey % 20 < 8 AS second FROM r""")
def places_and_forms(table):
    k = F.col("c_custkey")
    place = F.when(k % 6 == 0, " france ").when(k % 6 == 1, "Frankreich").when(k % 6 == 2, "South of France").when(k % 6 == 3, "Deutschland (West)").when(k % 6 == 4, "").otherwise("Nowhere")
    uid = F.when(k % 4 == 0, "0109").when(k % 4 == 1, "0106").when(k % 4 == 2, "0113").otherwise("9999")
    score, domain = F.when(k % 5 > 0, F.when(k % 5 < 2, 20).otherwise(30)), F.when(k % 7 == 0, "www.example.org").otherwise("own.ch")
    names = ["FRANCE", "GERMANY"]
    return table("customer").select(
        "c_custkey",
        match.resolve_place(place, names, {"frankreich": "FRANCE", "deutschland": "GERMANY"}).alias("place"),
        match.legal_form_name(uid).alias("form"),
        candidates.wants_second_search(score, k % 20, domain, RULES).alias("second"),
    )


@query("""WITH r AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'blocked' WHEN 1 THEN 'no_urls' ELSE 'ready' END AS prep, CASE doc_id % 2 WHEN 0 THEN 'seed_unreachable' ELSE 'ok' END AS rob, CASE doc_id % 7 WHEN 0 THEN 'approved' WHEN 1 THEN ' Deferred' ELSE 'pending' END AS st, CASE WHEN doc_id % 9 = 0 THEN 'other' ELSE '' END AS reason, CASE doc_id % 5 WHEN 1 THEN 'no_match' WHEN 2 THEN 'search_error' ELSE 'matched' END AS reg FROM documents)
SELECT 'readiness' AS queue, doc_id FROM r WHERE (prep = 'blocked' OR (prep = 'no_urls' AND rob = 'seed_unreachable')) AND st <> 'approved' UNION ALL SELECT 'registry', doc_id FROM r WHERE reason = '' AND reg <> 'matched'
UNION ALL SELECT 'links', doc_id FROM r WHERE doc_id % 4 = 0 OR doc_id % 3 = 0 OR doc_id % 100 < 30""")
def work_queues(table):
    i = F.col("doc_id")
    rows = table("documents").select(
        "doc_id",
        F.when(i % 3 == 0, "blocked").when(i % 3 == 1, "no_urls").otherwise("ready").alias("prep"),
        F.when(i % 2 == 0, "seed_unreachable").otherwise("ok").alias("rob"),
        F.when(i % 7 == 0, "approved").when(i % 7 == 1, " Deferred").otherwise("pending").alias("st"),
        F.when(i % 9 == 0, "other").otherwise("").alias("reason"),
        F.when(i % 5 == 1, "no_match").when(i % 5 == 2, "search_error").otherwise("matched").alias("reg"),
    )
    day = lambda d: F.lit(d).cast("timestamp")
    links = rows.filter(S.wants_links(F.when(i % 4 > 0, 3), F.when(i % 3 == 0, day("2020-01-01")).otherwise(day("2024-01-01")), day("2023-01-01"), i % 100, 30))
    named = lambda df, name: df.select(F.lit(name).alias("queue"), "doc_id")
    return named(S.readiness_queue(rows, "prep", "rob", "st"), "readiness").unionByName(named(S.registry_queue(rows, "reg", "reason"), "registry")).unionByName(named(links, "links"))


FILE = b"""
[prompt]
template = "Text: {text}"
[prompt.placeholders]
text = "the text"
[prompt.response]
required_keys = ["kind", "value"]
[classify]
id = "q09_kind"
order = 9
[classify.output]
strict_output_keys = true
fields = [
  { key = "kind", kind = "string", required = true, lowercase = true, allowed = ["click", "view", "error", "signup", "purchase"] },
  { key = "value", kind = "number", required = true, min = 0, max = 80 },
]
[[classify.policy.rules]]
id = "low"
action = "auto_exclude"
priority = 20
conditions = [{ field = "value", op = "lte", value = 20 }]
[[classify.policy.rules]]
action = "auto_accept"
priority = 10
mode = "any"
review_reason = "People did something."
conditions = [{ field = "kind", op = "eq", value = "click" }, { field = "kind", op = "in", value = ["purchase"] }]
"""


@query("""WITH r AS (SELECT event_id, event_type AS kind, CAST(least(80, value) AS DOUBLE) AS value, event_id % 11 = 0 AS bad FROM events)
SELECT event_id, CASE WHEN bad THEN 'extra_keys:more' END AS error, value, CASE WHEN kind IN ('click', 'purchase') THEN 'auto_accepted' WHEN value <= 20 THEN 'auto_excluded' ELSE 'needs_review' END AS route,
CASE WHEN kind IN ('click', 'purchase') THEN 'People did something.' WHEN value <= 20 THEN 'Matched policy rule low.' ELSE 'No policy rule matched; default manual review.' END AS reason FROM r""")
def question_from_file(table):
    q = read_question(FILE, "q09")
    answer = F.to_json(F.struct(F.upper("event_type").alias("kind"), "value"))
    answer = F.when(F.col("event_id") % 11 == 0, F.replace(answer, F.lit('{"kind'), F.lit('{"more":1,"kind'))).otherwise(answer)
    rows = table("events").select("event_id", answer.alias("payload"))
    out = q.normalized(F.col("payload"))
    rows = rows.select("event_id", *[c.alias(k) for k, c in out.items()])
    route, reason = q.routed({f.key: F.col(f.key) for f in q.fields})
    return rows.select("event_id", "error", "value", route.alias("route"), reason.alias("reason"))


COUNTS = f"""WITH s AS ({STATE}), a AS (SELECT * FROM s WHERE trim(reason) = '' AND eligible), c AS (SELECT source, row_number() OVER (ORDER BY source) AS ord, count(*) FILTER (WHERE auto = '') AS ask, count(*) FILTER (WHERE auto = 'needs_review' AND review = '') AS rev, count(*) FILTER (WHERE auto = 'auto_excluded' OR review = 'excluded') AS con, count(*) FILTER (WHERE review = 'excluded') AS rx,
count(*) FILTER (WHERE auto IN ('auto_accepted', 'auto_excluded') OR review IN ('accepted', 'excluded')) AS seen FROM a GROUP BY 1)"""


def question_counts(table):
    """Sources of documents as questions: their counts."""
    found = screening.masks("auto", "review", "reason", F.col("eligible"))
    rows = state(table).groupBy("source").agg(*[F.count_if(c).alias(k) for k, c in found.items()])
    return rows.filter("active_eligible > 0")


@query(COUNTS + " SELECT source, ask = 0 AND rev = 0 AS ready, ask AS blocked_ask_pending, CASE WHEN ask = 0 THEN rev ELSE 0 END AS blocked_review_pending, CASE WHEN ask = 0 AND rev = 0 THEN con ELSE 0 END AS applied_total, CASE WHEN ask = 0 AND rev = 0 THEN con - rx ELSE 0 END AS applied_auto_excluded FROM c")
def conclude_gate(table):
    return screening.gate(question_counts(table)).select("source", "ready", "blocked_ask_pending", "blocked_review_pending", "applied_total", "applied_auto_excluded")


@query(COUNTS + """ SELECT * FROM (SELECT 'auto' AS asked, source, CASE WHEN ask > 0 THEN 'ask' WHEN rev > 0 THEN 'review' ELSE 'conclude' END AS phase FROM c WHERE ask > 0 OR rev > 0 OR seen > 0 ORDER BY (ask = 0 AND rev = 0), CASE WHEN ask = 0 AND rev = 0 THEN -ord ELSE ord END LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'review', source, 'review' FROM c WHERE rev > 0 ORDER BY ord LIMIT 1) UNION ALL SELECT * FROM (SELECT 'conclude', source, 'conclude' FROM c WHERE con > 0 OR seen > 0 OR rev > 0 OR ask > 0 ORDER BY ord DESC LIMIT 1)""")
def phase_selection(table):
    counts = question_counts(table)
    first = counts.agg(F.array_sort(F.collect_set("source")).alias("all"))  # a row for each source
    counts = counts.join(F.broadcast(first)).withColumn("ord", F.array_position("all", F.col("source"))).drop("all")
    parts = [screening.next_phase(counts, "source", "ord", p).select(F.lit(p).alias("asked"), "source", "phase") for p in ("auto", "review", "conclude")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""WITH l AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events), p AS (SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS c, max(CASE WHEN event_type = 'view' THEN value END) AS v FROM l WHERE r = 1 GROUP BY 1)
SELECT user_id, '- name: u' || user_id || chr(10) || '- ort: -' || chr(10) || '- focus: ' || CASE WHEN c IS NULL THEN '-' WHEN c > 30 THEN 'humans' ELSE '-' END || chr(10) || '- labels: ' || CASE WHEN v IS NULL THEN '-' ELSE 'a, b' END AS facts FROM p""")
def compact_facts(table):
    last = incremental.latest(table("events"), ["user_id", "event_type"], "event_id")
    focus = F.when(F.col("value") > 30, '{"focus": " humans "}').otherwise('{"focus": ""}')
    answers = last.select("user_id", F.when(F.col("event_type") == "click", "q01").when(F.col("event_type") == "view", "q02").otherwise("q09").alias("question"), F.when(F.col("event_type") == "click", focus).otherwise('{"labels": [" a", "", "b "]}').alias("payload"))
    users = last.select("user_id").distinct().withColumns({"name": F.concat(F.lit("u"), F.col("user_id").cast("string")), "ort": F.lit(" ")})
    out = evidence.compact_facts(users, answers, "user_id", {"name": "name", "ort": "ort"}, (("focus", "q01", "focus"), ("labels", "q02", "labels")))
    return out.select("user_id", "facts")


@query("SELECT conv_id, md5(string_agg('- snippet_id: s' || turn || chr(10) || '  text: ' || role, chr(10) || chr(10) ORDER BY turn)) AS evidence FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY 1")
def rendered_evidence(table):
    rows = table("conversations").select("conv_id", "turn", "role").distinct()
    out = evidence.rendered(rows.withColumns({"id": F.concat(F.lit("s"), F.col("turn").cast("string")), "t": F.concat(F.lit(" "), "role", F.lit(" "))}), "conv_id", "turn", "id", "t")
    return out.select("conv_id", F.md5("evidence").alias("evidence"))


@query("""SELECT c_custkey, '' AS status, CAST(CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE 0 END AS BIGINT) AS n, CASE WHEN c_custkey % 2 = 0 THEN true END AS belongs, false AS again, CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'maybe' END AS pay, CASE WHEN c_custkey % 5 = 0 THEN 'manual_override' WHEN c_custkey % 5 = 1 THEN 'normalized' ELSE '' END AS source,
CASE WHEN c_custkey % 7 = 0 AND c_custkey % 2 = 0 THEN '' ELSE 'x' END AS answer FROM customer""")
def state_columns(table):
    k = F.col("c_custkey")
    rows = table("customer").select("c_custkey", F.when(k % 3 == 0, "4.0").otherwise("x").alias("_zefix_match_count"), F.when(k % 2 == 0, "yes").otherwise("maybe").alias("_discover_verify_llm_belongs"), F.lit("x").alias("answer"), F.lit("").alias("reason"))
    for step in screening.STATE:
        rows = screening.initialised(rows, step)
    rows = S.reset_question(rows, table("customer").filter("c_custkey % 14 = 0"), "c_custkey", ["answer"], "reason")
    payload, source = rules.effective(F.when(k % 5 == 0, "o"), F.when(k % 5 < 2, "n"))
    return rows.select("c_custkey", F.col("_scrape_readiness_status").alias("status"), F.col("_zefix_match_count").alias("n"), F.col("_discover_verify_llm_belongs").alias("belongs"), F.col("_scrape_requires_reprepare").alias("again"), F.when(k % 2 == 0, "yes").otherwise("maybe").alias("pay"), F.when(payload.isNull(), "").otherwise(source).alias("source"), "answer")
