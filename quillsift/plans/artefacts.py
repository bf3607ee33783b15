"""Queries: answers kept as JSON, summaries, probes, attempts, what is to be done again, Markdown."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import content as C
from ..operators import artefacts as A
from .base import query


def markdown_sql(column: str) -> str:
    for pattern, mark in C.MARKDOWN:
        column = "regexp_replace({}, '{}', '{}', 'g')".format(column, *(x.replace("'", "''") for x in (pattern, mark.replace("{1}", "\\1").replace("{2}", "\\2"))))
    return f"regexp_replace({column}, '^\\s+|\\s+$', '', 'g')"


@query(f"SELECT page_id, md5(t) AS digest, length(t) AS n FROM (SELECT page_id, {markdown_sql('html')} AS t FROM pages)")
def page_markdown(table):
    t = C.markdown("html")
    return table("pages").select("page_id", t.alias("t")).select("page_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n"))


@query("""WITH r AS (SELECT user_id, event_type, max(event_id) AS i FROM events GROUP BY ALL), a AS (SELECT user_id, CASE event_type WHEN 'click' THEN 'q01' WHEN 'view' THEN 'q02' END AS q,
CASE i % 4 WHEN 0 THEN '{"kind":"own","n":' || i || '}' WHEN 1 THEN '{"list":["a",' || i || ']}' ELSE '{}' END AS b FROM r WHERE event_type IN ('click', 'view'))
SELECT user_id, max(CASE WHEN q = 'q01' THEN b END) AS q01, max(CASE WHEN q = 'q02' THEN b END) AS q02 FROM a GROUP BY 1""")
def answer_payloads(table):
    last = table("events").groupBy("user_id", "event_type").agg(F.max("event_id").alias("i"))
    n = F.col("i").cast("string")
    own = F.concat(F.lit('{"manual_override": {"normalized": {"n": '), n, F.lit(', "kind": "own", "reason": "x"}}, "normalized": {"kind": "model"}}'))
    model = F.concat(F.lit('{"manual_override": {"normalized": {}}, "normalized": {"score": 3, "list": ["a", '), n, F.lit("]}}"))
    artefact = F.when(F.col("i") % 4 == 0, own).when(F.col("i") % 4 == 1, model).when(F.col("i") % 4 == 2, '{"normalized": [1]}').otherwise('{"normalized": {"kind"')
    question = F.when(F.col("event_type") == "click", "q01_focus").when(F.col("event_type") == "view", "q02_kind").otherwise("other")
    out = A.payloads(last.select("user_id", question.alias("question"), artefact.alias("artefact")), "user_id", "question", "artefact")
    return out.select("user_id", F.col("payloads")["q01"].alias("q01"), F.col("payloads")["q02"].alias("q02"))


@query("""SELECT 'q01' AS question WHERE EXISTS (SELECT 1 FROM documents WHERE doc_id % 7 = 3) UNION ALL SELECT 'q03' WHERE EXISTS (SELECT 1 FROM documents WHERE trim(source) <> '')""")
def progressed_questions(table):
    i = F.col("doc_id")
    rows = table("documents").select(F.when(i % 7 == 3, "auto_accepted").otherwise(" ").alias("a"), F.lit("").alias("b"), F.lit(None).cast("string").alias("c"), "source")
    return A.progressed(rows, {"q01": ("a", "b"), "q02": ("b", "c"), "q03": ("c", "source"), "q04": ("none", "nowhere")})


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'IN_LIQUIDATION' WHEN c_custkey % 3 = 1 THEN '' ELSE '' END AS review_code, CASE WHEN c_custkey % 3 = 0 THEN 'seen ' || c_custkey ELSE '' END AS review_note FROM customer""")
def review_artefacts(table):
    k = F.col("c_custkey")
    files = table("customer").filter("c_custkey % 3 < 2").select("c_custkey", F.when(k % 3 == 0, F.concat(F.lit('{"exclusion_reason": " in_liquidation", "exclusion_reason_note": " seen '), k.cast("string"), F.lit(' "}'))).otherwise("{broken").alias("artefact"))
    return A.with_reviews(table("customer").select("c_custkey"), files, "c_custkey", "artefact")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'OTHER' ELSE '' END AS reason, CASE WHEN c_custkey % 4 = 0 THEN 'closed' ELSE 'n' END AS note, CASE WHEN c_custkey % 4 = 0 THEN 'manual_excluded' END AS origin, CASE WHEN c_custkey % 4 = 0 THEN false ELSE true END AS review FROM customer
UNION ALL SELECT -1, 'OTHER', 'closed', 'manual_excluded', false""")
def excluded_by_hand(table):
    rows = table("customer").select("c_custkey", F.lit("").alias("_excluded_reason"), F.lit("n").alias("_excluded_reason_note"), F.lit(True).alias("_website_needs_review"))
    ids = table("customer").filter("c_custkey % 4 = 0").select("c_custkey").unionByName(table("region").filter("r_regionkey = 0").select(F.lit(-1).cast("bigint").alias("c_custkey")))
    out = A.excluded(rows, ids, "c_custkey", "OTHER", F.lit("2024-01-01"), " closed ")
    return out.select("c_custkey", F.col("_excluded_reason").alias("reason"), F.col("_excluded_reason_note").alias("note"), F.col("_website_origin").alias("origin"), F.col("_website_needs_review").alias("review"))


STEPS = """SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'yes' ELSE 'no' END AS review, CASE WHEN c_custkey % 3 = 0 THEN 'https://x' ELSE ' ' END AS final, CASE WHEN c_custkey % 5 = 0 THEN 'OTHER' ELSE '' END AS reason FROM customer"""


@query(f"""WITH r AS ({STEPS}) SELECT 'pending' AS queue, id FROM r WHERE review = 'yes' AND trim(final) = '' AND reason = '' UNION ALL SELECT 'all_pending', id FROM r WHERE trim(final) = '' AND reason = '' UNION ALL SELECT 'reviewed_too', id FROM r WHERE review = 'yes'""")
def normalisation_queues(table):
    k = F.col("c_custkey")
    rows = table("customer").select(k.alias("id"), F.when(k % 2 == 0, "yes").otherwise("no").alias("review"), F.when(k % 3 == 0, "https://x").otherwise(" ").alias("final"), F.when(k % 5 == 0, "OTHER").otherwise("").alias("reason"))
    parts = [A.normalisation_queue(rows, "review", "final", "reason", **flags).select(F.lit(name).alias("queue"), "id") for name, flags in (("pending", {}), ("all_pending", {"all_rows": True}), ("reviewed_too", {"pending": False}))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0")
def to_prepare_again(table):
    k = F.col("c_custkey")
    done = table("customer").filter("c_custkey % 3 > 0").select(k.cast("string").alias("id"), F.when(k % 5 == 0, "yes").otherwise("no").alias("again"))
    return A.to_prepare(table("customer").select("c_custkey", k.cast("string").alias("id")), done, "id", "again").select("c_custkey")


@query("""WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN 'old' ELSE 's' || c_custkey END AS sig, CASE c_custkey % 5 WHEN 0 THEN ' Pending' WHEN 1 THEN 'deferred' ELSE 'approved' END AS st, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'f' || c_custkey % 50 END AS file FROM customer)
SELECT k, CASE WHEN sig = '' AND k % 7 > 0 THEN 's' || k ELSE sig END AS sig, array_to_string(list_filter([CASE WHEN k % 7 = 0 THEN 'missing_live_row' WHEN sig = 'old' THEN 'signature_mismatch' END, CASE WHEN k % 5 = 0 THEN 'readiness_pending' WHEN k % 5 = 1 THEN 'readiness_deferred' END, CASE WHEN file = '' THEN 'missing_targets_file' WHEN k % 50 % 8 = 0 THEN 'missing_or_empty_targets' END], lambda x: x IS NOT NULL), ',') AS reasons,
k % 7 = 0 OR sig = 'old' OR k % 5 < 2 OR file = '' OR k % 50 % 8 = 0 AS again FROM r""")
def stale_summaries(table):
    k = F.col("c_custkey")
    s = F.concat(F.lit("s"), k.cast("string"))
    rows = table("customer").select(k.alias("k"), F.when(k % 4 == 0, "").when(k % 4 == 1, "old").otherwise(s).alias("sig"), F.when(k % 5 == 0, " Pending").when(k % 5 == 1, "deferred").otherwise("approved").alias("st"), F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("f"), (k % 50).cast("string"))).alias("file"))
    live = table("customer").filter("c_custkey % 7 > 0").select(k.alias("k"), s.alias("now"))
    targets = table("customer").select(F.concat(F.lit("f"), (k % 50).cast("string")).alias("file"), F.when(k % 50 % 8 == 0, 0).otherwise(3).alias("n"))
    out = A.checked(rows, live, targets, "k", "sig", "now", "st", "file", F.lit("2024-01-01"))
    return out.select("k", "sig", F.array_join("stale_reasons", ",").alias("reasons"), F.col("_scrape_requires_reprepare").alias("again"))


@query("""WITH r AS (SELECT l_orderkey AS k, l_linenumber AS o, 'https://h' || l_linenumber || '.org/' AS a, CASE (l_orderkey + l_linenumber) % 4 WHEN 0 THEN 503 WHEN 1 THEN 404 WHEN 2 THEN NULL ELSE 500 END AS st, CASE WHEN l_orderkey % 3 = 0 THEN 'ftp://x' WHEN l_orderkey % 3 = 1 THEN ' ' ELSE 'https://f.org/x' END AS f, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem),
p AS (SELECT *, CASE WHEN trim(f) = '' THEN a ELSE f END AS w FROM r WHERE n = 1), g AS (SELECT *, coalesce(st < 500 AND w LIKE 'http%', false) AS ok FROM p), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY o) AS i FROM g WHERE NOT ok)
SELECT k, (SELECT arg_min(w, o) FROM g WHERE g.k = x.k AND ok) AS seed, CASE WHEN EXISTS (SELECT 1 FROM g WHERE g.k = x.k AND ok) THEN '' ELSE 'seed_unreachable:' || (SELECT string_agg(a || ' (' || CASE WHEN st IS NULL THEN 'Timeout: t' WHEN st >= 500 THEN 'http_' || st ELSE 'invalid_resolved_url' END || ')', '; ' ORDER BY o) FROM b WHERE b.k = x.k AND i <= 3) END AS error FROM (SELECT DISTINCT k FROM p) x""")
def reachable_seeds(table):
    k, o = F.col("l_orderkey"), F.col("l_linenumber")
    rows = table("lineitem").select(k.alias("k"), o.alias("o")).distinct()
    k, o = F.col("k"), F.col("o")
    turn = (k + o) % 4
    rows = rows.withColumns({"a": F.format_string("https://h%d.org/", o), "st": F.when(turn == 0, 503).when(turn == 1, 404).when(turn == 3, 500), "f": F.when(k % 3 == 0, "ftp://x").when(k % 3 == 1, " ").otherwise("https://f.org/x"), "e": F.lit("Timeout: t")})
    return A.reachable(rows, "k", "o", "a", "st", "f", "e")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_custkey % 3 AS kept, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'pending' WHEN c_custkey % 3 = 1 THEN 'pending' ELSE 'not_required' END AS readiness, c_custkey % 3 <> 1 AS allowed, '' AS file FROM customer""")
def prepare_summaries(table):
    k = F.col("c_custkey")
    rows = table("customer").select(k.cast("string").alias("org_id"), F.col("c_name").alias("org_name"), F.when(k % 3 > 0, k % 3).alias("kept"), F.when(k % 3 == 0, "no_urls").when(k % 3 == 1, "blocked").otherwise("ready").alias("prep_status"), F.when(k % 2 == 0, "seed_unreachable").otherwise("ok").alias("robots_fetch"), (k % 3 != 1).alias("allowed"))
    out = A.prepare_summary(rows, F.lit("2024-01-01"))
    return out.select(F.col("_org_id").alias("id"), F.col("_org_name").alias("name"), F.col("_scrape_prepared_url_count").alias("kept"), F.col("_scrape_readiness_status").alias("readiness"), F.col("_scrape_allowed").alias("allowed"), F.col("_scrape_targets_file").alias("file"))


@query("""WITH r AS (SELECT user_id, 'u' || event_id % 5 AS url, event_id, event_type IN ('click', 'view') AS ok, CASE WHEN event_id % 6 = 0 THEN '' ELSE 'x' || event_id % 3 END AS ex, CASE WHEN event_id % 4 > 0 THEN event_id % 4 END AS c FROM events),
l AS (SELECT user_id, arg_max(ex, event_id) AS calibrated FROM r WHERE ok GROUP BY 1)
SELECT r.user_id, url, max(event_id) FILTER (WHERE ok) AS last_success, CAST(coalesce(max(c), 0) AS BIGINT) AS attempts, coalesce(any_value(calibrated), '') AS calibrated FROM r LEFT JOIN l ON r.user_id = l.user_id GROUP BY ALL""")
def page_attempts(table):
    i = F.col("event_id")
    rows = table("events").select("user_id", "event_id", F.concat(F.lit(" u"), (i % 5).cast("string")).alias("url"), F.when(F.col("event_type").isin("click", "view"), " Success").otherwise("failed").alias("st"), F.when(i % 4 > 0, (i % 4).cast("string")).otherwise("x").alias("c"), F.when(i % 6 == 0, "").otherwise(F.concat(F.lit("x"), (i % 3).cast("string"))).alias("by"))
    return A.attempts(rows, "user_id", "url", "event_id", "st", "c", "by")


@query("""SELECT reason, n FROM (SELECT CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag || ' ' || l_linenumber END AS reason, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, reason LIMIT 8) WHERE reason <> ''""")
def top_reasons(table):
    return A.top(table("lineitem").select(F.when(F.col("l_returnflag") == "N", " ").otherwise(F.concat("l_returnflag", F.lit(" "), F.col("l_linenumber").cast("string"))).alias("reason")), "reason")


@query("""SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderkey % 5 > 0) AS current, count(*) FILTER (WHERE o_orderkey % 5 = 1) AS accepted, count(*) FILTER (WHERE o_orderkey % 5 = 2) AS skipped, count(*) FILTER (WHERE o_orderkey % 5 >= 3) AS excluded FROM orders GROUP BY 1""")
def review_progress(table):
    k = F.col("o_orderkey")
    return A.progress(table("orders").withColumn("d", F.when(k % 5 == 0, " ").when(k % 5 == 1, "Accepted").when(k % 5 == 2, "skipped ").otherwise("excluded")), "d", ["o_orderpriority"])
