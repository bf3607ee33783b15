"""Queries: answers, rules, conclusions, the funnel, errors of services."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import rules as R
from ..operators import screening
from .base import query

ANSWER = """CASE event_id % 6 WHEN 0 THEN 'Sure: {"focus": " Humans ", "score": ' || CAST(event_id % 14 AS VARCHAR) || ', "tags": ["A", " a", "b", ""]} done' WHEN 1 THEN '{"focus": "animals", "score": "x", "tags": []}' WHEN 2 THEN '{"focus": "rocks", "score": 3, "tags": ["c"]}' WHEN 3 THEN 'no json' WHEN 4 THEN '{"focus": "humans", "tags": ["d"]}' ELSE '{"focus": "ANIMALS", "score": -2.5, "tags": ["x", "y", "z", "Z"], "more": 1}' END"""


def answers(table):
    """Events as answers in JSON, some of them wrong."""
    k = F.col("event_id") % 6
    raw = (
        F.when(k == 0, F.concat(F.lit('Sure: {"focus": " Humans ", "score": '), (F.col("event_id") % 14).cast("string"), F.lit(', "tags": ["A", " a", "b", ""]} done')))
        .when(k == 1, '{"focus": "animals", "score": "x", "tags": []}')
        .when(k == 2, '{"focus": "rocks", "score": 3, "tags": ["c"]}')
        .when(k == 3, "no json")
        .when(k == 4, '{"focus": "humans", "tags": ["d"]}')
        .otherwise('{"focus": "ANIMALS", "score": -2.5, "tags": ["x", "y", "z", "Z"], "more": 1}')
    )
    return table("events").select("event_id", "user_id", "value", "event_type", R.extract_object(raw).alias("payload"))


FIELDS = [R.Field("focus", allowed=("humans", "animals"), lowercase=True), R.Field("score", "number", least=0, most=10), R.Field("tags", "strings", items=2)]


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'humans' WHEN 1 THEN 'animals' WHEN 2 THEN 'rocks' WHEN 3 THEN '' WHEN 4 THEN 'humans' ELSE 'animals' END AS focus,
CAST(CASE event_id % 6 WHEN 0 THEN least(10, event_id % 14) WHEN 2 THEN 3 WHEN 5 THEN 0 END AS DOUBLE) AS score, CASE event_id % 6 WHEN 0 THEN 'A|b' WHEN 1 THEN '' WHEN 2 THEN 'c' WHEN 4 THEN 'd' WHEN 5 THEN 'x|y' END AS tags,
CASE event_id % 6 WHEN 1 THEN 'invalid_number:score' WHEN 2 THEN 'invalid_value:focus' WHEN 3 THEN 'no_object' WHEN 4 THEN 'missing_keys:score' WHEN 5 THEN 'extra_keys:more' END AS error FROM events""")
def payload_normalize(table):
    out = R.normalize(F.col("payload"), FIELDS, strict=True)
    return answers(table).select("event_id", out["focus"].alias("focus"), out["score"].alias("score"), F.array_join(out["tags"], "|").alias("tags"), out["error"].alias("error"))


POLICIES = [
    R.Policy(20, "auto_accepted", (R.Rule("kind", "in", ["click", "purchase"]), R.Rule("value", "gte", 20), R.Rule("tags", "len_gte", 1)), reason="wanted"),
    R.Policy(10, "auto_excluded", (R.Rule("kind", "eq", "error"), R.Rule("value", "lte", 60)), reason="an error"),
    R.Policy(30, "needs_review", (R.Rule("value", "gte", 90), R.Rule("tags", "intersects", ["SIGNUP"])), any_of=True, reason="high"),
    R.Policy(5, "never", (), any_of=True, reason="no rule"),
    R.Policy(40, "waiting", (R.Rule("kind", "contains", "ie"), R.Rule("kind", "neq", "x"), R.Rule("kind", "exists"), R.Rule("tags", "len_eq", 2), R.Rule("kind", "not_in", ["y"]), R.Rule("none", "eq", None)), reason="later"),
]


@query("""WITH r AS (SELECT event_id, event_type AS kind, value, CASE WHEN event_id % 3 = 0 THEN [event_type] WHEN event_id % 3 = 1 THEN [event_type, 'b'] ELSE [] END AS tags FROM events)
SELECT event_id, CASE WHEN kind = 'error' AND value <= 60 THEN 'auto_excluded' WHEN kind IN ('click', 'purchase') AND value >= 20 AND len(tags) >= 1 THEN 'auto_accepted' WHEN value >= 90 OR list_contains(tags, 'signup') THEN 'needs_review' WHEN contains(kind, 'ie') AND len(tags) = 2 THEN 'waiting' ELSE 'needs_review' END AS route,
CASE WHEN kind = 'error' AND value <= 60 THEN 'an error' WHEN kind IN ('click', 'purchase') AND value >= 20 AND len(tags) >= 1 THEN 'wanted' WHEN value >= 90 OR list_contains(tags, 'signup') THEN 'high' WHEN contains(kind, 'ie') AND len(tags) = 2 THEN 'later' ELSE 'No policy rule matched; default manual review.' END AS reason FROM r""")
def policy_route(table):
    k = F.col("event_id") % 3
    tags = F.when(k == 0, F.array("event_type")).when(k == 1, F.array(F.col("event_type"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    rows = table("events").select("event_id", F.col("event_type").alias("kind"), "value", tags.alias("tags"))
    route, reason = R.routed(POLICIES, {"kind": (F.col("kind"), "string"), "value": (F.col("value"), "number"), "tags": (F.col("tags"), "strings")})
    return rows.select("event_id", route.alias("route"), reason.alias("reason"))


STATE = """SELECT d.doc_id, d.source, CASE WHEN d.doc_id % 17 = 0 THEN 'OTHER' ELSE '' END AS reason, CASE WHEN d.doc_id % 5 = 0 THEN 'seen' ELSE '' END AS note, quality IS NOT NULL AS eligible,
CASE WHEN quality = 0 THEN 'auto_excluded' WHEN toxic = 1 THEN 'needs_review' WHEN d.doc_id % 13 = 0 THEN '' WHEN d.doc_id % 11 = 0 THEN 'waiting_for_clean_text' ELSE 'auto_accepted' END AS auto,
CASE WHEN toxic = 1 AND d.doc_id % 3 = 0 THEN 'excluded' WHEN toxic = 1 AND d.doc_id % 3 = 1 THEN 'accepted' ELSE '' END AS review, CASE WHEN d.doc_id % 2 = 0 THEN ' not_exist ' ELSE 'nonsense' END AS review_code, CASE WHEN d.doc_id % 4 = 0 THEN 'by hand' ELSE '' END AS review_note FROM documents d LEFT JOIN labels l USING (doc_id)"""


def state(table):
    """Documents as entities under a question, labels as its answers."""
    i, toxic = F.col("doc_id"), F.col("toxic") == 1
    rows = table("documents").join(table("labels"), "doc_id", "left")
    return rows.select(
        "doc_id",
        "source",
        F.when(i % 17 == 0, "OTHER").otherwise("").alias("reason"),
        F.when(i % 5 == 0, "seen").otherwise("").alias("note"),
        F.col("quality").isNotNull().alias("eligible"),
        F.when(F.col("quality") == 0, "auto_excluded").when(toxic, "needs_review").when(i % 13 == 0, "").when(i % 11 == 0, "waiting_for_clean_text").otherwise("auto_accepted").alias("auto"),
        F.when(toxic & (i % 3 == 0), "excluded").when(toxic & (i % 3 == 1), "accepted").otherwise("").alias("review"),
        F.when(i % 2 == 0, " not_exist ").otherwise("nonsense").alias("review_code"),
        F.when(i % 4 == 0, "by hand").otherwise("").alias("review_note"),
    )


SCOPED = f"WITH s AS ({STATE}), a AS (SELECT * FROM s WHERE trim(reason) = '' AND eligible)"


@query(SCOPED + " SELECT count(*) FILTER (WHERE auto = '') AS ask_pending, count(*) FILTER (WHERE auto = 'needs_review' AND review = '') AS review_pending FROM a")
def phase_counts(table):
    return screening.phase_counts(state(table), "auto", "review", "reason", F.col("eligible"), ["ask_pending", "review_pending"])


@query(SCOPED + """ SELECT count(*) AS active_eligible, count(*) FILTER (WHERE auto = '') AS ask_pending, count(*) FILTER (WHERE auto = 'auto_accepted') AS auto_accepted, count(*) FILTER (WHERE auto = 'auto_excluded') AS auto_excluded, count(*) FILTER (WHERE auto = 'needs_review') AS needs_review,
count(*) FILTER (WHERE auto = 'waiting_for_clean_text') AS waiting_for_clean_text, count(*) FILTER (WHERE auto = 'needs_review' AND review = '') AS review_pending, count(*) FILTER (WHERE review = 'accepted') AS review_accepted, count(*) FILTER (WHERE review = 'excluded') AS review_excluded, count(*) FILTER (WHERE auto = 'auto_excluded' OR review = 'excluded') AS concludable_exclusions FROM a""")
def conclude_summary(table):
    return screening.phase_counts(state(table), "auto", "review", "reason", F.col("eligible"))


CONCLUDED = f"""WITH s AS ({STATE}), c AS (SELECT *, reason = '' AND eligible AND review = 'excluded' AS r, reason = '' AND eligible AND auto = 'auto_excluded' AND review <> 'excluded' AS a, CASE WHEN upper(trim(review_code)) IN ({", ".join(f"'{x}'" for x in screening.CODES)}) THEN upper(trim(review_code)) ELSE 'IRRELEVANT_PURPOSE' END AS code FROM s)
SELECT doc_id, source, auto, review, eligible, CASE WHEN r THEN code WHEN a THEN 'IRRELEVANT_PURPOSE' ELSE reason END AS reason, CASE WHEN r THEN concat_ws(' | ', nullif(note, ''), 'classify:q1:review_excluded:' || code, nullif(review_note, '')) WHEN a THEN concat_ws(' | ', nullif(note, ''), 'classify:q1:auto_excluded') ELSE note END AS note FROM c"""


def concluded(table):
    return screening.conclude(state(table), "q1", "auto", "review", "reason", "note", F.col("eligible"), "review_code", "review_note")


@query(f"SELECT doc_id, reason, note FROM ({CONCLUDED})")
def conclude_apply(table):
    return concluded(table).select("doc_id", "reason", "note")


ORDERS = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 19 = 0 THEN 'manual_excluded' WHEN o_orderkey % 7 = 0 THEN 'manual' WHEN o_orderkey % 5 = 0 THEN 'manual_llm' ELSE 'automatic' END AS origin,
CASE o_orderpriority WHEN '1-URGENT' THEN 'brave_auto' WHEN '2-HIGH' THEN 'llm_auto' WHEN '3-MEDIUM' THEN 'manual_review' WHEN '4-NOT SPECIFIED' THEN 'firecrawl_auto' ELSE 'llm_brave_agree' END AS stage, CASE WHEN o_orderkey % 23 = 0 THEN 'https://x.example/' ELSE '' END AS final_url,
CASE WHEN o_orderstatus = 'F' AND o_totalprice > 400000 THEN 'auto_excluded' WHEN o_orderstatus = 'P' THEN 'needs_review' ELSE 'auto_accepted' END AS q1_auto, CASE WHEN o_orderstatus = 'P' AND o_custkey % 3 = 0 THEN 'excluded' WHEN o_orderstatus = 'P' AND o_custkey % 3 = 1 THEN 'accepted' ELSE '' END AS q1_review,
CASE WHEN o_totalprice < 20000 THEN 'auto_excluded' WHEN o_totalprice < 30000 THEN 'waiting_for_clean_text' ELSE 'auto_accepted' END AS q2_auto, '' AS q2_review, o_orderkey % 29 = 0 AS cleanup FROM orders"""
EXCLUDED = f"SELECT *, CASE WHEN origin = 'manual_excluded' THEN 'website_review_exclusion' WHEN q1_auto = 'auto_excluded' OR q1_review = 'excluded' THEN 'q1' WHEN q2_auto = 'auto_excluded' OR q2_review = 'excluded' THEN 'q2' ELSE 'manual_cleanup_or_unattributed' END AS step, origin = 'manual_excluded' OR q1_auto = 'auto_excluded' OR q1_review = 'excluded' OR q2_auto = 'auto_excluded' OR cleanup AS gone FROM ({ORDERS})"
STEPS = ["website_review_exclusion", "q1", "q2", "manual_cleanup_or_unattributed"]


def screened(table):
    """Orders as entities that went through a website review and two questions."""
    k, status, price, p = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    rows = table("orders").select(
        "o_orderkey",
        F.when(k % 19 == 0, "manual_excluded").when(k % 7 == 0, "manual").when(k % 5 == 0, "manual_llm").otherwise("automatic").alias("origin"),
        F.when(p == "1-URGENT", "brave_auto").when(p == "2-HIGH", "llm_auto").when(p == "3-MEDIUM", "manual_review").when(p == "4-NOT SPECIFIED", "firecrawl_auto").otherwise("llm_brave_agree").alias("stage"),
        F.when(k % 23 == 0, "https://x.example/").otherwise("").alias("final_url"),
        F.when((status == "F") & (price > 400000), "auto_excluded").when(status == "P", "needs_review").otherwise("auto_accepted").alias("q1_auto"),
        F.when((status == "P") & (F.col("o_custkey") % 3 == 0), "excluded").when((status == "P") & (F.col("o_custkey") % 3 == 1), "accepted").otherwise("").alias("q1_review"),
        F.when(price < 20000, "auto_excluded").when(price < 30000, "waiting_for_clean_text").otherwise("auto_accepted").alias("q2_auto"),
        F.lit("").alias("q2_review"),
        (k % 29 == 0).alias("cleanup"),
    )
    step = screening.attributed(["q1", "q2"], "origin")
    return rows.withColumns({"step": step, "gone": (step != STEPS[-1]) | F.col("cleanup")})


ORD = "CASE step " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(STEPS)) + " END"
FUNNEL = f"WITH e AS ({EXCLUDED}), c AS (SELECT step, {ORD} AS ord, count(*) AS excluded FROM e WHERE gone GROUP BY 1), f AS (SELECT *, (SELECT count(*) FROM orders) - coalesce(sum(excluded) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS entrance FROM c)"


def funnel_rows(table):
    rows = screened(table)
    order = F.array_position(F.array(*map(F.lit, STEPS)), F.col("step")) - 1
    steps = rows.filter("gone").groupBy("step").agg(F.count("*").alias("excluded")).withColumn("ord", order)
    total = rows.agg(F.count("*").alias("total"))
    # One row and four rows: the cross of totals is bounded by the steps.
    return screening.funnel(steps.join(F.broadcast(total)), F.col("total")).select("step", "ord", "excluded", "entrance", "remaining", "total")


@query(FUNNEL + " SELECT step, excluded, CAST(entrance AS BIGINT) AS entrance, CAST(entrance - excluded AS BIGINT) AS remaining FROM f")
def funnel_steps(table):
    return funnel_rows(table).select("step", "excluded", "entrance", "remaining")


@query(f"SELECT step, stage AS reason, count(*) AS n FROM ({EXCLUDED}) WHERE gone GROUP BY 1, 2")
def funnel_reason_breakdown(table):
    return screened(table).filter("gone").groupBy("step", F.col("stage").alias("reason")).agg(F.count("*").alias("n"))


@query(FUNNEL + f" SELECT sum(excluded) = (SELECT count(*) FROM e WHERE gone) AS all_attributed, bool_and(entrance >= excluded) AS never_negative, min(entrance - excluded) = (SELECT count(*) FROM e WHERE NOT gone) AS ends_active FROM f")
def funnel_invariants(table):
    rows = screened(table).agg(F.count_if("gone").alias("gone"), F.count_if(~F.col("gone")).alias("active"))
    steps = funnel_rows(table).agg(F.sum("excluded").alias("excluded"), F.min("remaining").alias("last"), F.bool_and(F.col("entrance") >= F.col("excluded")).alias("never_negative"))
    # Two tables of one row each.
    return steps.join(F.broadcast(rows)).select((F.col("excluded") == F.col("gone")).alias("all_attributed"), "never_negative", (F.col("last") == F.col("active")).alias("ends_active"))


@query(f"""WITH o AS ({ORDERS}) SELECT 'website' AS step, count(*) AS decisions, count(*) FILTER (WHERE origin = 'automatic' AND final_url = '' AND stage IN ('brave_auto', 'firecrawl_auto')) AS classic_algorithm, count(*) FILTER (WHERE origin = 'manual_llm' OR (origin = 'automatic' AND final_url = '' AND stage IN ('llm_auto', 'llm_brave_agree'))) AS llm,
count(*) FILTER (WHERE origin IN ('manual_excluded', 'manual') OR final_url <> '' OR (origin = 'automatic' AND stage = 'manual_review')) AS manual FROM o
UNION ALL SELECT 'q1', count(*), 0, count(*) FILTER (WHERE q1_auto IN ('auto_excluded', 'auto_accepted')), count(*) - count(*) FILTER (WHERE q1_auto IN ('auto_excluded', 'auto_accepted')) FROM o""")
def decision_methods(table):
    rows = screened(table)
    web, q = screening.website_method("origin", "stage", "final_url"), screening.question_method("q1_auto", "q1_review")
    n = F.count("*").alias("decisions")
    first = rows.agg(n, *[F.count_if(web[k]).alias(k) for k in ("classic_algorithm", "llm", "manual")]).withColumn("step", F.lit("website"))
    # What no method accounts for counts as manual.
    second = rows.agg(n, F.lit(0).cast("bigint").alias("classic_algorithm"), F.count_if(q["llm"]).alias("llm"), (F.count("*") - F.count_if(q["llm"])).alias("manual")).withColumn("step", F.lit("q1"))
    return first.unionByName(second)


@query("""WITH r AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Brave' WHEN 1 THEN 'firecrawl' WHEN 2 THEN 'OpenAI' ELSE 'other' END AS p, CASE CAST(event_id / 3 AS BIGINT) % 5 WHEN 0 THEN 401 WHEN 1 THEN 402 WHEN 2 THEN 429 WHEN 3 THEN 429 ELSE 200 END AS s,
CASE event_type WHEN 'error' THEN 'Too many requests' WHEN 'click' THEN 'Quota exceeded for plan' WHEN 'view' THEN 'rate limit of your plan' ELSE '?' END AS b, CASE event_type WHEN 'signup' THEN 'option_not_in_plan' WHEN 'purchase' THEN 'QUOTA_LIMITED' WHEN 'view' THEN 'invalid_api_key' WHEN 'click' THEN 'insufficient_quota' ELSE '' END AS c, CAST(CAST(event_id / 4 AS BIGINT) % 2 AS VARCHAR) AS left_over FROM events),
m AS (SELECT *, s IN (401, 403) AS denied, lower(b) = 'quota exceeded for plan' AS quota, b = 'Too many requests' AS rate FROM r)
SELECT event_id, CASE p WHEN 'Brave' THEN CASE WHEN denied THEN 'unauthorized_or_forbidden' WHEN s = 429 AND NOT rate THEN CASE WHEN upper(c) = 'QUOTA_LIMITED' AND left_over = '0' THEN 'quota_exhausted' WHEN upper(c) IN ('QUOTA_LIMITED', 'OPTION_NOT_IN_PLAN') THEN 'quota_or_plan_blocked' WHEN quota THEN 'quota_exhausted' ELSE 'unknown_429' END END
WHEN 'firecrawl' THEN CASE WHEN s = 402 THEN 'quota_exhausted' WHEN denied THEN 'unauthorized_or_forbidden' WHEN s = 429 AND NOT rate THEN CASE WHEN quota THEN 'quota_exhausted' ELSE 'unknown_429' END END
WHEN 'OpenAI' THEN CASE WHEN denied THEN 'unauthorized_or_forbidden' WHEN s = 429 AND rate THEN NULL WHEN s = 429 AND (c IN ('insufficient_quota', 'invalid_api_key') OR quota) THEN 'quota_exhausted' WHEN s = 429 THEN 'unknown_429' WHEN c = 'insufficient_quota' THEN 'quota_exhausted' WHEN c = 'invalid_api_key' THEN 'unauthorized_or_forbidden' END
ELSE CASE WHEN denied THEN 'unauthorized_or_forbidden' WHEN s = 429 AND quota THEN 'quota_exhausted' END END AS error FROM m""")
def api_error_classes(table):
    i, kind = F.col("event_id"), F.col("event_type")
    provider = F.when(i % 4 == 0, "Brave").when(i % 4 == 1, "firecrawl").when(i % 4 == 2, "OpenAI").otherwise("other")
    turn = F.round(i / 3).cast("bigint") % 5
    status = F.when(turn == 0, 401).when(turn == 1, 402).when(turn.isin(2, 3), 429).otherwise(200)
    body = F.when(kind == "error", "Too many requests").when(kind == "click", "Quota exceeded for plan").when(kind == "view", "rate limit of your plan").otherwise("?")
    code = F.when(kind == "signup", "option_not_in_plan").when(kind == "purchase", "QUOTA_LIMITED").when(kind == "view", "invalid_api_key").when(kind == "click", "insufficient_quota").otherwise("")
    left = (F.round(i / 4).cast("bigint") % 2).cast("string")
    return table("events").select("event_id", screening.access_error(provider, status, body, code, left).alias("error"))


@query("""SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'view' THEN value END) AS view, max(CASE WHEN event_type = 'error' THEN value END) AS error FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 GROUP BY 1""")
def payload_pivot(table):
    last = table("events").withColumn("r", F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy(F.col("event_id").desc()))).filter("r = 1")
    return last.groupBy("user_id").pivot("event_type", ["click", "view", "error"]).agg(F.max("value"))
