"""Queries: identifiers, matches, partitions, state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import coerce
from ..functions import text as T
from ..operators import incremental as inc
from ..operators import match, screening
from .base import query

TERMS = ["red", "hot", "widget", "bolt", "rod"]
ALLOWED = ["red", "widget", "bolt"]
WORD = lambda c, t: f"regexp_matches({c}, '(^|[^\\p{{L}}\\p{{N}}_]){t}($|[^\\p{{L}}\\p{{N}}_])')"
FIRST_TERM = "CASE " + " ".join(f"WHEN {WORD('lower(p_name)', t)} THEN '{t}'" for t in TERMS) + " END"
FOLD = lambda c: f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))"
PRINT = f"'org_' || substr(sha1({FOLD('p_name')} || '|' || {FOLD('p_brand')} || '|' || {FOLD('p_type')}), 1, 12)"


@query(f"""SELECT p_partkey, fp || '_' || CAST(occurrence AS VARCHAR) AS entity_id, occurrence FROM
(SELECT p_partkey, {PRINT} AS fp, row_number() OVER (PARTITION BY {PRINT} ORDER BY p_partkey) AS occurrence FROM part)""")
def stable_org_id(table):
    rows = inc.occurrence(table("part").withColumn("fp", T.fingerprint("p_name", "p_brand", "p_type")), ["fp"], "p_partkey")
    return rows.select("p_partkey", F.concat_ws("_", "fp", F.col("occurrence").cast("string")).alias("entity_id"), "occurrence")


@query(f"""WITH r AS (SELECT p_partkey, p_name, {PRINT} AS fp, {FIRST_TERM} AS t FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY p_partkey) AS occurrence FROM r),
d AS (SELECT p_partkey, CASE WHEN p_partkey % 31 = 0 THEN 'include' WHEN p_partkey % 17 = 0 THEN 'exclude' END AS decision FROM part)
SELECT fp || '_' || CAST(occurrence AS VARCHAR) AS entity_id, p_name AS name, occurrence, t AS matched_term, CAST(CASE WHEN t IS NULL THEN 0 ELSE 100 END AS BIGINT) AS confidence,
CASE WHEN (coalesce(t IN ('red','widget','bolt'), false) OR coalesce(decision = 'include', false)) AND NOT coalesce(decision = 'exclude', false) THEN 'matched' ELSE 'excluded' END AS bucket
FROM n JOIN d USING (p_partkey)""")
def org_screening(table):
    part = table("part")
    rows = inc.occurrence(part.withColumn("fp", T.fingerprint("p_name", "p_brand", "p_type")), ["fp"], "p_partkey")
    rows = match.exact(rows.withColumn("name", T.sanitize("p_name")), "name", TERMS)
    decided = part.filter("p_partkey % 31 = 0 or p_partkey % 17 = 0").select("p_partkey", F.when(F.expr("p_partkey % 31 = 0"), "include").otherwise("exclude").alias("decision"))
    out = match.partition(rows.join(decided, "p_partkey", "left"), ALLOWED)
    return out.select(F.concat_ws("_", "fp", F.col("occurrence").cast("string")).alias("entity_id"), "name", "occurrence", "matched_term", F.col("confidence").cast("bigint").alias("confidence"), "bucket")


@query("""SELECT doc_id, trim(regexp_replace(regexp_replace(text, '["''`“”„«»‚‘’]', '', 'g'), '\\s+', ' ', 'g')) AS clean FROM documents""")
def sanitize_text(table):
    return table("documents").select("doc_id", T.sanitize("text").alias("clean"))


@query("""WITH r AS (SELECT doc_id, CAST((quality IS NOT NULL) AS INT) + CAST((toxic IS NOT NULL) AS INT) + CAST(lang <> 'en' AS INT) + CAST(source <> 'src0' AS INT) + 1 AS filled FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, CAST(filled AS BIGINT) AS filled, 'only ' || CAST(filled AS VARCHAR) || ' of 5 fields' AS warning FROM r WHERE filled < 2""")
def parse_warning_rows(table):
    rows = table("documents").join(table("labels"), "doc_id", "left")
    fields = [F.col("quality").isNotNull(), F.col("toxic").isNotNull(), F.col("lang") != "en", F.col("source") != "src0", F.lit(True)]
    filled = sum((F.when(f, 1).otherwise(0) for f in fields), F.lit(0))
    rows = rows.withColumn("filled", filled.cast("bigint")).filter(F.col("filled") < len(fields) // 2)
    return rows.select("doc_id", "filled", F.format_string("only %d of 5 fields", "filled").alias("warning"))


@query(f"SELECT p_partkey, {FIRST_TERM} AS matched_term, CAST(CASE WHEN {FIRST_TERM} IS NULL THEN 0 ELSE 100 END AS BIGINT) AS confidence FROM part")
def term_match_exact(table):
    return match.exact(table("part"), "p_name", TERMS).select("p_partkey", "matched_term", F.col("confidence").cast("bigint").alias("confidence"))


@query()
def fuzzy_term_match(table):
    out = match.fuzzy(table("part"), "p_name", ["red widgets", "hot boltt", "larg ring", "old road"], 80)
    return out.select("p_partkey", "matched_term", F.round("confidence", 6).alias("confidence"), "is_match", "needs_review")


@query("""WITH r AS (SELECT n_name, CASE WHEN c_custkey % 11 = 0 THEN 'include' WHEN c_custkey % 7 = 0 THEN 'exclude' END AS decision FROM customer JOIN nation ON c_nationkey = n_nationkey),
b AS (SELECT CASE WHEN (n_name IN ('NATION_1','NATION_3','NATION_8') OR coalesce(decision = 'include', false)) AND NOT coalesce(decision = 'exclude', false) THEN 'matched' ELSE 'excluded' END AS bucket FROM r)
SELECT bucket, count(*) AS n FROM b GROUP BY bucket""")
def location_partition_counts(table):
    rows = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = match.exact(rows, "n_name", [f"NATION_{k}" for k in range(25)])
    rows = rows.withColumn("decision", F.when(F.expr("c_custkey % 11 = 0"), "include").when(F.expr("c_custkey % 7 = 0"), "exclude"))
    return match.partition(rows, ["NATION_1", "NATION_3", "NATION_8"]).groupBy("bucket").agg(F.count("*").alias("n"))


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def decision_log_latest(table):
    return inc.latest(table("events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("""SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_row_wins(table):
    return inc.earliest(table("events"), ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type")


@query("""SELECT c_custkey, c_mktsegment, n_orders, round(total, 2) AS total FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders GROUP BY 1) USING (c_custkey)""")
def refresh_left_merge(table):
    known = table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return inc.merge_extra(table("customer").select("c_custkey", "c_mktsegment"), known, "c_custkey")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, 'old' AS part FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b AS (SELECT o_orderkey, o_orderstatus, 'new' AS part FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')
SELECT * FROM a UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)""")
def append_new_rows(table):
    orders = table("orders")
    old = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).select("o_orderkey", "o_orderstatus", F.lit("old").alias("part"))
    new = orders.filter(F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp")).select("o_orderkey", "o_orderstatus", F.lit("new").alias("part"))
    return inc.append_new(old, new, "o_orderkey")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus, 'old' AS part FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b AS (SELECT o_orderkey, o_orderstatus, 'new' AS part FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01')
SELECT * FROM b UNION ALL SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""")
def upsert_rows(table):
    orders = table("orders")
    old = orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")).select("o_orderkey", "o_orderstatus", F.lit("old").alias("part"))
    new = orders.filter(F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp")).select("o_orderkey", "o_orderstatus", F.lit("new").alias("part"))
    return inc.upsert(old, new, "o_orderkey")


@query("""SELECT d.doc_id, CASE WHEN d.lang <> 'en' THEN d.lang WHEN l.quality = 1 THEN 'good' WHEN l.quality = 0 THEN 'bad' END AS mark
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def backfill_coalesce(table):
    rows = table("documents").select("doc_id", F.when(F.col("lang") != "en", F.col("lang")).otherwise("").alias("mark"))
    known = table("labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("mark"))
    return inc.backfill(rows, known, "doc_id", ["mark"])


REGISTRY = "SELECT p_partkey, p_name || ' ' || p_brand || ' ' || CAST(p_size AS VARCHAR) AS name, p_type FROM part"
KEY = "trim(regexp_replace(regexp_replace(replace(lower(name), '_', ' '), '[^\\p{L}\\p{N}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH r AS (SELECT *, {KEY} AS k FROM ({REGISTRY})), reg AS (SELECT * FROM r WHERE p_partkey % 3 <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY length(CAST(p_partkey AS VARCHAR)), CAST(p_partkey AS VARCHAR)) AS i, count(*) OVER (PARTITION BY k) AS n FROM reg),
g AS (SELECT k, max(n) AS n, string_agg(CAST(p_partkey AS VARCHAR), '|' ORDER BY i) FILTER (WHERE i <= 8) AS uids, max(p_type) FILTER (WHERE i = 1) AS t FROM o GROUP BY k)
SELECT p_partkey, coalesce(n, 0) AS match_count, coalesce(uids, '') AS match_uids, CASE WHEN n IS NULL THEN 'no_match' WHEN n = 1 THEN 'matched' ELSE 'multiple_matches' END AS match_status,
CASE WHEN n = 1 THEN uids ELSE '' END AS uid, CASE WHEN n = 1 THEN t END AS registry_p_type FROM r LEFT JOIN g USING (k)""")
def exact_unique_match(table):
    rows = table("part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", F.col("p_size").cast("string")).alias("name"), "p_type")
    out = match.registry_match(rows.select("p_partkey", "name"), rows.filter("p_partkey % 3 <> 0"), "p_partkey", "name", "p_partkey", extra=["p_type"])
    return out.select("p_partkey", "match_count", "match_uids", "match_status", "uid", "registry_p_type")


PLACE = lambda k: f"nullif(instr(lower(p_name), '{k}'), 0)"


@query(f"""WITH r AS (SELECT p_partkey, p_type, {PLACE('ring')} AS a, {PLACE('gear')} AS b, {PLACE('red')} AS c FROM part),
g AS (SELECT p_partkey, p_type, CASE WHEN a = least(a, b, c) THEN 'Ring' WHEN b = least(a, b, c) THEN 'Gear' WHEN c = least(a, b, c) THEN 'Colour' ELSE '' END AS guess FROM r)
SELECT p_partkey, guess, CASE WHEN p_type = 'PROMO' THEN p_type ELSE guess END AS form, CASE WHEN p_type = 'PROMO' THEN 'registry' WHEN guess <> '' THEN 'name_keyword' ELSE '' END AS source FROM g""")
def first_keyword_guess(table):
    guess = match.first_keyword(F.col("p_name"), {"ring": "Ring", "gear": "Gear", "red": "Colour"})
    form, source = screening.legal_form(F.when(F.col("p_type") == "PROMO", F.col("p_type")), F.col("guess"))
    return table("part").withColumn("guess", guess).select("p_partkey", "guess", form.alias("form"), source.alias("source"))


@query("""SELECT o_orderkey, o_orderstatus FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|7'), o_orderkey LIMIT 100""")
def hash_sample(table):
    return inc.hash_sample(table("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100, "7")


@query("""WITH c AS (SELECT o_orderkey FROM orders WHERE o_custkey % 50 = 3),
m AS (SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c) ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|x'), o_orderkey LIMIT (SELECT count(*) FROM c))
SELECT o_orderkey, 'covered' AS part FROM c UNION ALL SELECT o_orderkey, 'added' FROM m""")
def extend_subset(table):
    orders = table("orders")
    covered = orders.filter("o_custkey % 50 = 3").select("o_orderkey")
    out = inc.extend_subset(orders.select("o_orderkey", F.when(F.expr("o_custkey % 50 = 3"), "covered").otherwise("added").alias("part")), covered, "o_orderkey", 2 * covered.count(), "x")
    return out


@query("""WITH r AS (SELECT event_id, event_type AS a, regexp_extract(props, '[0-9]+') AS b FROM events),
t AS (SELECT event_id, CASE a WHEN 'click' THEN 'yes' WHEN 'view' THEN ' FALSE ' WHEN 'error' THEN '0' ELSE a END AS flag, CASE WHEN a = 'signup' THEN 'n/a' ELSE ' ' || b || '.0' END AS num FROM r)
SELECT event_id, CASE WHEN lower(trim(flag)) IN ('1','true','yes','y') THEN true WHEN lower(trim(flag)) IN ('0','false','no','n') THEN false END AS flag,
CAST(TRY_CAST(trim(num) AS DOUBLE) AS BIGINT) AS num, '' AS note FROM t""")
def coerce_columns(table):
    a, b = F.col("event_type"), F.regexp_extract("props", "[0-9]+", 0)
    raw = table("events").select("event_id", F.when(a == "click", "yes").when(a == "view", " FALSE ").when(a == "error", "0").otherwise(a).alias("flag"), F.when(a == "signup", "n/a").otherwise(F.concat(F.lit(" "), b, F.lit(".0"))).alias("num"))
    return coerce.ensure(coerce.ensure(coerce.ensure(raw, "boolean", {"flag": None}), "whole", {"num": None}), "text", {"note": ""})


@query("""WITH r AS (SELECT p_partkey, '( ' || CASE p_size % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'A' WHEN 2 THEN 'b' ELSE 'ab' END || ' )*' AS mark FROM part)
SELECT p_partkey, lower(regexp_replace(mark, '[^\\p{L}]', '', 'g')) AS category, lower(regexp_replace(mark, '[^\\p{L}]', '', 'g')) = 'a' AS kept, coalesce(regexp_extract(lower(mark), '(^|[^a-z0-9_])([ab])($|[^a-z0-9_])', 2), '') AS first_mark FROM r""")
def category_filter(table):
    size = F.col("p_size") % 4
    mark = F.concat(F.lit("( "), F.when(size == 0, "a").when(size == 1, "A").when(size == 2, "b").otherwise("ab"), F.lit(" )*"))
    return table("part").select("p_partkey", T.letters(mark).alias("category"), (T.letters(mark) == "a").alias("kept"), T.first_mark(mark).alias("first_mark"))


@query("""WITH s AS (SELECT user_id, CAST(max(event_id) FILTER (WHERE ts < TIMESTAMP '2024-01-05') AS VARCHAR) AS old FROM events GROUP BY 1),
l AS (SELECT user_id, CAST(max(event_id) AS VARCHAR) AS live FROM events WHERE user_id % 9 <> 0 GROUP BY 1),
r AS (SELECT user_id, CASE WHEN live IS NULL THEN 'missing_live_row' WHEN coalesce(old, '') = '' THEN 'blank_signature' WHEN old <> live THEN 'signature_mismatch' END AS stale_reason FROM s LEFT JOIN l USING (user_id))
SELECT user_id, stale_reason FROM r WHERE stale_reason IS NOT NULL""")
def stale_signatures(table):
    events = table("events")
    cut = F.lit("2024-01-05").cast("timestamp")
    old = events.groupBy("user_id").agg(F.max(F.when(F.col("ts") < cut, F.col("event_id"))).cast("string").alias("sig"))
    live = events.filter("user_id % 9 <> 0").groupBy("user_id").agg(F.max("event_id").cast("string").alias("sig"))
    return inc.stale(old, live, "user_id", "sig").select("user_id", "stale_reason")


@query("""WITH a AS (SELECT user_id, max(event_id) FILTER (WHERE ts < TIMESTAMP '2024-01-05') AS p, max(event_id) AS c FROM events GROUP BY 1),
s AS (SELECT user_id, p, c, CASE user_id % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'excluded' ELSE 'pending' END AS st FROM a)
SELECT user_id, CASE WHEN st = 'excluded' OR (st = 'resolved' AND coalesce(p, -1) <> c) THEN 'pending' ELSE st END AS status, CASE WHEN st = 'excluded' OR (st = 'resolved' AND coalesce(p, -1) <> c) THEN 'quality_snapshot_changed' ELSE '' END AS reset_reason FROM s""")
def stale_status_reset(table):
    cut = F.lit("2024-01-05").cast("timestamp")
    rows = table("events").groupBy("user_id").agg(F.max(F.when(F.col("ts") < cut, F.col("event_id"))).alias("previous"), F.max("event_id").alias("signature"))
    kind = F.col("user_id") % 3
    rows = rows.withColumn("status", F.when(kind == 0, "resolved").when(kind == 1, "excluded").otherwise("pending"))
    return inc.reset_stale(rows, "status", "signature", "previous").select("user_id", "status", "reset_reason")


@query("""WITH d AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate > TIMESTAMP '1999-01-01')
SELECT c.c_custkey, d.c_custkey IS NOT NULL AS stale, CASE WHEN d.c_custkey IS NOT NULL AND c_custkey % 2 = 1 THEN 'urgent' WHEN c_custkey % 2 = 0 THEN 'kept' ELSE '' END AS reason FROM customer c LEFT JOIN d USING (c_custkey)""")
def mark_stale(table):
    ids = table("orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") > F.lit("1999-01-01").cast("timestamp"))).select(F.col("o_custkey").alias("c_custkey"))
    rows = table("customer").select("c_custkey", F.lit(False).alias("stale"), F.when(F.expr("c_custkey % 2 = 0"), "kept").otherwise("").alias("reason"))
    return inc.mark(rows, ids, "c_custkey", "stale", "reason", "urgent")


@query("""WITH r AS (SELECT DISTINCT p_brand AS id, CAST(substr(p_brand, 7) AS INT) AS n FROM part), o AS (SELECT id, n AS ord, n % 5 AS fp FROM r WHERE n % 7 <> 0), w AS (SELECT id, CASE WHEN n = 3 THEN 99 ELSE n END AS ord, CASE WHEN n = 4 THEN 77 ELSE n % 5 END AS fp FROM r WHERE n % 11 <> 0)
SELECT id, change FROM (SELECT coalesce(o.id, w.id) AS id, CASE WHEN o.id IS NULL THEN 'added' WHEN w.id IS NULL THEN 'removed' WHEN o.fp <> w.fp THEN 'fingerprint_changed' WHEN o.ord <> w.ord THEN 'reordered' END AS change FROM o FULL OUTER JOIN w ON o.id = w.id) WHERE change IS NOT NULL""")
def registry_lock_diff(table):
    rows = table("part").select(F.col("p_brand").alias("id"), F.substring("p_brand", 7, 9).cast("int").alias("n")).distinct()
    old = rows.filter("n % 7 <> 0").select("id", F.col("n").alias("ord"), (F.col("n") % 5).alias("fingerprint"))
    new = rows.filter("n % 11 <> 0").select("id", F.when(F.col("n") == 3, 99).otherwise(F.col("n")).alias("ord"), F.when(F.col("n") == 4, 77).otherwise(F.col("n") % 5).alias("fingerprint"))
    return screening.lock_diff(old, new)
