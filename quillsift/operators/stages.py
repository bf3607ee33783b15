"""Stages of the screening as tables: normalised URLs, work queues, prepared and fetched pages, diagrams. What people or services decide comes in as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import UrlRules
from ..functions import coerce, content
from ..functions import urls as U
from ..functions.text import blank, strip, text
from .rules import extract_object
from .screening import active, confidence, low, valid_code


def normalised(df: DataFrame, url: str, rules: UrlRules, by_reason: DataFrame | None = None, by_segment: DataFrame | None = None) -> DataFrame:
    """What becomes of each website's URL: its basic and scoped form, why, whether it changed, needs review, and how sure that is.

    by_reason (scope_reason, yes, total) and by_segment (segment, yes, total): outcomes of past reviews, few rows.
    """
    out = df.withColumn("__raw", strip(text(url)))
    out = U.with_scope(out, "__raw", rules).withColumnRenamed("seed_url", "normalized_url")
    raw, new = F.col("__raw"), F.col("normalized_url")
    out = out.withColumns({"basic_url": U.normalize(raw), "__depth": U.depth(raw), "__slash": U.slash_only(raw, new), "__segment": F.lower(F.coalesce(F.try_element_at(U.segments(raw), F.lit(1)), F.lit("")))})
    some, valid, moved = raw != "", F.col("basic_url") != "", ~F.col("__slash") & (raw != new)
    path_review = F.col("__depth") > 0
    out = out.withColumns(
        {
            "changed": valid & moved,
            "scope_reason": F.when(~some, "no_website").otherwise(F.col("scope_reason")),
            "review_needed": valid & path_review,
            "unchanged_indicator": F.when(~some, "no_website").when(~valid, "invalid_or_unsupported_url").when(path_review, "path_requires_review").when(moved, "changed").when(F.col("__slash"), "trailing_slash_only").when(F.col("scope_reason") == "root_seed", "already_root_domain").otherwise("unchanged_non_root"),
        }
    )
    none = F.lit(None).cast("bigint")
    stats = {"r": (none, none), "s": (none, none)}
    for key, table, column in (("r", by_reason, "scope_reason"), ("s", by_segment, "segment")):
        if table is not None:
            side = table.select(F.col(column).alias(f"__k{key}"), F.col("yes").alias(f"__y{key}"), F.col("total").alias(f"__t{key}"))
            out = out.join(side, F.col("scope_reason" if key == "r" else "__segment") == F.col(f"__k{key}"), "left").drop(f"__k{key}")
            stats[key] = (F.col(f"__y{key}"), F.col(f"__t{key}"))
    sure = confidence(raw, F.col("scope_reason"), F.col("__segment"), F.col("__depth"), stats["r"], stats["s"], rules.high_segments)
    return out.withColumn("confidence", F.when(F.col("normalized_url") == "", "none").otherwise(sure)).drop("__raw", "__slash", "__segment", "__depth", "__yr", "__tr", "__ys", "__ts")


def finalised(df: DataFrame, raw: str, suggested: str, needs_review: str, reason: str, decision: str, final: str) -> DataFrame:
    """Final URL and decision: none for excluded rows, the suggestion or the original where no review is needed, else what was decided."""
    gone, review = valid_code(reason), coerce.boolean(needs_review)
    r, s, now = strip(text(raw)), strip(text(suggested)), strip(text(decision))
    kept = F.when(~gone & (now == "excluded"), "").otherwise(now)
    auto = F.when(s != "", "auto_resolved").when(r != "", "auto_keep_original").otherwise("")
    return df.withColumns(
        {
            final: F.when(gone, "").when(~F.coalesce(review, F.lit(False)), F.when(s != "", s).otherwise(r)).otherwise(text(final)),
            decision: F.when(gone, F.when(now == "", "excluded").otherwise(now)).when(~F.coalesce(review, F.lit(False)) & (kept == ""), auto).otherwise(kept),
        }
    )


def needs_discovery(confidence_: str, reason: str) -> Column:
    return blank(confidence_) & ~valid_code(reason)


def needs_website_review(url: str, review: str, reason: str) -> Column:
    return (blank(url) | F.coalesce(coerce.boolean(review), F.lit(False))) & ~valid_code(reason)


def needs_registry(status: str, reason: str, refresh: bool = False) -> Column:
    return ~valid_code(reason) & (F.lit(True) if refresh else blank(status))


def unresolved_normalisation(review: str, final: str, reason: str) -> Column:
    return F.coalesce(coerce.boolean(review), F.lit(False)) & blank(final) & ~valid_code(reason)


def critical_readiness(prep: str, robots_fetch: str) -> Column:
    return (low(prep) == "blocked") | ((low(prep) == "no_urls") & (low(robots_fetch) == "seed_unreachable"))


def readiness(df: DataFrame, prep: str, robots_fetch: str, status: str) -> DataFrame:
    """The status where it is blank: pending for critical rows, else not required."""
    return df.withColumn(status, F.when(blank(status), F.when(critical_readiness(prep, robots_fetch), "pending").otherwise("not_required")).otherwise(F.col(status)))


def readiness_queue(latest_: DataFrame, prep: str, robots_fetch: str, status: str) -> DataFrame:
    return latest_.filter(critical_readiness(prep, robots_fetch) & ~low(status).isin("approved", "excluded", "not_required"))


def registry_queue(latest_: DataFrame, status: str, reason: str) -> DataFrame:
    return latest_.filter(~valid_code(reason) & low(status).isin("no_match", "multiple_matches", "search_error"))


def confirm_manual(df: DataFrame, origin: str, urls: list[str], status: str, review: str, why: str) -> DataFrame:
    """URLs that people chose count as confirmed."""
    has = F.lit(False)
    for u in urls:
        has = has | ~blank(u)
    hit = low(origin).isin("manual", "manual_llm") & has & low(status).isin("", "review_required", "url_changed_needs_rescrape")
    return df.withColumn("__hit", hit).withColumns({status: F.when(F.col("__hit"), "confirmed").otherwise(F.col(status)), review: F.when(F.col("__hit"), F.lit(False)).otherwise(F.col(review)), why: F.when(F.col("__hit"), "manual_url_user_confirmed").otherwise(F.col(why))}).drop("__hit")


def mismatch_queue(df: DataFrame, review: str, reason: str) -> DataFrame:
    return df.filter(F.coalesce(F.col(review), F.lit(False)) & ~valid_code(reason))


def verify_pending(df: DataFrame, eligible: DataFrame, key: str, status: str, reason: str, refresh: bool = False) -> DataFrame:
    rows = df.join(eligible.select(key), key, "left_semi").filter(~valid_code(reason))
    return rows if refresh else rows.filter(low(status).isin("", "url_changed_needs_rescrape"))


def eligible(clean: DataFrame, key: str, status: str, usable: str) -> DataFrame:
    """Entities with cleaned text to read."""
    return clean.filter((low(status) == "ok") & (F.coalesce(coerce.whole(usable), F.lit(0)) > 0)).select(key).distinct()


def verify_gate(df: DataFrame, ids: DataFrame, key: str, status: str, reason: str) -> DataFrame:
    """How many rows keep questions from being asked: active, eligible, not confirmed."""
    return df.join(ids.select(key), key, "left_semi").filter(active(reason) & (low(status) != "confirmed")).agg(F.count("*").alias("blocking"))


def waiting(df: DataFrame, ids: DataFrame, key: str, auto: str, reason: str) -> DataFrame:
    """Rows not asked yet wait for cleaned text while they have none, and are asked once they have it."""
    out = df.join(ids.select(key).distinct().withColumn("__has", F.lit(True)), key, "left")
    has, a = F.coalesce("__has", F.lit(False)), low(auto)
    value = F.when(active(reason) & ~has & (a == ""), "waiting_for_clean_text").when(active(reason) & has & (a == "waiting_for_clean_text"), "").otherwise(F.col(auto))
    return out.withColumn(auto, value).drop("__has")


def reset_question(df: DataFrame, ids: DataFrame, key: str, columns: list[str], reason: str) -> DataFrame:
    out = df.join(ids.select(key).distinct().withColumn("__has", F.lit(True)), key, "left")
    hit = active(reason) & F.coalesce("__has", F.lit(False))
    return out.withColumns({c: F.when(hit, "").otherwise(F.col(c)) for c in columns}).drop("__has")


def prepared(df: DataFrame, website: str, seed: str, allowed: str, kept: str, candidates: str) -> Column:
    """The status of an entity's preparation."""
    return F.when(blank(website), "no_website").when(blank(seed), "invalid_url").when(~F.coalesce(F.col(allowed), F.lit(True)), "blocked").when(F.coalesce(F.col(kept), F.lit(0)) > 0, "ready").otherwise("no_urls")


def wants_links(sitemap_urls: Column, latest_mod: Column, stale_before: Column, rankable: Column, keep: int) -> Column:
    """Whether links are followed too: no sitemap, a stale one, or too few pages to rank."""
    return (F.coalesce(sitemap_urls, F.lit(0)) == 0) | latest_mod.isNull() | (latest_mod < stale_before) | (F.coalesce(rankable, F.lit(0)) < keep)


def follow(links: DataFrame, seeds: DataFrame, depth: int = 4, most: int = 2000) -> DataFrame:
    """Pages reached from seeds (entity, url) over links (entity, url, link) in at most `depth` steps, `most` of an entity: a bounded loop of joins."""
    found = seeds.select("entity", "url").distinct().withColumn("step", F.lit(0))
    edge = found
    for k in range(1, depth + 1):
        edge = links.join(edge.select("entity", "url"), ["entity", "url"], "left_semi").select("entity", F.col("link").alias("url")).distinct().join(found, ["entity", "url"], "left_anti").withColumn("step", F.lit(k))
        found = found.unionByName(edge)
    rank = F.row_number().over(Window.partitionBy("entity").orderBy("step", "url"))
    return found.withColumn("__r", rank).filter(F.col("__r") <= most).drop("__r")


def merged_results(base: DataFrame, more: DataFrame, entity: str, most: int) -> DataFrame:
    """Found pages (entity, ord, url), those of the second search after those of the first that lack them. A first list that is full already takes at most the second's first row."""
    first = base.withColumn("__part", F.lit(0))
    rows = first.unionByName(more.withColumn("__part", F.lit(1)))
    new = F.row_number().over(Window.partitionBy(entity, "url").orderBy("__part", "ord"))
    head = F.row_number().over(Window.partitionBy(entity, "__part").orderBy("ord"))
    rows = rows.withColumns({"__n": new, "__h": head}).filter((F.col("__part") == 0) | ((F.col("__n") == 1) & (F.col("url") != "")))
    rank = F.row_number().over(Window.partitionBy(entity).orderBy("__part", "ord"))
    have = F.count_if(F.col("__part") == 0).over(Window.partitionBy(entity))
    rows = rows.withColumns({"rank": rank.cast("bigint"), "__have": have})
    keep = (F.col("__part") == 0) | (F.col("rank") <= most) | ((F.col("__have") >= most) & (F.col("__h") == 1))
    return rows.filter(keep).drop("__part", "__n", "__h", "__have")


def outcome(df: DataFrame, error: Column, message: Column, http: Column, content_type: Column, body: Column, body_score: Column, static_score: Column, static_text: Column, rendered_status: Column, rendered_detail: Column, rendered_score: Column, rendered_text: Column, markers: Column, stub: Column) -> DataFrame:
    """What each fetch came to, as columns status, failure, detail, mode, score, static_score, rendered_score, quality, quality_reason, trigger, content.

    error (timeout, connect, other; null for a response) and its message; body: the text of a response that is no HTML;
    rendered_*: what rendering would give or gave, with its status and why it failed; stub: the page that stands in for one without text.
    A failed request is rendered; a poor static text is rendered, and kept at low quality if that fails.
    """
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    detail = strip(text(rendered_detail))
    refused = F.when(error.isNotNull(), content.failure(error, message)).when(http.isin(401, 403), F.format_string("http_%d", http)).when(http >= 500, "http_5xx").when(http != 200, "http_other")
    why = F.when(error.isNotNull(), strip(text(message))).when(refused == "http_other", F.format_string("http_%d", http)).otherwise("")
    other, reason = other_content(content_type, body)
    rows = df.withColumns(
        {
            "__refused": refused, "__why": F.concat_ws("; ", F.nullif(why, F.lit("")), F.nullif(detail, F.lit(""))), "__html": F.contains(F.lower(text(content_type)), F.lit("text/html")),
            "__other": other, "__reason": reason, "__ok": F.coalesce(rendered_status == "success", F.lit(False)), "__detail": detail, "__s": zero(static_score), "__r": zero(rendered_score), "__b": zero(body_score),
            "__static": strip(text(static_text)), "__rendered": strip(text(rendered_text)), "__stub": stub, "__trigger": content.render_trigger(markers), "__gone": content.no_browser(rendered_detail),
        }
    )
    c = F.col
    rows = rows.withColumn("__case", F.when(c("__refused").isNotNull(), F.when(c("__ok"), "refused_rendered").otherwise("refused")).when(~c("__html"), F.when(c("__other") != "", "other").otherwise("unread")).when(c("__s") >= content.ACCEPTED, "static").when(c("__ok"), F.when(c("__r") > c("__s"), "rendered").otherwise("poor")).when(c("__static") != "", "kept").otherwise("lost"))
    case = lambda values, otherwise=None: F.coalesce(*[F.when(c("__case").isin(*k.split()), v) for k, v in values.items()], F.lit(otherwise))
    fallback = F.concat(F.lit("http_failure_fallback:"), c("__refused"))
    score = case({"refused_rendered rendered": c("__r"), "other": c("__b"), "static poor kept lost": c("__s")}, 0)
    rows = rows.withColumn("score", score)
    base = case({"refused_rendered": fallback, "other": c("__reason"), "rendered poor": F.format_string("low_score_after_render:selected=%d", c("score"))}, "")
    grade, low_reason = content.graded(c("score"), reason=base)
    kept = F.concat(F.format_string("low_score_static:%d;render_", c("__s")), F.when(c("__gone"), "unavailable:").otherwise("failed:"), c("__detail"))
    some = lambda t: F.when(t != "", t).otherwise(c("__stub"))
    out = {
        "status": case({"refused unread lost": F.lit("failed")}, "success"),
        "failure": case({"refused": c("__refused"), "unread": F.lit("non_html_response"), "lost": F.lit("playwright_render_failed")}, ""),
        "detail": case({"refused": c("__why"), "unread": c("__reason"), "lost": c("__detail")}, ""),
        "mode": case({"refused refused_rendered rendered lost": F.lit("playwright")}, "static"),
        "static_score": case({"refused refused_rendered unread": F.lit(0), "other": c("__b")}).cast("int"),
        "rendered_score": case({"refused lost": F.lit(0), "refused_rendered rendered poor": c("__r")}).cast("int"),
        "quality": case({"refused unread lost": F.lit(""), "kept": F.lit("low")}, None),
        "quality_reason": case({"refused unread lost": F.lit(""), "kept": kept}, None),
        "trigger": case({"refused refused_rendered": fallback, "other": c("__reason"), "rendered poor lost": c("__trigger"), "kept": F.concat(c("__trigger"), F.lit(":render_fallback="), c("__detail"))}, ""),
        "content": case({"refused unread": F.lit(""), "refused_rendered rendered": some(c("__rendered")), "other": c("__other"), "poor": some(c("__static"))}, None),
    }
    out["static_score"] = F.coalesce(out["static_score"], c("__s"))
    out["quality"], out["quality_reason"] = F.coalesce(out["quality"], grade), F.coalesce(out["quality_reason"], low_reason)
    out["content"] = F.coalesce(out["content"], c("__static"))
    return rows.withColumns(out).drop(*[n for n in rows.columns if n.startswith("__")])


def entity_outcome(attempted: Column, succeeded: Column, failed: Column, skipped: Column) -> Column:
    return F.when((attempted == 0) & (skipped > 0), "already_success").when(succeeded > 0, F.format_string("success:%d/%d", succeeded, attempted)).otherwise(F.format_string("failed:%d/%d", failed, attempted))


# Types whose bodies are texts as they are.
TEXT_TYPES = ("text/plain", "text/markdown", "text/xml", "application/json", "application/xml", "application/xhtml+xml")


def other_content(content_type: Column, body: Column) -> tuple[Column, Column]:
    """The text of a response that is no HTML, empty if there is none, and the reason that is noted. The body of a PDF is its text."""
    t, own = F.lower(text(content_type)), strip(text(body))
    pdf, like = F.contains(t, F.lit("application/pdf")), t.rlike("|".join(x.replace("+", "[+]") for x in TEXT_TYPES))
    reason = F.when(pdf, F.when(own == "", "pdf_text_extraction_failed").otherwise("non_html:application_pdf")).when(like, F.when(own == "", "text_like_content_empty").otherwise(F.concat(F.lit("non_html:"), F.split_part(t, F.lit(";"), F.lit(1))))).otherwise(F.concat(F.lit("non_html_unsupported:"), F.when(t == "", "unknown").otherwise(t)))
    return F.when(pdf | like, own).otherwise(""), reason


def answer_of(raw: Column | str) -> dict[str, Column]:
    """An answer on a website: whether it belongs to the entity, a score from 0 to 100, and the URL if it is one."""
    o = extract_object(raw)
    get = lambda k: F.get_json_object(o, f"$.{k}")
    url = strip(text(get("url")))
    score = F.least(F.lit(100), F.greatest(F.lit(0), F.coalesce(get("score").try_cast("double").cast("int"), F.lit(0))))
    return {"belongs": low(get("belongs")).isin(*coerce.TRUE), "score": score, "url": F.when(url.rlike("(?i)^https?://"), url).otherwise(""), "note": F.when(url.rlike("(?i)^https?://"), "").otherwise(url)}


def one_column(rows: DataFrame, cells: str, order: str, sample: int = 20) -> DataFrame:
    """Whether the first rows of a table all have two cells at most: the sign of a page without columns."""
    return rows.orderBy(order).limit(sample).agg(F.coalesce(F.max(F.size(cells)) <= 2, F.lit(False)).alias("single"))


def header_row(first_cell: Column | str, names: tuple[str, ...] = ("name", "organisation", "bezeichnung", "nr", "nr.")) -> Column:
    return low(first_cell).isin(*names)


def header_line(line: Column | str, markers: tuple[str, ...]) -> Column:
    out = blank(line)
    for m in markers:
        out = out | F.contains(low(line), F.lit(m))
    return out


def diagram(steps: DataFrame, groups: dict[str, list[str]], total: int) -> DataFrame:
    """The trunk of a flow diagram: stages of summed steps (ord, step, excluded), with what enters and leaves each. Steps are few."""
    stage = F.lit(None).cast("string")
    for name, members in groups.items():
        stage = F.when(F.col("step").isin(*members), name).otherwise(stage)
    rows = steps.withColumn("stage", F.coalesce(stage, "step")).groupBy("stage").agg(F.sum("excluded").alias("excluded"), F.min("ord").alias("ord"))
    after = F.lit(total) - F.sum("excluded").over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("leaving", after).withColumn("entering", F.col("leaving") + F.col("excluded"))
