"""Decisions on an entity: exclusion codes, phases and conclusions of questions, the funnel of exclusions, checks of scraped pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import ensure
from ..functions.text import ascii_key, blank, name_variants, parts, strip, text
from ..functions.urls import bare_host

# The codes of an exclusion.
CODES = ("NO_INFORMATION", "IN_LIQUIDATION", "NOT_EXIST", "IRRELEVANT_PURPOSE", "OTHER")


def valid_code(c: Column | str, codes: tuple[str, ...] = CODES) -> Column:
    return F.upper(strip(text(c))).isin(*codes)


def active(c: Column | str) -> Column:
    """For questions, funnel and packets any reason excludes, valid or not."""
    return blank(c)


def low(c: Column | str) -> Column:
    return F.lower(strip(text(c)))


def masks(auto: str, review: str, reason: str, eligible: Column) -> dict[str, Column]:
    """Conditions on a question's rows."""
    scoped, a, r = active(reason) & F.coalesce(eligible, F.lit(False)), low(auto), low(review)
    return {
        "active_eligible": scoped,
        "ask_pending": scoped & (a == ""),
        "auto_accepted": scoped & (a == "auto_accepted"),
        "auto_excluded": scoped & (a == "auto_excluded"),
        "needs_review": scoped & (a == "needs_review"),
        "waiting_for_clean_text": scoped & (a == "waiting_for_clean_text"),
        "review_pending": scoped & (a == "needs_review") & (r == ""),
        "review_accepted": scoped & (r == "accepted"),
        "review_excluded": scoped & (r == "excluded"),
        "concludable_exclusions": scoped & ((a == "auto_excluded") | (r == "excluded")),
    }


def phase_counts(df: DataFrame, auto: str, review: str, reason: str, eligible: Column, names: list[str] | None = None) -> DataFrame:
    found = masks(auto, review, reason, eligible)
    return df.agg(*[F.count_if(found[n]).alias(n) for n in names or found])


def conclude(df: DataFrame, question: str, auto: str, review: str, reason: str, note: str, eligible: Column, review_code: str, review_note: str, fallback: str = "IRRELEVANT_PURPOSE") -> DataFrame:
    """Reason and note of the rows that a question excludes: by itself, or by a reviewer, who may name a code."""
    m = masks(auto, review, reason, eligible)
    by_review, by_auto = m["review_excluded"], m["auto_excluded"] & ~m["review_excluded"]
    code = F.when(valid_code(review_code), F.upper(strip(text(review_code)))).otherwise(fallback)
    own, extra = F.nullif(strip(text(note)), F.lit("")), F.nullif(strip(text(review_note)), F.lit(""))
    mark = lambda *x: F.concat_ws(" | ", own, *x)
    return df.withColumns(
        {
            reason: F.when(by_review, code).when(by_auto, fallback).otherwise(F.col(reason)),
            note: F.when(by_review, mark(F.concat(F.lit(f"classify:{question}:review_excluded:"), code), extra)).when(by_auto, mark(F.lit(f"classify:{question}:auto_excluded"))).otherwise(F.col(note)),
        }
    )


def attributed(questions: list[str], origin: str, auto: str = "{}_auto", review: str = "{}_review") -> Column:
    """The step that excluded a row: the website's review, the first question that did, or none of these."""
    out = F.lit("manual_cleanup_or_unattributed")
    for q in reversed(questions):
        out = F.when((strip(text(auto.format(q))) == "auto_excluded") | (strip(text(review.format(q))) == "excluded"), q).otherwise(out)
    return F.when(low(origin) == "manual_excluded", "website_review_exclusion").otherwise(out)


def funnel(steps: DataFrame, total: int | Column, order: str = "ord") -> DataFrame:
    """Entrance and rest of each step (ord, step, excluded): what earlier steps left. Steps are few."""
    before = F.coalesce(F.sum("excluded").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = total if isinstance(total, Column) else F.lit(total)
    return steps.withColumn("entrance", (start - before).cast("bigint")).withColumn("remaining", F.col("entrance") - F.col("excluded"))


def website_method(origin: str, stage: str, final_url: str) -> dict[str, Column]:
    o, s, url = low(origin), strip(text(stage)), ~blank(final_url)
    auto = o == "automatic"
    return {
        "manual": o.isin("manual_excluded", "manual") | url | (auto & (s == "manual_review")),
        "llm": (o == "manual_llm") | (auto & ~url & s.isin("llm_brave_agree", "llm_auto", "firecrawl_agree")),
        "classic_algorithm": auto & ~url & s.isin("brave_auto", "firecrawl_auto"),
    }


def question_method(auto: str, review: str) -> dict[str, Column]:
    a, r = strip(text(auto)), strip(text(review))
    return {"llm": a.isin("auto_excluded", "auto_accepted"), "manual_review": (a == "needs_review") & r.isin("excluded", "accepted"), "pending": a == "waiting_for_clean_text"}


def scrape_quality(latest: DataFrame, entity: str, status: str, detail: str, quality: str) -> DataFrame:
    """Entities by their latest attempts: flagged without a success, or if every success is of low quality."""
    success = (low(status) == "success") | ((low(status) == "skipped") & (low(detail) == "already_success"))
    out = latest.groupBy(entity).agg(F.count("*").alias("total_count"), F.count_if(success).alias("success_count"), F.count_if(success & (low(quality) == "low")).alias("low_count"))
    reason = F.when(F.col("success_count") == 0, "no_success_pages").when(F.col("low_count") >= F.col("success_count"), "all_success_low_quality").otherwise("")
    return out.withColumn("reason", reason).withColumn("flagged", F.col("reason") != "").withColumn("low_count", F.when(F.col("success_count") == 0, F.lit(0).cast("bigint")).otherwise(F.col("low_count")))


def padded(content: Column | str) -> Column:
    """The content's key between blanks: a column that named() and placed() look words up in."""
    return F.concat(F.lit(" "), ascii_key(content), F.lit(" "))


def has_words(key: Column, words: Column) -> Column:
    return F.contains(key, F.concat(F.lit(" "), words, F.lit(" ")))


def named(name: Column | str, key: Column) -> dict[str, Column]:
    """Whether the content, padded(), has the entity's name: as it is, or all its longer words."""
    variants = name_variants(name)
    exact = F.exists(variants, lambda v: (F.length(v) >= 4) & has_words(key, v))
    tokens = F.exists(variants, lambda v: (F.size(parts(v, 4)) >= 2) & F.forall(parts(v, 4), lambda t: has_words(key, t)))
    return {"name_exact": exact, "name_tokens": tokens}


def placed(location: Column | str, key: Column) -> Column:
    target = ascii_key(location)
    return (target != "") & has_words(key, target)


def domain_hint(name: Column | str, url: Column) -> Column:
    return F.exists(parts(ascii_key(name), 4), lambda t: F.contains(bare_host(url), t))


def rule_score(exact: Column, tokens: Column, location: Column, hint: Column) -> Column:
    return F.least(F.lit(100), F.when(exact, 65).when(tokens, 40).otherwise(0) + F.when(location, 25).otherwise(0) + F.when(hint, 10).otherwise(0))


def verify(exact: Column, location: Column, score: Column, belongs: Column, answer_score: Column, least: int = 25, accept: int = 80, medium: int = 50) -> dict[str, Column]:
    """Status and confidence of a website: by rules, else by an answer on it, else to be reviewed."""
    sure = exact & location
    asked = ~sure & (score >= least) & belongs.isNotNull()
    llm = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(answer_score, F.lit(0))))
    yes = asked & belongs & (llm >= accept)
    return {
        "status": F.when(sure | yes, "confirmed").otherwise("review_required"),
        "confidence": F.when(sure | yes, "high").when(asked, F.when(llm >= medium, "medium").otherwise("low")).when(score >= 40, "medium").otherwise("low"),
        "score": F.when(asked, F.greatest(score, llm)).otherwise(score),
        "stage": F.when(sure, "rules_auto_confirm").when(yes, "llm_auto_confirm").when(asked, "llm_review").otherwise("rules_review"),
    }


def legal_form(registry: Column, guess: Column) -> tuple[Column, Column]:
    """The registry's form, else the guess, and its source."""
    r = strip(text(registry))
    return F.when(r != "", r).otherwise(guess), F.when(r != "", "registry").when(guess != "", "name_keyword").otherwise("")


def confidence(raw: Column, scope_reason: Column, segment: Column, depth: Column, by_reason: tuple[Column, Column], by_segment: tuple[Column, Column], high: tuple[str, ...]) -> Column:
    """How surely a URL's normal form is right: by its scope's reason, its first segment, and past reviews (yes, total) of both."""
    rank = {"low": 1, "medium": 2, "high": 3}
    now = F.when(scope_reason.startswith("scaffold_promoted_to_host_root") | scope_reason.startswith("promoted_to_host_root"), rank["high"]).when(scope_reason == "kept_path_prefix", rank["low"]).otherwise(rank["medium"])
    now = F.when(segment.isin(*high) & (now < 3), 3).otherwise(now)
    for (yes, total), some in ((by_reason, F.lit(True)), (by_segment, segment != "")):
        share, enough = F.try_divide(yes.cast("double"), total.cast("double")), some & (F.coalesce(total, F.lit(0)) >= 3)
        now = F.when(enough & (share >= F.lit(0.9)) & (now < 3), 3).when(enough & (share <= F.lit(0.2)), 1).otherwise(now)
    return F.when(depth == 0, "very_high").when(now == 3, "high").when(now == 2, "medium").otherwise("low")


# What services write when a quota is used up, a rate is exceeded, or a plan forbids a call.
QUOTA = ("insufficient_quota", "out of credits", "credit balance", "exceeded your current quota", "quota exceeded", "usage limit reached", "billing hard limit")
RATE = ("rate limit", "too many requests", "requests per minute", "requests per day", "rate_limited", "rate_limit_exceeded")
BILLING = ("quota", "credit", "billing", "payment", "subscription", "plan", "insufficient_quota")
SPENT_CODES, BARRED_CODES = ("insufficient_quota", "billing_hard_limit_reached"), ("account_deactivated", "access_terminated", "permission_denied", "invalid_api_key")
PLAN_CODES = ("QUOTA_LIMITED", "SUBSCRIPTION_TOKEN_INVALID", "SUBSCRIPTION_NOT_FOUND", "RESOURCE_NOT_ALLOWED", "OPTION_NOT_IN_PLAN")


def mentions(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(F.lower(text(c)), F.lit(w))
    return out


def access_error(provider: Column, status: Column, body: Column, code: Column, remaining: Column, kind: Column | None = None) -> Column:
    """Why a response of a service ends all further calls to it; null if it does not. kind: the name of the error that the service's library raised."""
    p, k = low(provider), F.upper(strip(text(code)))
    status = F.coalesce(status, F.lit(0))
    denied, quota, rate = status.isin(401, 403), mentions(body, QUOTA), mentions(body, RATE) & ~mentions(body, BILLING)
    none_left = F.coalesce(strip(text(remaining)).try_cast("double") == 0, F.lit(False))
    brave = F.when(denied, "unauthorized_or_forbidden").when((status == 429) & ~rate, F.when((k == "QUOTA_LIMITED") & none_left, "quota_exhausted").when(k.isin(*PLAN_CODES), "quota_or_plan_blocked").when(quota, "quota_exhausted").otherwise("unknown_429"))
    firecrawl = F.when(status == 402, "quota_exhausted").when(denied, "unauthorized_or_forbidden").when((status == 429) & ~rate, F.when(quota, "quota_exhausted").otherwise("unknown_429"))
    other = F.when(denied, "unauthorized_or_forbidden").when((status == 429) & quota, "quota_exhausted")
    spent, barred, name = F.lower(k).isin(*SPENT_CODES), F.lower(k).isin(*BARRED_CODES), low(kind if kind is not None else F.lit(""))
    openai = (
        F.when(denied, "unauthorized_or_forbidden")
        .when(status == 429, F.when(rate, None).when(spent | barred | quota, "quota_exhausted").otherwise("unknown_429"))
        .when(spent, "quota_exhausted")
        .when(barred | name.rlike("authentication|permission"), "unauthorized_or_forbidden")
        .when(F.contains(name, F.lit("rate")) & quota, "quota_exhausted")
    )
    return F.when(p == "brave", brave).when(p == "firecrawl", firecrawl).when(p == "openai", openai).otherwise(other)


def lock_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """How a registry of questions (id, ord, fingerprint) differs from the one that was locked."""
    a, b = old.select("id", F.col("ord").alias("old_ord"), F.col("fingerprint").alias("old_print")), new.select("id", F.col("ord").alias("new_ord"), F.col("fingerprint").alias("new_print"))
    change = F.when(F.col("old_ord").isNull(), "added").when(F.col("new_ord").isNull(), "removed").when(F.col("old_print") != F.col("new_print"), "fingerprint_changed").when(F.col("old_ord") != F.col("new_ord"), "reordered")
    return a.join(b, "id", "full_outer").withColumn("change", change).filter("change is not null").select("id", "change")


def gate(counts: DataFrame) -> DataFrame:
    """What keeps questions (their phase_counts) from being concluded: what is not asked yet, then what is not reviewed yet; and how many rows they would exclude."""
    ask, review = F.col("ask_pending"), F.col("review_pending")
    ready = (ask == 0) & (review == 0)
    return counts.withColumns(
        {
            "ready": ready,
            "blocked_ask_pending": ask,
            "blocked_review_pending": F.when(ask == 0, review).otherwise(0),
            "applied_auto_excluded": F.when(ready, F.col("concludable_exclusions") - F.col("review_excluded")).otherwise(0),
            "applied_review_excluded": F.when(ready, F.col("review_excluded")).otherwise(0),
            "applied_total": F.when(ready, F.col("concludable_exclusions")).otherwise(0),
        }
    )


INSPECTED = ("auto_accepted", "auto_excluded", "review_accepted", "review_excluded")


def next_phase(counts: DataFrame, question: str, order: str, phase: str = "auto", interactive: bool = True) -> DataFrame:
    """The question to go on with and its phase, from phase_counts of all questions: at most one row. Questions are few.

    auto: the first with something to ask, else to review; people may inspect the last that is done. ask and
    review: the first with such work. conclude: the last with something to conclude, inspect, review or ask.
    """
    ask, review = F.col("ask_pending") > 0, F.col("review_pending") > 0
    seen = F.lit(False)
    for c in INSPECTED:
        seen = seen | (F.col(c) > 0)
    if phase == "auto":
        found = F.when(ask, "ask").when(review, "review").when(seen & F.lit(interactive), "conclude")
    elif phase == "conclude":
        found = F.when((F.col("concludable_exclusions") > 0) | seen | review | ask, "conclude")
    elif phase in ("ask", "review"):
        found = F.when(ask if phase == "ask" else review, phase)
    else:
        raise ValueError(f"unknown phase {phase!r}")
    last = F.when(found == "conclude", -F.col(order)).otherwise(F.col(order))
    rows = counts.withColumn("phase", found).filter("phase is not null")
    return rows.orderBy((F.col("phase") == "conclude").asc(), last).limit(1).select(question, "phase")


# The columns that steps keep their state in, by kind, with what a missing one holds.
STATE = {
    "registry": {
        "text": dict.fromkeys(("_zefix_query_name_normalized", "_zefix_match_status", "_zefix_match_uids", "_zefix_match_names", "_zefix_uid", "_zefix_legal_form", "_zefix_purpose", "_zefix_status", "_zefix_checked_at", "_zefix_error"), ""),
        "whole": {"_zefix_match_count": 0},
    },
    "verify": {
        "text": dict.fromkeys(("_discover_verify_status", "_discover_verify_confidence", "_discover_verify_reason", "_discover_verify_stage", "_discover_verify_llm_reason", "_discover_verify_llm_evidence", "_discover_verified_at"), ""),
        "boolean": dict.fromkeys(("_discover_verify_needs_review", "_discover_verify_rule_name_match", "_discover_verify_rule_location_match", "_discover_verify_llm_belongs")),
        "whole": dict.fromkeys(("_discover_verify_score", "_discover_verify_llm_score")),
    },
    "readiness": {
        "text": dict.fromkeys(("_scrape_input_signature", "_scrape_signature_checked_at", "_scrape_readiness_status", "_scrape_readiness_reason", "_scrape_readiness_note", "_scrape_readiness_reviewed_at"), ""),
        "boolean": {"_scrape_requires_reprepare": False},
    },
}


def initialised(df: DataFrame, step: str) -> DataFrame:
    """df with the state columns of a step (registry, verify or readiness) in their types, those missing with their defaults."""
    for kind, columns in STATE[step].items():
        df = ensure(df, kind, columns)
    return df
