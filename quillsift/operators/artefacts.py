"""Artefacts of single entities as tables: answers as JSON, prepared pages, probes, attempts; and what is to be done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.coerce import boolean
from ..functions.text import blank, strip, text
from .screening import low, valid_code
from .stages import critical_readiness

# Keys of an answer that are no part of what is shown.
INNER = ("evidence", "reason", "score", "confidence", "year_signal", "candidate_years")


def payload(artefact: Column) -> Column:
    """The answer that counts, as a map of JSON values: a person's if it has any key, else the model's; empty for what cannot be read."""
    v = F.try_parse_json(text(artefact))
    at = lambda path: F.try_variant_get(v, path, "map<string,variant>")
    own = at("$.manual_override.normalized")
    return F.coalesce(F.when(F.size(own) > 0, own), at("$.normalized"), F.try_variant_get(F.parse_json(F.lit("{}")), "$", "map<string,variant>"))


def shown_payload(artefact: Column, inner: tuple[str, ...] = INNER) -> Column:
    """It without the keys that are not shown, as a JSON object."""
    return F.to_json(F.map_filter(payload(artefact), lambda k, _: ~k.isin(*inner)))


def payloads(artefacts: DataFrame, entity: str, question: str, artefact: str) -> DataFrame:
    """A row for each entity: a map from the short name of each question (q01) to its answer; of several answers the first in order."""
    rows = artefacts.select(entity, F.regexp_extract(question, r"^(q\d+)", 1).alias("__q"), shown_payload(F.col(artefact)).alias("__b")).filter("__q <> ''")
    rows = rows.groupBy(entity, "__q").agg(F.min("__b").alias("__b"))
    return rows.groupBy(entity).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__q", "__b")))).alias("payloads"))


def progressed(df: DataFrame, questions: dict[str, tuple[str, str]]) -> DataFrame:
    """Questions (name: columns of the automatic and the reviewed result) that have any result: one pass for all of them."""
    def filled(columns: tuple[str, str]) -> Column:
        some = F.lit(False)
        for c in columns:
            if c in df.columns:
                some = some | ~blank(c)
        return F.coalesce(F.bool_or(some), F.lit(False))

    one = df.agg(F.array_compact(F.array(*[F.when(filled(c), q) for q, c in questions.items()])).alias("__q"))
    return one.select(F.explode("__q").alias("question"))


def with_reviews(df: DataFrame, artefacts: DataFrame, key: str, artefact: str) -> DataFrame:
    """Columns review_code and review_note from the review of each row, empty where there is none to read."""
    j = text(artefact)
    side = artefacts.select(key, F.upper(strip(text(F.get_json_object(j, "$.exclusion_reason")))).alias("review_code"), strip(text(F.get_json_object(j, "$.exclusion_reason_note"))).alias("review_note"))
    return df.join(side, key, "left").na.fill("", ["review_code", "review_note"])


def excluded(df: DataFrame, ids: DataFrame, key: str, code: str, now: Column, note: str = "") -> DataFrame:
    """Rows excluded by hand, with reason, note and time; ids that the table lacks are added."""
    hit = ids.select(key).distinct().withColumn("__hit", F.lit(True))
    out = df.join(hit, key, "full")
    values = {"_excluded_reason": F.lit(code), "_excluded_reason_note": strip(F.lit(note)), "_excluded_at": now, "_website_origin": F.lit("manual_excluded"), "_website_needs_review": F.lit(False)}
    return out.withColumns({c: F.when(F.col("__hit"), v).otherwise(F.col(c) if c in df.columns else F.lit(None)) for c, v in values.items()}).drop("__hit")


def normalisation_queue(df: DataFrame, review: str, final: str, reason: str, pending: bool = True, all_rows: bool = False) -> DataFrame:
    """Rows whose normalised URL people look at: those that need it, have no final URL and are not excluded; the flags widen it."""
    out = df if all_rows else df.filter(F.coalesce(boolean(review), F.lit(False)))
    return out.filter(~valid_code(reason) & blank(final)) if pending else out


def to_prepare(df: DataFrame, summary: DataFrame, key: str, again: str, refresh: bool = False) -> DataFrame:
    """Entities to prepare: those without a summary, and those whose summary is stale."""
    if refresh:
        return df
    done = summary.filter(~F.coalesce(boolean(again), F.lit(False))).select(strip(text(key)).alias("__k")).distinct()
    return df.join(done, strip(text(df[key])) == done["__k"], "left_anti")


def checked(summary: DataFrame, live: DataFrame, targets: DataFrame, key: str, signature: str, expected: str, status: str, file: str, now: Column) -> DataFrame:
    """Summaries with why each must be prepared again (column stale_reasons, in order) before its pages are fetched.

    live (key, expected): the signature that an entity's input has now; targets (file, n): pages in each file of targets.
    A blank signature is filled in and is no reason.
    """
    now_ = live.select(key, F.col(expected).alias("__expected"), F.lit(True).alias("__live"))
    pages = targets.groupBy(F.col("file").alias("__file")).agg(F.sum("n").alias("__n"))
    out = summary.join(now_, key, "left").withColumn("__f", strip(text(file))).join(pages, F.col("__f") == F.col("__file"), "left")
    own = strip(text(signature))
    reasons = F.array(
        F.when(F.col("__live").isNull(), "missing_live_row").when((own != "") & (own != text("__expected")), "signature_mismatch"),
        F.when(low(status).isin("pending", "deferred"), F.concat(F.lit("readiness_"), low(status))),
        F.when(F.col("__f") == "", "missing_targets_file").when(F.coalesce("__n", F.lit(0)) == 0, "missing_or_empty_targets"),
    )
    out = out.withColumn("stale_reasons", F.array_compact(reasons))
    filled = F.when((own == "") & F.col("__live"), F.col("__expected")).otherwise(F.col(signature))
    return out.withColumns({signature: filled, "_scrape_requires_reprepare": F.size("stale_reasons") > 0, "_scrape_signature_checked_at": now}).drop("__expected", "__live", "__f", "__file", "__n")


def reachable(probes: DataFrame, entity: str, order: str, address: str, status: str, final: str, error: str) -> DataFrame:
    """The first probe of each entity that answers below 500 with a usable address; else why not, of the first three.

    final: where the probe ended; an address without http or https is no usable one. Probes of an entity are few.
    """
    good = F.col(status) < 500
    where = F.coalesce(F.nullif(strip(text(final)), F.lit("")), F.col(address))
    valid = where.rlike("(?i)^https?://[^/?#\\s]+")
    note = F.concat(F.col(address), F.lit(" ("), F.when(~F.coalesce(good, F.lit(False)), F.coalesce(F.format_string("http_%d", F.col(status).cast("int")), text(error))).otherwise("invalid_resolved_url"), F.lit(")"))
    note = F.when(F.col(status).isNull(), F.concat(F.col(address), F.lit(" ("), text(error), F.lit(")"))).otherwise(note)
    ok = F.coalesce(good & valid, F.lit(False))
    notes = F.slice(F.transform(F.array_sort(F.collect_list(F.when(~ok, F.struct(F.col(order).alias("o"), note.alias("t"))))), lambda x: x["t"]), 1, 3)
    out = probes.groupBy(entity).agg(F.min_by(F.when(ok, where), F.when(ok, F.col(order))).alias("seed"), notes.alias("__notes"))
    return out.withColumn("error", F.when(F.col("seed").isNull(), F.concat(F.lit("seed_unreachable:"), F.array_join("__notes", "; "))).otherwise("")).drop("__notes")


def prepare_summary(df: DataFrame, now: Column) -> DataFrame:
    """The summary row of each prepared entity, from its own columns; counts and texts that are missing are 0 and empty."""
    has = set(df.columns)
    take = lambda name: text(name) if name in has else F.lit("")
    count = lambda name: F.coalesce(F.col(name).cast("bigint"), F.lit(0)) if name in has else F.lit(0).cast("bigint")
    flag = lambda name: F.coalesce(F.col(name).cast("boolean"), F.lit(False)) if name in has else F.lit(False)
    out = {
        "_org_id": take("org_id"), "_org_name": take("org_name"), "_website_url": take("website_url"),
        "_scrape_seed_original": take("seed_original"), "_scrape_seed_normalized": take("seed"), "_scrape_scope_mode": take("scope_mode"), "_scrape_scope_path_prefix": take("path_prefix"), "_scrape_scope_reason": take("scope_reason"),
        "_scrape_robots_policy": take("robots_policy"), "_scrape_robots_fetch": take("robots_fetch"), "_scrape_allowed": flag("allowed"), "_scrape_sitemap_stale": flag("sitemap_stale"),
        "_scrape_prepared_candidate_count": count("candidates"), "_scrape_prepared_excluded_count": count("excluded"), "_scrape_prepared_kept_count": count("kept"), "_scrape_prepared_url_count": count("kept"),
        "_scrape_prep_status": take("prep_status"), "_scrape_prep_error": take("prep_error"), "_scrape_prepared_at": now, "_scrape_targets_file": F.lit(""), "_scrape_input_signature": take("signature"),
        "_scrape_requires_reprepare": F.lit(False), "_scrape_signature_checked_at": now,
        "_scrape_readiness_status": F.when(critical_readiness("prep_status", "robots_fetch"), "pending").otherwise("not_required"),
        "_scrape_readiness_reason": F.lit(""), "_scrape_readiness_note": F.lit(""), "_scrape_readiness_reviewed_at": F.lit(""),
    }
    return df.select(*[c.alias(k) for k, c in out.items()])


def attempts(manifest: DataFrame, entity: str, url: str, order: str, status: str, count: str, extractor: str) -> DataFrame:
    """Of each page of a manifest: its last success, its attempts so far, and the extractor of its entity's last success."""
    good = low(status) == "success"
    last = lambda c, of: F.max_by(c, F.when(of, F.col(order)))
    pages = manifest.groupBy(entity, strip(text(url)).alias("url")).agg(
        F.max(F.when(good, F.col(order))).alias("last_success"),
        F.coalesce(F.max(strip(text(count)).try_cast("double")).cast("bigint"), F.lit(0)).alias("attempts"),
        last(strip(text(extractor)), good).alias("__by"),
    )
    # An entity's extractor from its pages' last successes: a hot entity sends a row for each page, not for each attempt.
    best = pages.groupBy(entity).agg(F.max_by("__by", "last_success").alias("calibrated"))
    return pages.drop("__by").join(best.select(F.col(entity), F.coalesce(F.nullif("calibrated", F.lit("")), F.lit("")).alias("calibrated")), entity)


def top(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    """The commonest values that are not blank of the n commonest, with their counts; ties in order of the value."""
    counts = df.groupBy(strip(text(column)).alias(column)).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(n).filter(F.col(column) != "")


def progress(df: DataFrame, decision: str, group: list[str] = ()) -> DataFrame:
    """How far a review is: all rows, those seen, and how many were accepted, skipped, excluded."""
    d = low(decision)
    return df.groupBy(*group).agg(F.count("*").alias("total"), F.count_if(d != "").alias("current"), *[F.count_if(d == k).alias(k) for k in ("accepted", "skipped", "excluded")])
