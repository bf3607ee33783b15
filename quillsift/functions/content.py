"""Pages: metadata, signs of rendering, quality of extracted text, the better of several extractors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import collapse, strip, text

# Words of page furniture; keywords of page names that say who an entity is, and that do not; signs that rendering failed for want of a browser.
BOILERPLATE = ("home", "menu", "navigation", "kontakt", "contact", "impressum", "datenschutz", "privacy", "cookie", "login", "newsletter", "footer", "header", "sitemap")
IDENTITY = ("impressum", "kontakt", "contact", "ueber", "uber", "about", "verein", "who-we-are", "team", "vorstand")
OTHER_PAGES = ("projekt", "projekte", "news", "blog", "event", "veranstaltung", "newsletter")
NO_BROWSER = ("playwright_not_installed", "browser_type.launch", "executable doesn't exist", "please run the following command to download new browsers", "failed to launch")
ACCEPTED = 35


def metadata(html: Column | str) -> dict[str, Column]:
    h = text(html)
    one = lambda p: strip(F.regexp_extract(h, p, 1))
    return {
        "title": collapse(one(r"(?is)<title[^>]*>(.*?)</title>")),
        "description": one(r"""(?is)<meta[^>]*name=["']description["'][^>]*content=["']([^"']*)["']"""),
        "canonical": one(r"""(?is)<link[^>]*rel=["']canonical["'][^>]*href=["']([^"']*)["']"""),
        "lang": one(r"""(?is)<html[^>]*\blang=["']([^"']*)["']"""),
    }


def render_markers(html: Column | str, extracted: Column | str) -> Column:
    """Signs that a page fills itself by scripts."""
    h = text(html)
    noscript = F.lower(F.array_join(F.regexp_extract_all(h, F.lit(r"(?is)<noscript[^>]*>(.*?)</noscript>"), 1), " "))
    scripts = F.regexp_count(h, F.lit("(?i)<script[ />]"))
    visible = F.length(collapse(F.regexp_replace(F.regexp_replace(h, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), "(?s)<[^>]*>", " ")))
    checks = [
        (r"""(?i)id\s*=\s*["']__next["']""", "id___next"),
        (r"(?i)window\.__NUXT__", "window_nuxt"),
        (r"(?i)data-reactroot", "data_reactroot"),
        (r"(?i)hydrateRoot\s*\(", "hydrate_root"),
        (r"(?i)createRoot\s*\(", "create_root"),
    ]
    marks = [F.when(h.rlike(p), name) for p, name in checks]
    marks.append(F.when(F.contains(noscript, F.lit("javascript")) & noscript.rlike("required|enable"), "noscript_js_required"))
    marks.append(F.when((scripts >= 10) & (visible < 500) & (F.length(strip(text(extracted))) < 200), "script_heavy_low_text"))
    return F.array_compact(F.array(*marks))


def render_trigger(markers: Column) -> Column:
    return F.when(F.size(markers) > 0, F.concat(F.lit("poor_static_extraction:markers="), F.array_join(markers, ","))).otherwise("poor_static_extraction")


def paragraphs(c: Column) -> Column:
    """Of a stripped text that is not empty."""
    return F.regexp_count(c, F.lit(r"(?U)\n\s*\n")) + 1


def link_density(c: Column) -> Column:
    links = F.regexp_extract_all(c, F.lit(r"\[([^\]]+)\]\([^\)]+\)"), 1)
    share = F.aggregate(links, F.lit(0), lambda a, x: a + F.length(strip(x))).cast("double") / F.greatest(F.length(c), F.lit(1))
    return F.when(F.contains(c, F.lit("](")), share).otherwise(F.lit(0.0))


def repeated_lines(c: Column) -> Column:
    """Of a stripped text: the share of its lines that it has before. White space with a line break in it parts lines."""
    lines = F.split(F.regexp_replace(c, r"(?U)\s*[\r\n]\s*", "\n"), "\n")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("double") / F.size(lines)


def boilerplate(c: Column, words: tuple[str, ...] = BOILERPLATE) -> Column:
    """The share of a page's furniture among the words of a text in lower case."""
    found = F.regexp_count(c, F.lit(rf"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])"))
    return F.coalesce(F.try_divide(found.cast("double"), F.regexp_count(c, F.lit("[a-z0-9]+")).cast("double")), F.lit(0.0))


def with_quality(df: DataFrame, content: Column | str, title: Column, description: Column, name: str = "score") -> DataFrame:
    """df with a score from 0 to 100: length, structure and metadata for it, links, repetition and boilerplate against it.

    The stripped text, and it in lower case, are columns of a step of their own: nothing strips it again for each part.
    """
    out = df.withColumn("__c", strip(text(content))).withColumn("__lower", F.lower("__c"))
    c = F.col("__c")
    n = F.length(c)
    add = lambda cond, points: F.when(cond, points).otherwise(0)
    out = out.withColumn("__p", paragraphs(c))
    p = F.col("__p")
    total = (
        F.when(n >= 2000, 35).when(n >= 1200, 25).when(n >= 600, 15).when(n >= 300, 5).otherwise(0)
        + F.when(p >= 5, 10).when(p >= 2, 5).otherwise(0)
        + add(c.rlike(r"(?m)^\s{0,3}#{1,6}\s+\S"), 10)
        + add(F.regexp_count(c, F.lit("[.!?]+")) >= 12, 5)
        + add(strip(text(title)) != "", 5)
        + add(strip(text(description)) != "", 5)
        - add(link_density(c) > F.lit(0.45), 20)
        - add(repeated_lines(c) > F.lit(0.30), 10)
        - add(boilerplate(F.col("__lower")) > F.lit(0.35), 10)
    )
    out = out.withColumn("__total", total)
    return out.withColumn(name, F.when(c == "", 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), F.col("__total"))))).drop("__c", "__lower", "__p", "__total")


def graded(score: Column, accepted: int = ACCEPTED, reason: Column | None = None) -> tuple[Column, Column]:
    """ok or low, and why."""
    why = F.format_string(f"score_below_threshold:%d<{accepted}", score.cast("int"))
    if reason is not None:
        why = F.concat_ws(";", F.nullif(strip(text(reason)), F.lit("")), why)
    return F.when(score.isNull(), "").when(score >= accepted, "ok").otherwise("low"), F.when(score.isNull() | (score >= accepted), "").otherwise(why)


def best_extractor(scores: dict[str, Column], preferred: str | None = None, accepted: int = ACCEPTED) -> Column:
    """The extractor with the highest score, the first of equals; the preferred one if it is good enough."""
    names = list(scores)
    top = F.greatest(*scores.values()) if len(names) > 1 else scores[names[0]]
    out = F.lit(names[-1])
    for n in reversed(names[:-1]):
        out = F.when(scores[n] == top, n).otherwise(out)
    return F.when(scores[preferred] >= accepted, preferred).otherwise(out) if preferred else out


def rendered_wins(static: Column, rendered: Column, accepted: int = ACCEPTED) -> Column:
    """A rendered page is used where the static one is poor and the rendered one strictly better."""
    return (static < accepted) & rendered.isNotNull() & (rendered > static)


def plain_text(html: Column | str) -> Column:
    """Text without markup, scripts and page furniture, by patterns alone."""
    h = F.regexp_replace(text(html), r"(?is)<(script|style|nav|footer|header)[^>]*>.*?</\1>", " ")
    return collapse(F.regexp_replace(h, "(?s)<[^>]*>", " "))


def failure(kind: Column, message: Column) -> Column:
    """The code of a fetch's failure, by the kind of error (timeout, connect, other) and its message."""
    return F.when(kind == "timeout", "network_timeout").when(kind == "connect", F.when(F.lower(text(message)).rlike("ssl|certificate"), "tls_error").otherwise("network_dns_failure")).otherwise("unexpected_exception")


def no_browser(message: Column) -> Column:
    out = F.lit(False)
    for sign in NO_BROWSER:
        out = out | F.contains(F.lower(text(message)), F.lit(sign))
    return out


def page_tier(name: Column) -> Column:
    """The order in which pages are read: those that say who an entity is, the first page, others, news and projects."""
    n = F.lower(text(name))
    return F.when(n.rlike("|".join(IDENTITY)), 0).when(n.startswith("001-"), 1).when(n.rlike("|".join(OTHER_PAGES)), 3).otherwise(2)


def minimal(title: Column, description: Column, canonical: Column, lang: Column, url: Column, content_type: Column, note: Column) -> Column:
    """A page that has no text of its own: what is known of it, a line each."""
    known = {"URL": text(url), "Content-Type": text(content_type), "Note": text(note), "Title": strip(text(title)), "Description": strip(text(description)), "Canonical": strip(text(canonical)), "Language": strip(text(lang))}
    return F.concat_ws("\n", F.lit("# Low-content page"), *[F.when(v != "", F.concat(F.lit(f"- {k}: "), v)) for k, v in known.items()])


#: From HTML to Markdown, in this order: what goes with all it holds, then marks of blocks and of words, then the other tags, entities and blank lines.
MARKDOWN = (
    (r"(?is)<!--.*?-->", ""),
    *((rf"(?is)<{t}(?:\s[^>]*)?>.*?</{t}\s*>", "") for t in ("script", "style", "nav", "footer", "header")),
    (r"(?i)<img\b[^>]*>", ""),
    (r"\s+", " "),
    *((rf"(?i)<h{k}(?:\s[^>]*)?> ?", "\n\n" + "#" * k + " ") for k in range(1, 7)),
    (r"(?i) ?</h[1-6]\s*>", "\n\n"),
    (r"(?i)<br\s*/?> ?", "\n"),
    (r"(?i)<hr\b[^>]*> ?", "\n\n---\n\n"),
    (r"(?i)<li(?:\s[^>]*)?> ?", "\n* "),
    (r"(?i)</?(?:strong|b)(?:\s[^>]*)?>", "**"),
    (r"(?i)</?(?:em|i)(?:\s[^>]*)?>", "*"),
    (r"(?i)</?(?:code|kbd|samp)(?:\s[^>]*)?>", "`"),
    (r"""(?i)<a\s[^>]*?href=["']([^"'>]*)["'][^>]*>(.*?)</a\s*>""", "[{2}]({1})"),
    (r"(?i)</t[dh]\s*> ?<t[dh](?:\s[^>]*)?>", " | "),
    (r"(?i) ?</?(?:p|div|section|article|main|ul|ol|table|tr|blockquote|pre|form|figure|dl|dt|dd)(?:\s[^>]*)?> ?", "\n\n"),
    (r"<[^>]*>", ""),
    *((k, v) for k, v in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))),
    (r"[ \t]*\n[ \t]*", "\n"),
    (r"\n{3,}", "\n\n"),
)


def markdown(html: Column | str) -> Column:
    """The text of a page as Markdown: headings, lists, links and emphasis; no scripts, images and page furniture. By patterns alone, so tags that are never closed stay open."""
    out = text(html)
    for pattern, mark in MARKDOWN:
        out = F.regexp_replace(out, pattern, mark.replace("{1}", "$1").replace("{2}", "$2"))
    return strip(out)
