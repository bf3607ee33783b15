"""Text: cleaning, identifiers, tokens. A missing text is an empty one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTES = "\"'`“”„«»‚‘’"


def text(c: Column | str) -> Column:
    """The value as text, empty for null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """White space as single spaces, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def blank(c: Column | str) -> Column:
    return strip(text(c)) == ""


def sanitize(c: Column | str) -> Column:
    """Without quote-like characters, white space collapsed."""
    return collapse(F.regexp_replace(text(c), f"[{QUOTES}]", ""))


def sanitize_search(c: Column | str) -> Column:
    """For search queries: quotes dropped, words, spaces and hyphens kept."""
    return collapse(F.regexp_replace(F.regexp_replace(text(c), f"[{QUOTES}]", ""), r"(?U)[^\w\s-]", " "))


def folded(c: Column | str) -> Column:
    return collapse(F.lower(text(c)))


def fingerprint(*columns: Column | str, prefix: str = "org_", digits: int = 12) -> Column:
    """A content hash of the folded columns."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat_ws("|", *[folded(c) for c in columns])), 1, digits))


def letters(c: Column | str) -> Column:
    """The letters alone, lower case: a category's mark."""
    return F.lower(F.regexp_replace(text(c), r"[^\p{L}]", ""))


def first_mark(c: Column | str, marks: str = "ab") -> Column:
    """The first lone letter of these."""
    return F.regexp_extract(F.lower(text(c)), rf"(?U)\b([{marks}])\b", 1)


def name_key(c: Column | str) -> Column:
    """For exact name matches: lower case, underscores and punctuation as spaces."""
    return collapse(F.regexp_replace(F.replace(F.lower(text(c)), F.lit("_"), F.lit(" ")), r"(?U)[^\w\s]", " "))


def replaced(c: Column, pairs: dict[str, str]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs.items(), c)


UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"}


def ascii_key(c: Column | str) -> Column:
    """Umlauts spelled out, lower case, all but letters, digits and hyphens as spaces."""
    c = F.lower(replaced(text(c), UMLAUTS | {"Ä": "ae", "Ö": "oe", "Ü": "ue"}))
    return collapse(F.regexp_replace(c, r"[^a-z0-9\s-]", " "))


def place_key(c: Column | str) -> Column:
    """Umlauts spelled out, all but letters and digits as spaces."""
    return collapse(F.regexp_replace(replaced(F.lower(text(c)), UMLAUTS), r"[^a-z0-9]+", " "))


def without_brackets(c: Column | str) -> Column:
    c = text(c)
    for left, right in (("\\(", "\\)"), ("\\[", "\\]"), ("\\{", "\\}")):
        c = F.regexp_replace(c, f"{left}[^{right}]*{right}", " ")
    return collapse(c)


def name_variants(c: Column | str) -> Column:
    """The name's key with and without bracketed parts, distinct, none empty."""
    return F.filter(F.array_distinct(F.array(ascii_key(c), ascii_key(without_brackets(c)))), lambda x: x != "")


def parts(c: Column, least: int) -> Column:
    """The words of a key of at least that length."""
    return F.filter(F.split(c, " "), lambda x: F.length(x) >= least)


def contains_token(c: Column, term: str | Column) -> Column:
    """Whether the term occurs between anything but word characters."""
    if isinstance(term, str):
        return c.rlike(rf"(?U)(?<!\w)\Q{term}\E(?!\w)")
    return F.rlike(c, F.concat(F.lit(r"(?U)(?<!\w)\Q"), term, F.lit(r"\E(?!\w)")))


def slug(c: Column | str, otherwise: str = "unnamed") -> Column:
    """Lower case, words joined by hyphens."""
    c = F.regexp_replace(strip(F.regexp_replace(F.lower(text(c)), r"(?U)[^\w\s-]", "")), r"(?U)[\s_]+", "-")
    return F.when(c == "", otherwise).otherwise(c)


def key_slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(c)), r"[^a-z0-9]+", "_"), "^_+|_+$", "")


def page_filename(order: Column, url: Column) -> Column:
    """The name of a page's file: its order, host and path in words, and a digest of its address."""
    place = F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    base = F.concat(place, F.lit("-"), F.when(path == "", "/").otherwise(path))
    return F.format_string("%03d-%s-%s.md", order.cast("int"), F.regexp_replace(F.regexp_replace(slug(base), "-+", "-"), "^-+|-+$", ""), F.substring(F.sha1(url), 1, 8))


def snippet_id(order: Column, stem: Column) -> Column:
    return F.format_string("s%02d_%s", order.cast("int"), F.substring(key_slug(stem), 1, 24))


def count_words(c: Column | str) -> Column:
    return F.regexp_count(text(c), F.lit(r"(?U)\S+"))


def keyword_count(c: Column, terms: list[str], whole_words: bool = True, case: bool = False) -> Column:
    """How often the terms occur, each counted without overlap."""
    if not terms:
        return F.lit(0)
    flags = "(?U)" if case else "(?iU)"
    edge = r"\b" if whole_words else ""
    return reduce(lambda a, b: a + b, [F.regexp_count(c, F.lit(rf"{flags}{edge}\Q{t}\E{edge}")) for t in terms])


def thousands(c: Column) -> Column:
    """A whole number with apostrophes, `-` for none."""
    return F.coalesce(F.replace(F.format_number(c.try_cast("double"), 0), F.lit(","), F.lit("'")), F.lit("-"))


def shown_time(c: Column) -> Column:
    """An ISO time as day.month.year hour:minute; other texts as they are."""
    return F.coalesce(F.date_format(F.try_to_timestamp(c), "dd.MM.yyyy HH:mm"), c)


def question_key(c: Column) -> Column:
    return F.regexp_extract(c, r"^(q\d+)", 1)


def search_url(query: Column, base: str) -> Column:
    return F.concat(F.lit(base), F.url_encode(query))


def tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator tile numbers of a place."""
    n, r = float(1 << zoom), F.radians(lat)
    x = (lon + 180.0) / 360.0 * n
    y = (1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / F.pi()) / 2.0 * n
    return x, y


def signature(*columns: str) -> Column:
    """A hash of the named columns in the order of their names: equal rows, equal signatures."""
    return F.sha2(F.to_json(F.struct(*[text(c).alias(c) for c in sorted(columns)])), 256)


def byte_size(c: Column, largest: str = "TB") -> Column:
    """A number of bytes in the largest unit, from KB to this one, that keeps it at 1 or above; half a tenth goes to the even one."""
    units = ("B", "KB", "MB", "GB", "TB")
    top = units.index(largest)
    size = lambda k: F.format_string(f"%.1f {units[k]}", F.bround(c.cast("double") / float(1 << 10 * k), 1))
    out = size(top)
    for k in range(top - 1, 0, -1):
        out = F.when(c < (1 << 10 * (k + 1)), size(k)).otherwise(out)
    return F.when(c < 1024, F.format_string("%d B", c.cast("bigint"))).otherwise(out)
