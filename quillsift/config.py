"""Rules as data: defaults of our own, and TOML files that replace them."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


# Registries, directories and networks that list entities; path words near a site's entrance; page suffixes.
AGGREGATORS = (
    "zefix.ch", "moneyhouse.ch", "uid.admin.ch", "shabex.ch", "help.ch", "search.ch", "local.ch", "linkedin.com", "facebook.com", "instagram.com", "twitter.com", "x.com", "youtube.com",
    "wikipedia.org", "wikidata.org", "dnb.com", "northdata.com", "northdata.de", "stiftungschweiz.ch", "lixt.ch", "fundraiso.ch", "zhwin.ch",
)
NEAR_ROOT = ("about", "ueber-uns", "about-us", "portrait", "kontakt", "contact", "home")
PAGE_SUFFIXES = (".html", ".htm", ".php", ".aspx", ".asp", ".jsp")


@dataclass(frozen=True)
class UrlRules:
    """Lexicons for URLs. Patterns match from the start of a segment."""

    languages: tuple[str, ...] = ("de", "en", "fr", "it")
    generic: tuple[str, ...] = ("home", "homepage", "index", "start", "startseite")
    page_suffixes: tuple[str, ...] = PAGE_SUFFIXES
    favor: tuple[str, ...] = ("about", "about-us", "ueber-uns", "mission", "team", "contact", "kontakt", "projects", "projekte", "angebot", "verein", "stiftung")
    favor_patterns: tuple[str, ...] = ("about", "who-we", "ueber-")
    penalize: tuple[str, ...] = ("news", "blog", "archive", "archiv", "tag", "events", "aktuell")
    penalize_patterns: tuple[str, ...] = ("news-", "event-")
    exclude: tuple[str, ...] = ("login", "cart", "search", "privacy", "datenschutz", "feed")
    exclude_patterns: tuple[str, ...] = ("wp-", "page-[0-9]+")
    scaffold: tuple[str, ...] = ("index", "cms", "web", "site", "pages", "home")
    technical_roots: tuple[str, ...] = ("api", "assets", "static")
    technical_pairs: tuple[tuple[str, str], ...] = (("wp", "json"), ("api", "v1"))
    extensions: tuple[str, ...] = (".pdf", ".jpg", ".png", ".zip", ".xml", ".css", ".js")
    boundary: tuple[str, ...] = ("about", "contact", "kontakt", "impressum", "news", "team")
    near_root: tuple[str, ...] = NEAR_ROOT
    aggregators: tuple[str, ...] = AGGREGATORS
    high_segments: tuple[str, ...] = ("de", "en", "fr", "it", "home", "start", "about", "contact")


def merged(base, over: dict):
    """A dataclass with what a dictionary has of its fields; nested ones are merged."""
    known = {f.name for f in fields(base)}
    if unknown := set(over) - known:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    out = {}
    for name, value in over.items():
        now = getattr(base, name)
        out[name] = merged(now, value) if hasattr(now, "__dataclass_fields__") else tuple(tuple(v) if isinstance(v, list) else v for v in value) if isinstance(value, list) else value
    return replace(base, **out)


def load(base, *paths: str | Path):
    """A dataclass with the settings of TOML files, later ones over earlier ones; files that do not exist are passed over."""
    for path in map(Path, paths):
        if path.exists():
            base = merged(base, tomllib.loads(path.read_text(encoding="utf-8")))
    return base


@dataclass(frozen=True)
class Prompt:
    """A template whose placeholders are exactly the declared ones."""

    template: str
    placeholders: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self):
        import string

        used = {name for _, name, _, _ in string.Formatter().parse(self.template) if name}
        if used != set(self.placeholders):
            raise ValueError(f"declared and used placeholders differ: {sorted(used ^ set(self.placeholders))}")

    def render(self, **values: str) -> str:
        if set(values) != set(self.placeholders):
            raise ValueError(f"values do not match the placeholders: {sorted(set(values) ^ set(self.placeholders))}")
        return self.template.format(**values)
