"""Questions as data: TOML files with a prompt, fields of the answer, rules and the source of evidence."""

from __future__ import annotations

import hashlib
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column

from .config import Prompt
from .operators import rules

# Names in the files, and what they are here.
ACTIONS = {"auto_accept": "auto_accepted", "auto_exclude": "auto_excluded", "review_needed": "needs_review"}
KINDS = {"string": "string", "number": "number", "string_list": "strings", "object_list": "objects"}
CHOICES = {"mode": ("all", "any"), "selection_mode": ("file_order", "keyword_priority"), "match_mode": ("substring", "whole_word"), "fill_mode": ("fallback_file_order", "matches_only")}


@dataclass(frozen=True)
class Source:
    """Where evidence is from and how much of it; as evidence.snippets() takes it."""

    kind: str = "pages_cleaned"
    most: int = 18
    chars: int = 800
    least: int = 0
    total: int | None = None
    keyword_order: bool = False
    terms: tuple[str, ...] = ()
    whole_words: bool = False
    case: bool = False
    matches_only: bool = False

    def limits(self) -> dict[str, object]:
        """The arguments of evidence.snippets()."""
        return {k: v for k, v in vars(self).items() if k != "kind"}


@dataclass(frozen=True)
class Question:
    """A question, in its place among the others; the fingerprint is of its file."""

    id: str
    order: int
    fingerprint: str
    prompt: Prompt | None
    policies: tuple[rules.Policy, ...]
    fields: tuple[rules.Field, ...]
    source: Source = Source()
    strict: bool = False
    attempts: int = 2
    enabled: bool = True
    description: str = ""

    def normalized(self, payload: Column, snippet_ids: Column | None = None) -> dict[str, Column]:
        """Typed columns of an answer, and its error."""
        return rules.normalize(payload, list(self.fields), self.strict, snippet_ids)

    def routed(self, columns: dict[str, Column]) -> tuple[Column, Column]:
        """Action and reason for an answer's columns."""
        return rules.routed(list(self.policies), {f.key: (columns[f.key], f.kind) for f in self.fields})


class Reader:
    """A table of a file, with errors that name the question."""

    def __init__(self, table: object, name: str):
        self.table, self.name = table if isinstance(table, dict) else {}, name

    def inner(self, key: str) -> Reader:
        return Reader(self.table.get(key), self.name)

    def word(self, key: str, default: str = "") -> str:
        return str(self.table.get(key, default) or default).strip()

    def needed(self, key: str) -> str:
        return self.word(key) or self.fail(f"{key} is missing")

    def choice(self, key: str, among, default: str = "") -> str:
        found = self.word(key, default).lower()
        return found if found in among else self.fail(f"{key} cannot be {found!r}")

    def many(self, key: str) -> list:
        found = self.table.get(key, [])
        return found if isinstance(found, list) else self.fail(f"{key} is no list")

    def words(self, key: str) -> tuple[str, ...]:
        return tuple(str(x).strip() for x in self.many(key) if str(x).strip())

    def number(self, key: str, kind=int, default=None):
        return default if self.table.get(key) is None else kind(self.table[key])

    def fail(self, why: str):
        raise ValueError(f"question {self.name!r}: {why}")


def policy_of(r: Reader, place: int) -> rules.Policy:
    conditions = [Reader(c, r.name) for c in r.many("conditions")] or r.fail("a rule has no conditions")
    name, action = r.word("id", f"rule_{place}"), ACTIONS[r.choice("action", ACTIONS)]
    return rules.Policy(
        r.number("priority") or place,
        action,
        tuple(rules.Rule(c.needed("field"), c.needed("op").lower(), c.table.get("value")) for c in conditions),
        r.choice("mode", CHOICES["mode"], "all") == "any",
        r.word("review_reason") or f"Matched policy rule {name}.",
    )


def field_of(r: Reader) -> rules.Field:
    return rules.Field(
        r.needed("key"),
        KINDS[r.choice("kind", KINDS)],
        bool(r.table.get("required", False)),
        r.words("allowed"),
        bool(r.table.get("lowercase", False)),
        r.number("min", float),
        r.number("max", float),
        r.number("max_items"),
        bool(r.table.get("unique_casefold", False)),
        r.words("object_item_keys"),
    )


def source_of(r: Reader) -> Source:
    k = r.inner("keyword_priority")
    total = r.number("max_total_snippet_chars")
    if total is not None and total <= 0:
        r.fail("max_total_snippet_chars is not positive")
    return Source(
        r.word("kind", "pages_cleaned"),
        r.number("max_snippets", default=18),
        r.number("max_snippet_chars", default=800),
        r.number("min_snippet_chars", default=0),
        total,
        r.choice("selection_mode", CHOICES["selection_mode"], "file_order") == "keyword_priority",
        k.words("terms"),
        k.choice("match_mode", CHOICES["match_mode"], "substring") == "whole_word",
        bool(k.table.get("case_sensitive", False)),
        k.choice("fill_mode", CHOICES["fill_mode"], "fallback_file_order") == "matches_only",
    )


def prompt_of(r: Reader) -> Prompt | None:
    template = r.table.get("template")
    return Prompt(template, tuple(r.inner("placeholders").table)) if template else None


def read_question(content: bytes, name: str, place: int = 0) -> Question:
    """The question of a file's content; what is wrong raises a ValueError."""
    table = tomllib.loads(content.decode("utf-8"))
    r = Reader(table.get("classify"), name)
    prompt, output = Reader(table.get("prompt"), name), r.inner("output")
    fields = tuple(field_of(Reader(f, name)) for f in output.many("fields")) or r.fail("no output fields")
    keys = [f.key for f in fields]
    if len(set(keys)) < len(keys):
        r.fail("output fields have the same key")
    if missing := [k for k in prompt.inner("response").words("required_keys") if k not in keys]:
        r.fail(f"no output fields for {', '.join(missing)}")
    policies = tuple(policy_of(Reader(p, name), k) for k, p in enumerate(r.inner("policy").many("rules"), 1))
    return Question(
        r.word("id", name),
        r.number("order", default=place),
        hashlib.sha256(content).hexdigest(),
        prompt_of(prompt),
        policies,
        fields,
        source_of(r.inner("source")),
        bool(output.table.get("strict_output_keys", False)),
        max(1, r.number("ask_max_attempts", default=2)),
        bool(r.table.get("enabled", True)),
        r.word("description"),
    )


def load_questions(folder: str | Path, pattern: str = "classify.*.toml") -> list[Question]:
    """The questions of a folder's files in their order; none, or two with one id, raise a ValueError."""
    files = sorted(Path(folder).glob(pattern))
    if not files:
        raise ValueError(f"no question in {folder}")
    found = [read_question(f.read_bytes(), f.stem.removeprefix("classify."), k) for k, f in enumerate(files)]
    if len({q.id for q in found}) < len(found):
        raise ValueError("two questions have one id")
    return sorted(found, key=lambda q: (q.order, q.id))


@dataclass(frozen=True)
class PromptFile:
    """A prompt of the registry and the keys that its answer must have."""

    id: str
    prompt: Prompt
    description: str = ""
    required_keys: tuple[str, ...] = field(default_factory=tuple)


def load_prompts(folder: str | Path) -> dict[str, PromptFile]:
    """The prompts of a folder's TOML files by id. Placeholders that differ from the declared ones, a missing template, or two prompts with one id raise a ValueError."""
    out: dict[str, PromptFile] = {}
    for path in sorted(Path(folder).glob("*.toml")):
        r = Reader(tomllib.loads(path.read_text(encoding="utf-8")).get("prompt"), path.stem)
        name = r.word("id", path.stem)
        if name in out:
            r.fail("another prompt has this id")
        out[name] = PromptFile(name, prompt_of(r) or r.fail("no template"), r.word("description"), r.inner("response").words("required_keys"))
    return out
