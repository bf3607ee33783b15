"""Names against lists and tables: terms, fuzzy terms, registries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, contains_token, folded, name_key, strip, text


#: More terms than this are one array that is searched, not a branch each: plan and code stay small.
BRANCHES = 100


def first_term(c: Column, terms: list[str]) -> Column:
    """The first of the terms, in their order, that the text has between word edges; null for none."""
    t = F.lower(strip(text(c)))
    if len(terms) > BRANCHES:
        pairs = F.array(*[F.struct(F.lit(term).alias("term"), F.lit(term.lower()).alias("low")) for term in terms])
        return F.try_element_at(F.filter(pairs, lambda x: F.contains(t, x["low"]) & contains_token(t, x["low"])), F.lit(1))["term"]
    return F.coalesce(*[F.when(contains_token(t, term.lower()), F.lit(term)) for term in terms], F.lit(None).cast("string"))


def exact(df: DataFrame, column: str, terms: list[str]) -> DataFrame:
    """matched_term, confidence (100 or 0) and needs_review (blank texts alone)."""
    found = first_term(F.col(column), terms)
    return df.withColumns({"matched_term": F.when(~blank(column), found), "confidence": F.when(~blank(column) & found.isNotNull(), 100).otherwise(0), "needs_review": blank(column)})


def partition(df: DataFrame, allowed: list[str], decision: str = "decision") -> DataFrame:
    """bucket: matched, review or excluded, by the match and by manual decisions (include, exclude), which win."""
    base = F.coalesce(F.col("matched_term").isin(*allowed), F.lit(False))
    review = F.col("needs_review") & F.coalesce(F.col("matched_term").isNotNull(), F.lit(False))
    take, drop = F.coalesce(F.col(decision) == "include", F.lit(False)), F.coalesce(F.col(decision) == "exclude", F.lit(False))
    matched = (base | take) & ~drop
    return df.withColumn("bucket", F.when(matched, "matched").when(review & ~take & ~drop, "review").otherwise("excluded"))


def lcs(a: str, b: str) -> int:
    """The length of the longest common subsequence, by bit vectors."""
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for x in b:
        u = s & at.get(x, 0)
        s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text to a window of the longer one; of texts of one length, either way."""
    a, b = sorted((a, b), key=len)
    if not a:
        return 100.0 if not b else 0.0
    pairs = [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]
    return max(ratio(x, w) for x, y in pairs for w in {y[max(0, i) : i + len(x)] for i in range(1 - len(x), len(y))})


def plain_words(t: str) -> str:
    """A text's words in order of the alphabet; no marks, and no letters of Latin-1 beyond ASCII."""
    return " ".join(sorted(re.sub(r"\W", " ", re.sub("[\x80-\xff]", "", t)).lower().split()))


def similarity(a: str, b: str) -> int:
    """The best of three ratios, each a whole number from 0 to 100."""
    return max(round(ratio(a, b)), round(partial_ratio(a, b)), round(ratio(plain_words(a), plain_words(b))))


class Terms:
    """Terms to compare texts with. How many characters two texts share bounds their ratios: terms that cannot win are not compared."""

    def __init__(self, terms: list[str], width: int = 128):
        self.terms, self.low, self.width = terms, [t.lower() for t in terms], width
        self.words = [plain_words(t) for t in self.low]
        self.exact = [re.compile(rf"(?<!\w){re.escape(t)}(?!\w)") for t in self.low]
        self.bags = [(self.counted(x), np.array([len(t) for t in x])) for x in (self.low, self.words)]

    def counted(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.width), np.int32)
        for i, t in enumerate(texts):
            if t:
                out[i] = np.bincount([ord(x) % self.width for x in t], minlength=self.width)
        return out

    def bounds(self, t: str) -> np.ndarray:
        """No ratio of a text to a term is above this."""
        best = np.zeros(len(self.terms))
        for own, (bag, size) in zip((t, plain_words(t)), self.bags):
            shared = np.minimum(bag, self.counted([own])).sum(axis=1)
            best = np.maximum(best, np.where(np.minimum(size, len(own)) > 0, 200.0 * shared / np.maximum(1, np.minimum(size, len(own)) + shared), 100.0 * ((size == 0) & (not own))))
        return best

    def best(self, t: str) -> tuple[str | None, float]:
        """The term that the text has between word edges, else the most similar one; the first of equals. And its ratio."""
        for term, low, pattern in zip(self.terms, self.low, self.exact):
            if low in t and pattern.search(t):
                return term, 100.0
        limit, at, score = self.bounds(t), len(self.terms), 0
        for k in np.argsort(-limit, kind="stable"):
            if round(limit[k]) < score or score == 0 and not limit[k]:
                break
            now = similarity(t, self.low[k])
            if now > score or now == score > 0 and k < at:
                at, score = int(k), now
        return (self.terms[at] if score else None), float(score)


def fuzzy(df: DataFrame, column: str, terms: list[str], threshold: float = 85) -> DataFrame:
    """matched_term, confidence, is_match and needs_review by the best of three ratios; a term between word edges has 100. Distinct texts are compared once."""

    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Terms(terms)
        for batch in batches:
            yield pd.DataFrame([known.best(t) for t in batch], columns=["matched_term", "confidence"])

    score = F.pandas_udf(best, "matched_term string, confidence double")
    keyed = df.withColumn("__key", F.lower(strip(text(column))))
    scored = keyed.select("__key").distinct().filter("__key <> ''").withColumn("__m", score("__key"))
    out = keyed.join(scored, "__key", "left").drop("__key")
    confidence = F.coalesce("__m.confidence", F.lit(0.0))
    return out.withColumns({"matched_term": F.col("__m.matched_term"), "confidence": confidence, "is_match": confidence >= threshold, "needs_review": blank(column) | (confidence >= threshold - 15) & (confidence < threshold)}).drop("__m")


def registry_match(entities: DataFrame, registry: DataFrame, key: str, name: str, uid: str, preview: int = 8, extra: list[str] = ()) -> DataFrame:
    """Entities with the registry rows of exactly their name: status, count, a preview of uids, and the row's values if there is one."""
    side = registry.select(name_key(name).alias("__name"), F.col(uid).cast("string").alias("__uid"), *[F.col(c).alias(f"__{c}") for c in extra]).filter("__name <> ''")
    order = F.array_sort(F.collect_list(F.struct(F.length("__uid").alias("n"), F.col("__uid").alias("u"))))
    # Only the previews are held for a name: counts are sums, and the first uids come by rank.
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("__name").orderBy(F.length("__uid"), "__uid"))
    head = side.withColumn("__r", rank).filter(F.col("__r") <= preview).groupBy("__name").agg(F.array_join(F.transform(order, lambda x: x["u"]), "|").alias("match_uids"), *[F.min_by(f"__{c}", "__r").alias(f"__{c}") for c in extra], F.min_by("__uid", "__r").alias("__first"))
    counted = side.groupBy("__name").agg(F.count("*").alias("match_count"))
    out = entities.withColumn("__name", name_key(name)).join(counted, "__name", "left").join(head, "__name", "left").drop("__name")
    n = F.coalesce("match_count", F.lit(0))
    return out.withColumns(
        {
            "match_count": n,
            "match_uids": F.coalesce("match_uids", F.lit("")),
            "match_status": F.when(n == 0, "no_match").when(n == 1, "matched").otherwise("multiple_matches"),
            "uid": F.when(n == 1, F.col("__first")).otherwise(""),
            **{f"registry_{c}": F.when(n == 1, F.col(f"__{c}")) for c in extra},
        }
    ).drop("__first", *[f"__{c}" for c in extra])


# The registry's legal forms, as uid, name and short name.
LEGAL_FORMS = (
    ("0000", "(unbekannt)", "-"),
    ("0101", "Einzelunternehmen", "EIU"),
    ("0103", "Kollektivgesellschaft", "KlG"),
    ("0106", "Aktiengesellschaft", "AG"),
    ("0107", "Gesellschaft mit beschränkter Haftung", "GmbH"),
    ("0108", "Genossenschaft", "Gen"),
    ("0109", "Verein", "Verein"),
    ("0110", "Stiftung", "Stift"),
    ("0151", "Zweigniederlassung", "ZN"),
    ("0104", "Kommanditgesellschaft", "KmG"),
    ("0111", "Zweigniederlassung einer ausl. Gesellschaft", "ZNA"),
    ("0118", "Nichtkaufmännische Prokura", "NKP"),
    ("0117", "Institut des öffentlichen Rechts", "IOR"),
    ("0105", "Kommanditaktiengesellschaft", "KmAG"),
    ("0113", "Besondere Rechtsform", "BES"),
    ("0119", "Gemeinderschaft", "GEM"),
    ("0116", "Investmentgesellschaft mit festem Kapital", "SICAF"),
    ("0115", "Investmentgesellschaft mit variablem Kapital", "SICAV"),
    ("0114", "Kommanditgesellschaft für kollektive Kapitalanlagen", "KmGK"),
)
#: Words of names and the form that they stand for.
FORM_WORDS = {"Verein": "Verein", "GmbH": "Gesellschaft mit beschränkter Haftung", "Stiftung": "Stiftung"}


def legal_form_name(uid: Column) -> Column:
    """The name of a legal form by its uid."""
    out = F.lit(None).cast("string")
    for code, name, _ in LEGAL_FORMS:
        out = F.when(uid == code, name).otherwise(out)
    return out


def first_keyword(c: Column, keywords: dict[str, str]) -> Column:
    """The label of the keyword that comes first in the text; of two at one place, the first listed."""
    places = [F.nullif(F.regexp_instr(text(c), F.lit(rf"(?iU)(?<!\w)\Q{k}\E(?!\w)")), F.lit(0)) for k in keywords]
    least = F.least(*places) if len(places) > 1 else places[0]
    out = F.lit("")
    for place, label in reversed(list(zip(places, keywords.values()))):
        out = F.when(place == least, label).otherwise(out)
    return F.when(least.isNull(), "").otherwise(out)


def resolve_place(c: Column, names: list[str], aliases: dict[str, str]) -> Column:
    """A place by its exact name, exact alias, then by containment either way, in the lists' order."""
    t = folded(c)
    steps = [F.when(t == n.lower(), n) for n in names] + [F.when(t == a.lower(), n) for a, n in aliases.items()]
    steps += [F.when((t != "") & (F.contains(t, F.lit(n.lower())) | F.contains(F.lit(n.lower()), t)), n) for n in names]
    steps += [F.when((t != "") & (F.contains(t, F.lit(a.lower())) | F.contains(F.lit(a.lower()), t)), n) for a, n in aliases.items()]
    return F.coalesce(*steps, F.lit(None).cast("string"))
