"""Answers as JSON: typed, checked, and routed by rules. Nothing raises: an error is a column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip, text


@dataclass(frozen=True)
class Rule:
    """A condition on a field of a payload."""

    field: str
    op: str
    value: object = None


@dataclass(frozen=True)
class Policy:
    """Rules that lead to an action; the lowest priority that matches decides."""

    priority: int
    action: str
    rules: tuple[Rule, ...]
    any_of: bool = False
    reason: str = ""


def extract_object(c: Column | str) -> Column:
    """The JSON object of a text: the whole, or from its first to its last brace; null if there is none."""
    t = strip(text(c))
    inner = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    ok = lambda x: F.when(x.startswith("{") & F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(ok(t), ok(inner))


def strings(values) -> Column:
    return F.array(*[F.lit(str(v)) for v in values]).cast("array<string>")


def literal(value) -> Column:
    return F.lit(value) if not isinstance(value, (list, tuple)) else F.array(*map(F.lit, value))


def matches(rule: Rule, value: Column, kind: str) -> Column:
    """Whether a value (kind: string, number, strings or objects) meets a rule; null counts as no value."""
    op, want = rule.op, rule.value
    if op == "exists":
        return value.isNotNull() & (strip(value.cast("string")) != "") if kind in ("string", "number") else value.isNotNull()
    if op in ("eq", "neq"):
        same = value.eqNullSafe(literal(want))
        return same if op == "eq" else ~same
    if op in ("in", "not_in"):
        if not isinstance(want, (list, tuple)):
            return F.lit(False)
        among = F.coalesce(value.isin(*want), F.lit(False))
        return among if op == "in" else ~among
    if op in ("gte", "lte"):
        n = value.try_cast("double") if kind in ("string", "number") else F.lit(None).cast("double")
        return F.coalesce(n >= float(want) if op == "gte" else n <= float(want), F.lit(False))
    if op == "contains":
        has = F.array_contains(value, want) if kind == "strings" else F.contains(value.cast("string"), F.lit(str(want)))
        return F.coalesce(has, F.lit(False))
    if op == "intersects":
        if not isinstance(want, (list, tuple)) or kind != "strings":
            return F.lit(False)
        return F.coalesce(F.arrays_overlap(F.transform(value, lambda x: F.lower(strip(x))), strings(str(w).strip().lower() for w in want)), F.lit(False))
    if op in ("len_gte", "len_eq"):
        n = F.size(value) if kind in ("strings", "objects") else F.length(value) if kind == "string" else F.lit(None).cast("int")
        n = F.when(value.isNotNull(), n)
        return F.coalesce(n >= int(want) if op == "len_gte" else n == int(want), F.lit(False))
    return F.lit(False)


# Fixed value: the reason where nothing matches.
NO_RULE = "No policy rule matched; default manual review."


def routed(policies: list[Policy], fields: dict[str, tuple[Column, str]], otherwise: str = "needs_review") -> tuple[Column, Column]:
    """The action of the first policy, by priority, whose rules match, and its reason. Of no rules all match, and none."""
    action, reason = F.lit(otherwise), F.lit(NO_RULE)
    for p in sorted(policies, key=lambda p: p.priority)[::-1]:
        hit = F.lit(not p.any_of)
        for r in p.rules:
            found = matches(r, *fields.get(r.field, (F.lit(None).cast("string"), "string")))
            hit = (hit | found) if p.any_of else (hit & found)
        action, reason = F.when(hit, p.action).otherwise(action), F.when(hit, p.reason).otherwise(reason)
    return action, reason


@dataclass(frozen=True)
class Field:
    """A field of an answer and what is asked of it."""

    key: str
    kind: str = "string"
    required: bool = True
    allowed: tuple[str, ...] = ()
    lowercase: bool = False
    least: float | None = None
    most: float | None = None
    items: int | None = None
    unique: bool = True
    item_keys: tuple[str, ...] = ()


def casefolded(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def cleaned_list(values: Column, field: Field) -> Column:
    """Stripped entries that are not empty, once each without regard to case, the first `items`."""
    t = F.filter(F.transform(values, lambda x: strip(text(x))), lambda x: x != "")
    if field.lowercase:
        t = F.transform(t, F.lower)
    if field.unique:
        keys = F.transform(t, casefolded)
        t = F.filter(F.transform(F.arrays_zip(t.alias("v"), keys.alias("k")), lambda z: z), lambda z: z.isNotNull())
        t = F.filter(F.transform(t, lambda z, i: F.struct(z["v"].alias("v"), (F.array_position(keys, z["k"]) == i + 1).alias("f"))), lambda z: z["f"])
        t = F.transform(t, lambda z: z["v"])
    return F.slice(t, 1, field.items) if field.items is not None else t


def normalize(payload: Column, fields: list[Field], strict: bool = False, snippet_ids: Column | None = None) -> dict[str, Column]:
    """Typed columns of a JSON object's fields, and `error`: the first that is wrong, null for none."""
    out: dict[str, Column] = {}
    keys = F.json_object_keys(payload)
    names = strings(f.key for f in fields)
    missing = F.array_except(strings(f.key for f in fields if f.required), keys)
    errors = [F.when(payload.isNull(), "no_object"), F.when(F.size(missing) > 0, F.concat(F.lit("missing_keys:"), F.array_join(F.array_sort(missing), ",")))]
    if strict:
        extra = F.array_except(keys, names)
        errors.append(F.when(F.size(extra) > 0, F.concat(F.lit("extra_keys:"), F.array_join(F.array_sort(extra), ","))))
    for f in fields:
        raw = F.get_json_object(payload, f"$.{f.key}")
        if f.kind == "string":
            value = strip(text(raw))
            value = F.lower(value) if f.lowercase else value
            if f.allowed:
                errors.append(F.when(~value.isin(*f.allowed), f"invalid_value:{f.key}"))
            if f.required:
                errors.append(F.when(value == "", f"empty:{f.key}"))
        elif f.kind == "number":
            value = raw.try_cast("double")
            if f.required:
                errors.append(F.when(F.coalesce(raw, F.lit("")) == "", f"missing_number:{f.key}"))
            errors.append(F.when((F.coalesce(raw, F.lit("")) != "") & value.isNull(), f"invalid_number:{f.key}"))
            value = F.greatest(value, F.lit(float(f.least))) if f.least is not None else value
            value = F.least(value, F.lit(float(f.most))) if f.most is not None else value
            value = F.when(raw.try_cast("double").isNotNull(), value)
        elif f.kind == "strings":
            listed = F.from_json(raw, "array<string>")
            errors.append(F.when(listed.isNull(), f"no_list:{f.key}"))
            value = cleaned_list(listed, f)
            if f.allowed:
                errors.append(F.when(F.size(F.array_except(value, strings(f.allowed))) > 0, f"invalid_value:{f.key}"))
            if f.required:
                errors.append(F.when(F.size(value) == 0, f"no_items:{f.key}"))
        elif f.kind == "objects":
            listed = F.from_json(raw, "array<map<string,string>>")
            errors.append(F.when(listed.isNull(), f"no_list:{f.key}"))
            want = F.array_sort(strings(f.item_keys))
            errors.append(F.when(F.exists(listed, lambda m: F.array_sort(F.map_keys(m)) != want), f"invalid_item_keys:{f.key}"))
            value = F.transform(listed, lambda m: F.struct(*[strip(text(F.try_element_at(m, F.lit(k)))).alias(k) for k in f.item_keys]))
            if "snippet_id" in f.item_keys:
                value = F.filter(value, lambda x: x["snippet_id"] != "")
                if snippet_ids is not None:
                    value = F.filter(value, lambda x: F.array_contains(snippet_ids, x["snippet_id"]))
            if "quote" in f.item_keys:
                value = F.filter(value, lambda x: x["quote"] != "")
            value = F.slice(value, 1, f.items) if f.items is not None else value
            if f.required:
                errors.append(F.when(F.size(value) == 0, f"no_items:{f.key}"))
        else:
            raise ValueError(f"unknown kind {f.kind!r}")
        out[f.key] = value
    out["error"] = F.coalesce(*errors, F.lit(None).cast("string"))
    return out


def effective(override: Column, normalized: Column) -> tuple[Column, Column]:
    """The payload that counts, and where it is from."""
    return F.coalesce(override, normalized), F.when(override.isNotNull(), "manual_override").when(normalized.isNotNull(), "normalized").otherwise("")
