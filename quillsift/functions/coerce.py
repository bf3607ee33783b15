"""Columns of text tables: what is missing is added, what cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip, text

TRUE, FALSE = ("1", "true", "yes", "y"), ("0", "false", "no", "n")


def boolean(c: Column | str) -> Column:
    t = F.lower(strip(text(c)))
    return F.when(t.isin(*TRUE), True).when(t.isin(*FALSE), False)


def whole(c: Column | str) -> Column:
    """An integer; 12.0 is 12."""
    return strip(text(c)).try_cast("double").try_cast("bigint")


def number(c: Column | str) -> Column:
    return strip(text(c)).try_cast("double")


def lastmod(c: Column | str) -> Column:
    """A sitemap's time; a date by its first ten characters if nothing else."""
    t = strip(text(c))
    return F.coalesce(F.try_to_timestamp(t), F.try_to_timestamp(F.substring(t, 1, 10), F.lit("yyyy-MM-dd")))


def ensure(df: DataFrame, kind: str, columns: dict[str, object]) -> DataFrame:
    """Columns of a kind (text, boolean, whole, number) with defaults for what is missing or unreadable."""
    make = {"text": text, "boolean": boolean, "whole": whole, "number": number}[kind]
    empty = F.lit(None).cast("string")
    out = {}
    for name, default in columns.items():
        value = make(df[name] if name in df.columns else empty)
        if kind == "text":
            value = df[name].cast("string") if name in df.columns else empty
        out[name] = value if default is None else F.coalesce(value, F.lit(default))
    return df.withColumns(out)


def first_present(df: DataFrame, names: list[str], otherwise: str | None = None) -> str | None:
    """The first of these names that the table has."""
    return next((n for n in names if n in df.columns), otherwise)


def drop_but(df: DataFrame, prefix: str, keep: set[str]) -> DataFrame:
    """Without the columns of that prefix that are not to be kept."""
    return df.drop(*[c for c in df.columns if c.startswith(prefix) and c not in keep])


def clear(df: DataFrame, prefix: str, condition: Column) -> DataFrame:
    """Columns of that prefix blanked where the condition holds."""
    return df.withColumns({c: F.when(condition, F.lit("")).otherwise(F.col(c)) for c in df.columns if c.startswith(prefix)})
