"""Snippets of an entity's pages as evidence, under limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, keyword_count, strip, text


def snippets(df: DataFrame, entity: str, order: str, content: str, *, terms: list[str] = (), whole_words: bool = True, case: bool = False, keyword_order: bool = True, matches_only: bool = False, least: int = 0, chars: int = 800, most: int = 18, total: int | None = None) -> DataFrame:
    """Snippets by entity: number of the page in the entity, how often terms occur in its whole text, the text kept.

    A budget over all snippets cuts the last one and strips it, so what is left may admit a further one: a fold
    over at most `most` candidates, which are the first by rank among those not empty.
    """
    t = collapse(text(content))
    rows = df.withColumn("__t", t).withColumns({"__n": F.length("__t"), "match_count": keyword_count(F.col("__t"), list(terms), whole_words, case).cast("bigint"), "__cut": strip(F.substring("__t", 1, chars))})
    # From here on a row is as long as its snippet: no window sorts whole texts.
    rows = rows.select(entity, order, "__n", "match_count", "__cut").withColumn("file_order", F.row_number().over(Window.partitionBy(entity).orderBy(order)))
    rows = rows.filter(F.col("__n") >= least)
    if matches_only and keyword_order:
        rows = rows.filter("match_count > 0")
    rows = rows.filter("__cut <> ''")
    first = [F.col("match_count").desc()] if keyword_order else []
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(entity).orderBy(*first, "file_order"))).filter(F.col("rank") <= most)
    row = F.struct("rank", "file_order", "match_count", F.col("__cut").alias("snippet"))
    grouped = rows.groupBy(entity).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    if total is not None:
        kind = "struct<used:int,done:boolean,out:array<struct<rank:int,file_order:int,match_count:bigint,snippet:string>>>"
        empty = F.struct(F.lit(0).alias("used"), F.lit(False).alias("done"), F.array().cast("array<struct<rank:int,file_order:int,match_count:bigint,snippet:string>>").alias("out")).cast(kind)

        def step(a, x):
            left = F.lit(total) - a["used"]
            cut = F.when(F.length(x["snippet"]) > left, strip(F.substring(x["snippet"], F.lit(1), F.greatest(left, F.lit(0))))).otherwise(x["snippet"])
            stop = a["done"] | (left <= 0) | (cut == "")
            kept = F.struct(x["rank"].alias("rank"), x["file_order"].alias("file_order"), x["match_count"].alias("match_count"), cut.alias("snippet"))
            return F.struct(F.when(stop, a["used"]).otherwise(a["used"] + F.length(cut)).alias("used"), stop.alias("done"), F.when(stop, a["out"]).otherwise(F.concat(a["out"], F.array(kept))).alias("out")).cast(kind)

        grouped = grouped.withColumn("rows", F.aggregate("rows", empty, step)["out"])
    return grouped.select(entity, F.inline("rows"))


def clipped(df: DataFrame, entity: str, order: list, content: str, budget: int) -> DataFrame:
    """Contents in order until the budget of characters is used up; the last one is cut. The window sorts what can be kept alone, not whole texts."""
    rows = df.withColumns({"__n": F.length(content), content: F.substring(content, 1, budget)})
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(entity).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = rows.withColumn("__left", F.lit(budget) - before).filter("__left > 0")
    return out.withColumn("clipped", F.substring(F.col(content), F.lit(1), F.col("__left").cast("int"))).drop("__left", "__n")


def rendered(snippets_: DataFrame, entity: str, order: str = "rank", name: str = "snippet_id", snippet: str = "snippet") -> DataFrame:
    """The snippets of an entity as one text for a prompt, in their order."""
    one = F.struct(F.col(order).alias("o"), F.concat(F.lit("- snippet_id: "), F.trim(text(name)), F.lit("\n  text: "), F.trim(text(snippet))).alias("t"))
    return snippets_.groupBy(entity).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["t"]), "\n\n").alias("evidence"))


def facts(values: dict[str, Column]) -> Column:
    """Facts as lines of `- name: value`; lists by commas, `-` for none."""

    def shown(c: Column, kind: str) -> Column:
        if kind == "list":
            c = F.array_join(F.filter(F.transform(c, lambda x: F.trim(text(x))), lambda x: x != ""), ", ")
        return F.coalesce(F.nullif(F.trim(text(c)), F.lit("")), F.lit("-"))

    return F.concat_ws("\n", *[F.concat(F.lit(f"- {k}: "), shown(*(v if isinstance(v, tuple) else (v, "")))) for k, v in values.items()])


# The facts of an entity, and where they are in the answers to its questions.
FACTS = (
    ("q01_primary_focus", "q01", "primary_focus"),
    ("q01_service_mode", "q01", "service_mode"),
    ("q01_subgroups", "q01", "subgroup_labels"),
    ("q02_scope", "q02", "scope"),
    ("q02_locations", "q02", "extracted_locations"),
    ("q03_spendenaufruf", "q03", "asks_for_donations"),
    ("q04_primary_target_group", "q04", "category"),
    ("q04_subgroups", "q04", "subgroup_labels"),
    ("q05_founded_year", "q05", "founded_year"),
    ("q06_finanz_status", "q06", "information_status"),
    ("q06_fiscal_year", "q06", "fiscal_year"),
    ("q06_total_earnings_chf", "q06", "total_earnings_chf"),
    ("q06_donated_amount_chf", "q06", "donated_amount_chf"),
)


def compact_facts(entities: DataFrame, answers: DataFrame, key: str, known: dict[str, str], wanted=FACTS) -> DataFrame:
    """facts of each entity: columns of its own (known: fact, column), then values of its answers (key, question, payload as JSON)."""
    questions = sorted({q for _, q, _ in wanted})
    side = answers.groupBy(F.col(key)).agg(*[F.max(F.when(F.col("question") == q, F.col("payload"))).alias(f"__{q}") for q in questions])
    out = entities.join(side, key, "left")
    lists = lambda raw: F.coalesce(F.array_join(F.filter(F.transform(F.from_json(raw, "array<string>"), lambda x: F.trim(text(x))), lambda x: x != ""), ", "), raw)
    values = {k: F.col(c) for k, c in known.items()}
    for name, question, field in wanted:
        raw = F.get_json_object(F.col(f"__{question}"), f"$.{field}")
        values[name] = F.when(raw.startswith("["), lists(raw)).otherwise(raw)
    return out.withColumn("facts", facts(values)).drop(*[f"__{q}" for q in questions])
