"""Model answers: recovering their JSON, long names for short ones, rules, and flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_in(text: Column) -> Column:
    """The JSON object that ends a text, null if there is none that parses."""
    found = F.regexp_extract(F.trim(text), r"(?s)(\{.*\})$", 1)
    return F.when(F.try_parse_json(found).isNotNull() & (found != ""), found)


def truncated(text: Column, most: int = 35_000) -> Column:
    """What a model is given of a long text."""
    return F.substring(text, 1, most)


def clean_strings(json: Column, field: str) -> Column:
    """The trimmed, non-empty strings of an object's array; empty if the field is missing or no array."""
    items = F.from_json(F.get_json_object(json, f"$.{field}"), "array<string>")
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda s: F.trim(s)), lambda s: s.isNotNull() & (s != ""))


def renamed_items(json: Column, short: str, names: dict[str, tuple[str, str]]) -> Column:
    """The objects of the array ``short`` with long names; names: short -> (long, type). Missing fields are null."""
    kind = "array<struct<" + ",".join(f"{s}:{t}" for s, (_, t) in names.items()) + ">>"
    items = F.coalesce(F.from_json(F.get_json_object(json, f"$.{short}"), kind), F.array().cast(kind))
    return F.transform(items, lambda x: F.struct(*(x[s].alias(n) for s, (n, _) in names.items())))


def faults(rules: dict[str, Column]) -> Column:
    """The names of the rules whose condition is true; an unknown condition is no fault."""
    return F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())), lambda f: f.isNotNull())


def rule_report(rows: DataFrame, hard: dict[str, Column], soft: dict[str, Column]) -> DataFrame:
    """(kind, rule, n): how many rows break each rule."""
    both = [("hard", n, c) for n, c in hard.items()] + [("soft", n, c) for n, c in soft.items()]
    one = rows.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(f"_{i}") for i, (_, _, c) in enumerate(both)))
    items = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(n).alias("rule"), F.col(f"_{i}").alias("n")) for i, (k, n, _) in enumerate(both)))
    return one.select(F.explode(items).alias("x")).select("x.*")


def keyword_rows(answers: DataFrame, json: str, categories: list[str], least: float = 0.5) -> DataFrame:
    """(id, category, text, relevance) of an answer's keywords by category, in lower case, those of ``least`` relevance."""
    kind = "array<struct<keyword:string,relevance:double>>"

    def of(name: str) -> Column:
        items = F.coalesce(F.from_json(F.get_json_object(json, f"$.{name}"), kind), F.array().cast(kind))
        return F.transform(items, lambda x: F.struct(F.lit(name).alias("category"), F.lower(F.trim(x.keyword)).alias("text"), x.relevance.alias("relevance")))

    rows = answers.select("id", F.explode(F.concat(*map(of, categories))).alias("k")).select("id", "k.*")
    return rows.where((F.col("relevance") >= least) & (F.col("text") != "")).groupBy("id", "category", "text").agg(F.max("relevance").alias("relevance"))
