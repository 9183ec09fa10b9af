"""Resolving names, aliases, links and citations to the records they mean, and checking that a merge kept them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reporter_token, volume_reporter_page, without_stop_words


def backfilled(rows: DataFrame, others: DataFrame, name: str, key: str, column: str) -> DataFrame:
    """``rows`` with a null ``column`` taken from the first of ``others`` (by ``key``) of the same name that has it; ``filled`` tells which.

    Null names match nothing, and a value that is there stays.
    """
    first = others.where(F.col(name).isNotNull() & F.col(column).isNotNull()).groupBy(name).agg(F.min_by(column, F.struct(key, column)).alias("_value"))
    out = rows.join(first, name, "left").withColumn("filled", F.col(column).isNull() & F.col("_value").isNotNull())
    return out.withColumn(column, F.coalesce(column, "_value")).drop("_value")


def named_units(units: DataFrame, key: str, canonical: str, aliases: str) -> DataFrame:
    """(name, key, by): the canonical names and the aliases of units as one table; a name of both kinds is canonical."""
    own = units.select(F.col(canonical).alias("name"), key, F.lit("canonical").alias("by"))
    other = units.select(F.explode(aliases).alias("name"), key, F.lit("alias").alias("by"))
    every = own.unionByName(other).where("name is not null")
    return every.groupBy("name", key).agg(F.max("by").alias("by"))


def resolved_names(rows: DataFrame, column: str, names: DataFrame, key: str) -> DataFrame:
    """``rows`` with the unit that ``column`` names: canonical names before aliases, then the lowest key; nulls stay unresolved."""
    one = names.groupBy("name").agg(F.min(F.struct(F.when(F.col("by") == "canonical", 0).otherwise(1).alias("r"), key, "by")).alias("_u"))
    out = rows.join(one.withColumnRenamed("name", column), column, "left")
    return out.withColumn(key, F.col(f"_u.{key}")).withColumn("by", F.col("_u.by")).drop("_u")


def resolved_links(links: DataFrame, destination: str, units: DataFrame, address: str, key: str) -> DataFrame:
    """``links`` with the unit that stands at their destination, the lowest key of several, null if none does."""
    at = units.where(F.col(address).isNotNull()).groupBy(F.col(address).alias(destination)).agg(F.min(key).alias("target"))
    return links.join(at, destination, "left")


def curie_round_trip(source: DataFrame, merged: DataFrame, remap: DataFrame) -> DataFrame:
    """(source_ref, n, mismatches): for every remapped row, whether its identifier is that of the merged row.

    source(source_ref, old_id, curie), merged(new_id, curie), remap(source_ref, old_id, new_id). Nulls are equal.
    """
    both = remap.join(source.select("source_ref", "old_id", F.col("curie").alias("a")), ["source_ref", "old_id"]).join(merged.select("new_id", F.col("curie").alias("b")), "new_id", "left")
    return both.groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("mismatches"))


def collapse_bounds(source: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: a collapse neither adds rows nor goes below the largest source. source(source_ref, ...)."""
    per = source.groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"))
    one = per.agg(F.sum("n").alias("source_sum"), F.max("n").alias("source_max"))
    every = one.join(merged.agg(F.count(F.lit(1)).alias("merged_count")))  # one row each
    return every.withColumn("ok", (F.col("merged_count") <= F.col("source_sum")) & (F.col("merged_count") >= F.col("source_max")))


def cite_issue(actual: Column, reporter: Column, volume: Column, page: Column | None = None) -> Column:
    """What is wrong with a stored citation against the expected reporter, volume and page; an expected page may be missing."""
    parsed = volume_reporter_page(actual, True)
    wrong_page = F.lit(False) if page is None else F.coalesce(parsed["page"] != page, F.lit(False))
    return (
        F.when(actual.isNull() | (F.trim(actual) == ""), "db_missing_official").when(parsed.isNull(), "db_cite_parse_error")
        .when(reporter_token(parsed["reporter"]) != reporter_token(reporter), "db_reporter_mismatch").when(~parsed["volume"].eqNullSafe(volume) | wrong_page, "db_volume_or_page_mismatch").otherwise("ok")
    )


def section_chunks(heading: Column, content: Column, size: int = 500) -> Column:
    """array<struct<chunk_index, total_chunks, content>>: the words of a section in runs of ``size``, its heading first, without stop words."""
    words = F.split(F.when(F.coalesce(heading, F.lit("")) != "", F.concat(heading, F.lit("\n"), F.coalesce(content, F.lit("")))).otherwise(F.coalesce(content, F.lit(""))), r"\s+")
    total = F.ceil(F.size(words) / size).cast("int")
    return F.transform(
        F.sequence(F.lit(0), total - 1), lambda i: F.struct(i.alias("chunk_index"), total.alias("total_chunks"), without_stop_words(F.array_join(F.slice(words, i * size + 1, F.lit(size)), " ")).alias("content"))
    )


def distinguishing_key(axis: Column, text: Column) -> Column:
    """'axis: text', both trimmed."""
    return F.concat(F.trim(axis), F.lit(": "), F.trim(text))


def batch_size(n: Column, unsplit: int = 500, best: int = 500, least: int = 50) -> Column:
    """How many requests a batch gets of ``n`` in all: few are one batch, many are cut small to run side by side."""
    batches = F.least(F.lit(10), F.greatest(F.lit(5), F.ceil(n / best)))
    return F.when(n <= unsplit, n).when(n > 10_000, 4 * least).when(n > 5_000, best).otherwise(F.ceil(n / batches)).cast("long")


def poll_delays(minutes: int) -> list[int]:
    """The seconds to wait before each look at a running job: 5, and one more for each minute waited, at most 60, for ``minutes`` in all."""
    out, waited = [], 0
    while waited < 60 * minutes:
        out.append(min(60, 5 + waited // 60))
        waited += out[-1]
    return out


def page_anchor(url: Column, page: Column) -> Column:
    """The address of a page within a document."""
    return F.when(url.isNotNull(), F.when(page > 0, F.concat(url, F.lit("#page="), page.cast("string"))).otherwise(url))


def public_file(base: str, year: Column, number: Column) -> Column:
    """base/year/year_00000.pdf, null without a year or number."""
    padded = F.when(F.length(number) >= 5, number).otherwise(F.lpad(number, 5, "0"))
    return F.when(year.isNotNull() & (number != ""), F.concat(F.lit(f"{base}/"), year.cast("string"), F.lit("/"), year.cast("string"), F.lit("_"), padded, F.lit(".pdf")))


#: a setting's rule: whether it must be there, and the values it may have
Rule = tuple[bool, tuple[str, ...]]


def config_faults(settings: Column, rules: dict[str, Rule]) -> Column:
    """The names of the settings (a map) that are missing though required, or of a value that is not allowed, in the order of the rules."""

    def fault(name: str, rule: Rule) -> Column:
        value = F.try_element_at(settings, F.lit(name))
        missing = F.lit(rule[0]) & (F.coalesce(F.trim(value), F.lit("")) == "")
        return missing | (F.coalesce(value.isin(*rule[1]), F.lit(True)) == F.lit(False) if rule[1] else F.lit(False))

    return F.filter(F.array(*(F.when(fault(n, r), F.lit(n)) for n, r in rules.items())), lambda f: f.isNotNull())


def with_defaults(settings: Column, defaults: dict[str, str]) -> Column:
    """The settings over the defaults."""
    given = F.create_map(*[F.lit(x) for pair in defaults.items() for x in pair])
    return F.map_concat(F.map_filter(given, lambda k, v: ~F.map_contains_key(settings, k)), settings)
