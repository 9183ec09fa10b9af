"""Writers: documents, records a line, tables of updates and rendered sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def case_documents(cases: DataFrame, citations: DataFrame, opinions: DataFrame) -> DataFrame:
    """(id, document): one JSON document a case with its citations and opinions in order."""
    c = citations.groupBy(F.col("case_id").alias("id")).agg(F.sort_array(F.collect_set(F.struct("cite", "citation_type"))).alias("citations"))
    o = opinions.groupBy(F.col("case_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("opinion_index", "opinion_type", "author", "text"))).alias("opinions"))
    rows = cases.join(c, "id", "left").join(o, "id", "left")
    return rows.select("id", F.to_json(F.struct(*(x for x in cases.columns), "citations", "opinions")).alias("document"))


def valid_records(records: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """The records whose required fields are all filled, and how many lack each."""
    lacks = {c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in required}
    bad = F.lit(False)
    for c in lacks.values():
        bad = bad | c
    return records.where(~bad), records.agg(*(F.count_if(c).alias(f"lacks_{n}") for n, c in lacks.items()))


def write_lines(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A JSON record a line, in as many files as there are partitions."""
    records.write.mode(mode).json(path)


def write_csv(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).csv(path, header=True)


def write_partitioned(rows: DataFrame, path: str, by: list[str], replace_only: bool = True) -> None:
    """Parquet by partition; replace_only: partitions that ``rows`` lacks stay as they are."""
    writer = rows.write.mode("overwrite").partitionBy(*by)
    (writer.option("partitionOverwriteMode", "dynamic") if replace_only else writer).parquet(path)


def markdown(units: DataFrame, key: str, order: list[str], level: Column, title: Column, body: Column) -> DataFrame:
    """(key, text): the units of each key as headings by level with their text."""
    piece = F.concat(F.repeat(F.lit("#"), F.least(F.greatest(level, F.lit(1)), F.lit(6))), F.lit(" "), title, F.when(F.coalesce(body, F.lit("")) != "", F.concat(F.lit("\n\n"), body)).otherwise(""))
    rows = units.select(key, *order, piece.alias("_piece"))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "_piece"))), lambda x: x["_piece"]), "\n\n").alias("text"))
