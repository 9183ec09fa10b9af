"""Problem 4: references to records that do not exist.

Method: the sorted integer parent keys are compressed into contiguous runs; each distinct reference key is as-of matched
to the run that starts before it and is an orphan if it lies beyond that run's end.

Keys are cut into ranges of ``width``, and a run is cut at the border of a range, so that every range is one bounded
window task: it holds at most ``width`` parent keys and ``width`` distinct reference keys, whatever the size of the
tables. References are reduced to distinct keys before anything is moved, so a key that a third of all rows refer to
is one row there; the way back to the referring rows is salted.

Defined cases: a null key is no reference; an empty parent table makes every reference an orphan; an empty child table
gives no rows; repeated rows count once; a referring row without created_at is never late; a parent whose created_at are
all null is never the later one. Only the named columns are read, so that extra columns, whatever their names, do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import salted_join

WIDTH = 65536


def _range_of(key: Column, width: int) -> Column:
    return F.floor(key / F.lit(width))


def key_runs(parents: DataFrame, key: str = "key", width: int = WIDTH) -> DataFrame:
    """(range, first, last) of each maximal run of consecutive keys; a run is cut at the borders of ``width``."""
    keys = parents.select(F.col(key).cast("long").alias("k")).where("k is not null").distinct()
    keys = keys.withColumn("range", _range_of(F.col("k"), width))
    place = F.row_number().over(Window.partitionBy("range").orderBy("k"))
    return (
        keys.withColumn("island", F.col("k") - place)
        .groupBy("range", "island")
        .agg(F.min("k").alias("first"), F.max("k").alias("last"))
        .drop("island")
    )


def orphan_keys(refs: DataFrame, parents: DataFrame, key: str = "key", width: int = WIDTH) -> DataFrame:
    """The distinct keys of ``refs`` that no row of ``parents`` has, as column ``key``."""
    keys = refs.select(F.col(key).cast("long").alias("at")).where("at is not null").distinct()
    runs = key_runs(parents, key, width).select("range", F.col("first").alias("at"), F.lit(0).alias("kind"), "last")
    both = runs.unionByName(
        keys.select(_range_of(F.col("at"), width).alias("range"), "at", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("last"))
    )
    before = Window.partitionBy("range").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.last("last", ignorenulls=True).over(before)
    return both.withColumn("reach", reach).where("kind = 1 and (reach is null or at > reach)").select(F.col("at").alias(key))


def broken_references(refs: DataFrame, parents: DataFrame, removed: DataFrame) -> DataFrame:
    """Every reference whose target is missing, removed or later.

    refs(table_name, row_id, ref_id, created_at), parents(key, created_at), removed(key) ->
    (table_name, row_id, ref_id, reason, created_at). reason: ``late`` if the target's earliest created_at is after the
    referring row's, else ``deleted`` if ``removed`` names the missing key, else ``absent``.
    """
    refs = refs.where("ref_id is not null")
    asked = refs.groupBy(F.col("ref_id").alias("key")).agg(F.min("created_at").alias("earliest"))
    missing = orphan_keys(asked, parents)
    gone = removed.select(F.col("key").cast("long").alias("key"), F.lit(True).alias("gone")).where("key is not null").distinct()
    missing = missing.join(gone, "key", "left").select(
        "key", F.when(F.col("gone"), "deleted").otherwise("absent").alias("reason"), F.lit(None).cast("timestamp_ntz").alias("born")
    )
    born = parents.where("key is not null").groupBy(F.col("key").cast("long").alias("key")).agg(F.min("created_at").alias("born"))
    late = asked.join(born, "key").where("born > earliest").select("key", F.lit("late").alias("reason"), "born")
    faults = missing.unionByName(late).withColumnRenamed("key", "ref_id")
    return (
        salted_join(refs, faults, ["ref_id"], F.col("row_id"))
        .where("reason <> 'late' or born > created_at")
        .select("table_name", "row_id", "ref_id", "reason", "created_at")
        .distinct()
    )


def references(opinions: DataFrame, citations: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The references to cases and those to case_citations, each as (table_name, row_id, ref_id, created_at)."""

    def of(df: DataFrame, name: str, ref: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("table_name"), F.col("id").cast("long").alias("row_id"), ref.alias("ref_id"), "created_at"
        ).withColumn("ref_id", F.col("ref_id").cast("long"))

    to_cases = of(opinions, "opinions", F.col("case_id")).unionByName(
        of(citations, "case_citations", F.explode(F.array_distinct("cited_case_ids")))
    )
    return to_cases, of(corrections, "citation_corrections", F.col("citation_id"))


def all_broken_references(cases: DataFrame, opinions: DataFrame, citations: DataFrame, corrections: DataFrame, deleted: DataFrame) -> DataFrame:
    """``broken_references`` of the legal tables: opinions and case_citations to cases, corrections to case_citations."""
    to_cases, to_citations = references(opinions, citations, corrections)

    def parent(df: DataFrame) -> DataFrame:
        return df.select(F.col("id").cast("long").alias("key"), "created_at")

    def removed(name: str) -> DataFrame:
        return deleted.where(F.col("table_name") == name).select(F.col("record_id").alias("key"))

    return broken_references(to_cases, parent(cases), removed("cases")).unionByName(
        broken_references(to_citations, parent(citations), removed("case_citations"))
    )


def orphan_report(broken: DataFrame) -> DataFrame:
    """Counts of broken references by table, month of created_at (null: unknown) and reason."""
    return broken.groupBy("table_name", F.date_format("created_at", "yyyy-MM").alias("month"), "reason").agg(
        F.count(F.lit(1)).alias("n_refs"), F.countDistinct("row_id").alias("n_rows")
    )
