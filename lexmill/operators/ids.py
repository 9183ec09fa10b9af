"""Dense deterministic ids without a single-task sort, and remap tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut


def dense_ids(rows: DataFrame, order: list[str], to: str = "new_id", start: int = 1) -> DataFrame:
    """``rows`` with ids 1, 2, ... in the order of ``order``, which must be unique.

    A range partitioning sorts in parallel; each partition numbers its own rows and adds the count of those before it,
    which is one small row a partition.
    """
    ranged = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        ranged.withColumn("_in", inside)
        .join(F.broadcast(offsets), "_part")
        .withColumn(to, (F.col("_in") + F.col("_before") + (start - 1)).cast("long"))
        .drop("_part", "_in", "_before")
    )


def tree_depths(nodes: DataFrame, most_rounds: int = 40) -> DataFrame:
    """nodes(id, parent), ids unique -> (id, depth): 0 for a node whose parent is null or missing, null for one in or under a cycle.

    Each node points to an ancestor, and each round to that one's: the way doubles, so a tree of depth n takes log n joins.
    """
    known = nodes.select(F.col("id").alias("parent"), F.lit(True).alias("_known"))
    rows = nodes.join(known, "parent", "left").select("id", F.when(F.col("_known"), F.col("parent")).alias("up"), F.when(F.col("_known"), 1).otherwise(0).cast("long").alias("depth"))
    rows = cut(rows)
    for _ in range(most_rounds):
        if rows.where("up is not null").isEmpty():
            break
        above = rows.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        rows = cut(rows.join(above, "up", "left").select("id", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")))
    return rows.select("id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def first_by(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row of each key, the first by ``order``."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def remap(rows: DataFrame, source: str = "source_ref", old: str = "id") -> DataFrame:
    """(source_ref, old_id, new_id) of the distinct source rows."""
    return dense_ids(rows.select(F.col(source).alias("source_ref"), F.col(old).alias("old_id")).distinct(), ["source_ref", "old_id"])
