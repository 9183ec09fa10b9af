"""As-of, interval, run-length and carry-forward operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_intervals(rows: DataFrame, key: list[str], start: str, tie: str) -> DataFrame:
    """Each version's validity [start, next start); the last is open (null)."""
    return rows.withColumn("valid_to", F.lead(start).over(Window.partitionBy(*key).orderBy(start, tie)))


def version_at(rows: DataFrame, key: list[str], when: Column, start: str, end: str, tie: str) -> DataFrame:
    """The version of each key that holds at ``when``, the latest if several do."""
    held = rows.where((F.col(start) <= when) & (F.col(end).isNull() | (F.col(end) > when)))
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(start), F.desc(tie)))
    return held.withColumn("_p", place).where("_p = 1").drop("_p")


def asof_backward(left: DataFrame, right: DataFrame, key: list[str], at: str, value: str, strict: bool = False) -> DataFrame:
    """``left`` with the last ``value`` of ``right`` at or before (strict: before) each row, by one pass over both.

    The two are put together and the value is carried forward, so no row meets more than its predecessor; a hot key is
    sorted with spilling and not gathered.
    """
    a = left.withColumn("_side", F.lit(1))
    b = right.select(*key, at, F.col(value).alias("_value")).withColumn("_side", F.lit(2 if strict else 0))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(f"last_{value}", F.last("_value", ignorenulls=True).over(w)).where("_side = 1").drop("_side", "_value")


def interval_lookup(rows: DataFrame, spans: DataFrame, key: str, at: str, take: str) -> DataFrame:
    """``rows`` with ``take`` of the first span (by its order) of their key that holds ``at``; null bounds are open."""
    s = spans.select(key, "start", "end", "entry", F.col(take).alias(f"_{take}"))
    hits = rows.join(s, key).where(
        (F.col("start").isNull() | (F.col("start") <= F.col(at))) & (F.col("end").isNull() | (F.col("end") >= F.col(at)))
    )
    first = hits.groupBy(*rows.columns).agg(F.min_by(f"_{take}", "entry").alias(take))
    return rows.join(first, rows.columns, "left")


def runs(rows: DataFrame, key: list[str], order: list[str], state: str) -> DataFrame:
    """Maximal runs of equal ``state`` in order: (key, run, state, first, last, n)."""
    w = Window.partitionBy(*key).orderBy(*order)
    changed = ~F.col(state).eqNullSafe(F.lag(state).over(w)) | (F.row_number().over(w) == 1)
    numbered = rows.withColumn("_c", changed.cast("int")).withColumn("run", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "run").agg(F.first(state).alias(state), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count(F.lit(1)).alias("n"))


def carried(rows: DataFrame, key: list[str], order: list[str], column: str) -> DataFrame:
    """``rows`` with ``column`` carried forward over nulls, and ``banner`` where it changes."""
    w = Window.partitionBy(*key).orderBy(*order)
    out = rows.withColumn("carried", F.last(column, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("banner", F.col("carried").isNotNull() & ~F.col("carried").eqNullSafe(F.lag("carried").over(w)))


def boundaries(rows: DataFrame, key: list[str], start: str, cap: str) -> DataFrame:
    """Ranges from each start to before the next, within ``cap`` and never before the start."""
    after = F.lead(start).over(Window.partitionBy(*key).orderBy(start)) - 1
    return rows.withColumn("end", F.greatest(F.least(F.coalesce(after, F.col(cap)), F.col(cap)), F.col(start)))


def spaced(offsets: Column, gap: int) -> Column:
    """The offsets that stand ``gap`` or more after the last one kept, in order."""
    empty = F.array().cast("array<bigint>")
    keep = lambda acc, x: F.when((F.size(acc) == 0) | (x - F.try_element_at(acc, F.lit(-1)) >= gap), F.concat(acc, F.array(x))).otherwise(acc)
    return F.aggregate(F.array_sort(offsets), empty, keep)
