"""Offsets and spans: lookups in page intervals, segments between marks, merged and complementary spans, sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_at(offsets: Column, at: Column) -> Column:
    """The number of page limits at or before an offset; no join is needed as the limits stand in the row."""
    return F.size(F.filter(offsets, lambda o: o <= at))


def segments(text: Column, offsets: Column) -> Column:
    """The pieces of a text between its marks, the one before the first included; marks outside the text are ignored."""
    inside = F.array_distinct(F.array_sort(F.filter(offsets, lambda o: (o > 0) & (o < F.length(text)))))
    starts = F.concat(F.array(F.lit(0).cast("bigint")), inside)
    return F.transform(starts, lambda s, i: F.substring(text, s.cast("int") + 1, (F.coalesce(F.get(starts, i + 1), F.length(text).cast("bigint")) - s).cast("int")))


def merged(spans: DataFrame, key: list[str]) -> DataFrame:
    """Overlapping or touching spans [start, end) of a key as one."""
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(before)
    fresh = (reach.isNull() | (F.col("start") > reach)).cast("int")
    upto = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    return spans.withColumn("_f", fresh).withColumn("_g", F.sum("_f").over(upto)).groupBy(*key, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_g")


def complement(spans: DataFrame, key: list[str], length: str) -> DataFrame:
    """What the spans of a key leave free of [0, length); ``spans`` carries the length."""
    whole = spans.groupBy(*key).agg(F.max(length).alias("_n"))
    m = merged(spans, key).join(whole, key)
    w = Window.partitionBy(*key).orderBy("start")
    gaps = m.select(*key, F.coalesce(F.lag("end").over(w), F.lit(0)).alias("start"), F.col("start").alias("end"))
    last = m.groupBy(*key).agg(F.max("end").alias("start"), F.max("_n").alias("end"))
    return gaps.unionByName(last).where("end > start")


def plausible_sequence(marks: Column, step: int = 5, first: int = 99) -> Column:
    """The footnote numbers that can follow the last one kept: up to ``step`` more, or a fresh start of at most ``step``."""
    empty = F.array().cast("array<int>")

    def take(kept: Column, m: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        ok = F.when(last.isNull(), m <= first).otherwise(((m > last) & (m <= last + step)) | (m <= step))
        return F.when(ok, F.concat(kept, F.array(m))).otherwise(kept)

    return F.aggregate(marks, empty, take)


def preceding(rows: DataFrame, marks: DataFrame, key: list[str], at: str, value: str, most: int) -> DataFrame:
    """``rows`` with the mark nearest before each, none older than the row before it and none further than ``most``."""
    a = rows.withColumn("_k", F.lit(1))
    b = marks.select(*key, at, F.col(value).alias("_v"), F.col(at).alias("_at")).withColumn("_k", F.lit(0))
    both = a.unionByName(b, allowMissingColumns=True)
    w = Window.partitionBy(*key).orderBy(at, "_k")
    block = F.coalesce(F.sum("_k").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    both = both.withColumn("_b", block)
    inside = Window.partitionBy(*key, "_b").orderBy(at, "_k").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_w", F.last("_v", ignorenulls=True).over(inside)).withColumn("_x", F.last("_at", ignorenulls=True).over(inside))
    near = F.col(at) - F.col("_x") <= most
    return out.where("_k = 1").withColumn(value, F.when(near, F.col("_w"))).drop("_k", "_v", "_at", "_b", "_w", "_x")
