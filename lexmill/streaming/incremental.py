"""Incremental runs: what is new since the last time, once, with a checkpoint; event-time counts over a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import checkpoint_dir
from ..sources.tables import reachable


def run_new(spark: SparkSession, path: str, schema: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, glob: str = "*.parquet") -> None:
    """Apply ``step`` to the files that came to ``path`` since the last run and append the result; then end."""
    reachable(spark)
    rows = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(path)
    step(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, ts: str, by: list[str], length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window start, by..., n) of a stream or a table; events later than ``late`` are left out of a stream."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    rows = rows.withWatermark("_ts", late) if events.isStreaming else rows
    return rows.groupBy(F.window("_ts", length).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), *by, "n")


def drained(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """All that a stream aggregate holds once its input is used up, by way of files in the shared folder."""
    import uuid

    base = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def save(rows: DataFrame, _: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/out")

    stream.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def once_each(events: DataFrame, key: list[str], ts: str, late: str = "1 hour") -> DataFrame:
    """The first of each key; in a stream, among the events of ``late`` time."""
    if events.isStreaming:
        return events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).dropDuplicatesWithinWatermark(key).drop("_ts")
    row = F.struct(*events.columns)
    # of rows of one time, the least
    first = events.where(F.col(ts).isNotNull()).groupBy(*key).agg(F.min_by(row, F.struct(ts, row)).alias("_row"))
    undated = events.where(F.col(ts).isNull()).groupBy(*key).agg(F.min(row).alias("_row"))
    same = [first[k].eqNullSafe(undated[k]) for k in key]
    return first.select("_row.*").unionByName(undated.join(first, same, "left_anti").select("_row.*"))
