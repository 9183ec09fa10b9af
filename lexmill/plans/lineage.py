"""Cutting lineage and joining skewed rows in ways that survive lost executors."""

from __future__ import annotations

import gc
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where none is set, a session in one process gets a folder of its own, as in tests; on a cluster that is an error,
    since no folder of one machine would outlive it.
    """
    context = spark.sparkContext._jsc.sc()
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf and context.getCheckpointDir().isDefined():
        return context.getCheckpointDir().get()
    if not conf:
        if not context.isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = os.path.join(tempfile.gettempdir(), "lexmill-checkpoints")
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(conf)
    return conf


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df`` with its lineage replaced by files in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def let_go(spark: SparkSession) -> None:
    """Have the shuffle files that nothing refers to any more deleted now, not when the driver next happens to collect."""
    for _ in range(3):  # Python lets go of the JVM's objects in the background
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread, how: str = "inner", salts: int = 8) -> DataFrame:
    """Join where one key of ``big`` may hold a large share of its rows.

    ``spread`` is a column of ``big`` that varies within a key; each row of ``small`` is repeated ``salts`` times,
    so the rows of one key go to ``salts`` tasks. ``small`` has one row a key, or few.
    """
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


MOST_BROADCAST_ROWS = 200_000
MOST_BROADCAST_BYTES = 32_000_000


def sized(df: DataFrame, most: int = MOST_BROADCAST_ROWS, most_bytes: int = MOST_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows of ``most_bytes`` together, else as it is, for a shuffled join.

    Counted are the bytes of texts and binaries and 16 for any other column. Not more than ``most`` rows are looked at.
    """
    width = F.lit(0)
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) if kind in ("string", "binary") else F.lit(16))
    seen = df.limit(most + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if seen.n <= most and seen.bytes <= most_bytes else df
