"""Majority rosters, panel votes and the decisions made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ids import first_by


def roster(votes: DataFrame, name: str, option: str) -> DataFrame:
    """(name, option, n, confidence): each name's most frequent option, the lowest on a tie, and its share of the votes."""
    counts = votes.where(F.col(name).isNotNull() & F.col(option).isNotNull()).groupBy(name, option).agg(F.count(F.lit(1)).alias("c"))
    total = counts.groupBy(name).agg(F.sum("c").alias("n"))
    best = first_by(counts, [name], [F.desc("c"), F.col(option)])
    return best.join(total, name).select(name, option, "n", (F.col("c") / F.col("n")).alias("confidence"))


def panel_vote(panels: DataFrame, case: str, name: str, members: DataFrame, option: str, least_n: int = 3, least_confidence: float = 0.8) -> DataFrame:
    """(case, option, used, agree): the vote of a case's members that the roster is sure of."""
    sure = members.where((F.col("n") >= least_n) & (F.col("confidence") >= least_confidence)).select(name, option)
    counts = panels.select(case, name).distinct().join(sure, name).groupBy(case, option).agg(F.count(F.lit(1)).alias("c"))
    total = counts.groupBy(case).agg(F.sum("c").alias("used"))
    best = first_by(counts, [case], [F.desc("c"), F.col(option)])
    return best.join(total, case).select(case, option, "used", (F.col("c") == F.col("used")).alias("agree"))


def resolution(cases: DataFrame, signal_a: str, signal_b: str, prior: str) -> DataFrame:
    """``cases`` with the option resolved from two signals and a prior one, the source of it and whether they conflict."""
    a, b, p = F.col(signal_a), F.col(signal_b), F.col(prior)
    conflict = a.isNotNull() & b.isNotNull() & (a != b)
    source = F.when(conflict, "conflict").when(a.isNotNull() & b.isNotNull(), "both").when(a.isNotNull(), "first").when(b.isNotNull(), "second").when(p.isNotNull(), "prior").otherwise("none")
    chosen = F.when(conflict, p).otherwise(F.coalesce(a, b, p))
    grade = F.when(conflict, "CONFLICT").when(a.isNotNull() & b.isNotNull(), "HIGH").when(a.isNotNull() | b.isNotNull(), "MED").when(p.isNotNull(), "LOW").otherwise("NONE")
    return cases.withColumn("resolved", chosen).withColumn("resolved_by", source).withColumn("grade", grade)
