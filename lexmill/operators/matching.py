"""Matching index entries to cases by trigrams within a court and date."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import set_similarity, trigrams

# fixed values: the thresholds of a decision
FLOOR, MARGIN, NAME_MARGIN, TIE, TOP = 0.25, 0.10, 0.05, 0.001, 10


def candidates(entries: DataFrame, cases: DataFrame, block: list[str], top: int = TOP) -> DataFrame:
    """The best ``top`` cases of each entry within its block.

    entries(entry, name, block...), cases(case_id, name, abbreviation, n_cites, block...). Only equal blocks meet, and
    trigrams are made once a row before they do.
    """
    e = entries.select("entry", *block, trigrams(F.col("name")).alias("_e"))
    c = cases.select("case_id", "n_cites", *block, trigrams(F.col("name")).alias("_n"), trigrams(F.col("abbreviation")).alias("_a"))
    scored = e.join(c, block).select(
        "entry", "case_id", "n_cites", F.coalesce(set_similarity(F.col("_e"), F.col("_n")), F.lit(0.0)).alias("name_score"), F.coalesce(set_similarity(F.col("_e"), F.col("_a")), F.lit(0.0)).alias("abbr_score")
    )
    scored = scored.withColumn("best_score", F.greatest("name_score", "abbr_score"))
    place = F.row_number().over(Window.partitionBy("entry").orderBy(F.desc("best_score"), F.desc("name_score"), "case_id"))
    return scored.withColumn("place", place).where(F.col("place") <= top)


def decide(entries: DataFrame, found: DataFrame) -> DataFrame:
    """(entry, case_id, reason): the case meant, or why none is.

    A clear lead decides; of tied candidates (near the best in either score) the one with more citations, then a lead in
    the full name, then the lowest id. A leader alone below the margin is left to people.
    """
    w = Window.partitionBy("entry")
    at = lambda c, n: F.max(F.when(F.col("place") == n, F.col(c))).over(w)
    rows = found.select(
        "*", at("best_score", 1).alias("top"), at("best_score", 2).alias("second"), at("abbr_score", 1).alias("top_abbr"), at("name_score", 1).alias("top_name"),
        at("name_score", 2).alias("second_name"), at("case_id", 1).alias("top_id"),
    )
    tied = (F.abs(F.col("best_score") - F.col("top")) <= TIE) | (F.abs(F.col("abbr_score") - F.col("top_abbr")) <= TIE)
    rows = rows.withColumn("tied", tied)
    one = rows.groupBy("entry").agg(
        F.first("top").alias("top"), F.first("second").alias("second"), F.first("top_name").alias("top_name"), F.first("second_name").alias("second_name"), F.first("top_id").alias("top_id"),
        F.count_if("tied").alias("n_tied"), F.max(F.when(F.col("tied"), F.col("n_cites"))).alias("most"), F.min(F.when(F.col("tied"), F.col("n_cites"))).alias("fewest"),
        F.min(F.when(F.col("tied"), F.col("case_id"))).alias("lowest"),
        F.min(F.when(F.col("tied"), F.struct((-F.col("n_cites")).alias("c"), "case_id"))).alias("rich"),
    )
    margin = F.col("top") - F.coalesce("second", F.lit(0.0))
    name_margin = F.col("top_name") - F.coalesce("second_name", F.lit(0.0))
    reason = (
        F.when(F.col("top").isNull(), "no_candidates").when(F.col("top") < FLOOR, "below_floor").when(margin >= MARGIN, "decisive_margin").when(F.col("n_tied") == 1, "low_confidence")
        .when(F.col("most") > F.col("fewest"), "richness").when(name_margin >= NAME_MARGIN, "name_score").otherwise("lowest_id")
    )
    chosen = entries.select("entry").distinct().join(one, "entry", "left").withColumn("reason", reason)
    case = F.when(F.col("reason").isin("decisive_margin", "name_score"), F.col("top_id")).when(F.col("reason") == "richness", F.col("rich.case_id")).when(F.col("reason") == "lowest_id", F.col("lowest"))
    return chosen.select("entry", case.alias("case_id"), "reason")
