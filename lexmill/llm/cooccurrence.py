"""Problem 2: items that appear together.

Method: basket collapsing. Each record's items are deduplicated into arrays, identical baskets are grouped into one with
a weight, pairs are enumerated once in each distinct basket and the weights are summed.

Items are of two sides (here: fields of law, and doctrines or concepts), and pairs are made between the sides. A basket
holds distinct items only, so its size is bounded by the number of items, however many rows a record has; the sets are
built partially before the shuffle.

Defined cases: rows without a basket are dropped, rows without an item or with an item of neither side make their basket
count in N and nothing else; repeated rows count once; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapsed_baskets(rows: DataFrame) -> DataFrame:
    """rows(basket, item, side 0 or 1 or null) -> (left, right, weight): the distinct pairs of sorted item arrays."""
    sets = rows.where("basket is not null").groupBy("basket").agg(
        F.sort_array(F.collect_set(F.when(F.col("side") == 0, F.col("item")))).alias("left"),
        F.sort_array(F.collect_set(F.when(F.col("side") == 1, F.col("item")))).alias("right"),
    )
    return sets.groupBy("left", "right").agg(F.count(F.lit(1)).alias("weight"))


def pair_scores(rows: DataFrame) -> DataFrame:
    """(left, right, together, n_left, n_right, n, lift, conviction) of every pair that occurs together.

    lift is together * n / (n_left * n_right); conviction (null if right never fails left) is
    (1 - n_right / n) / (1 - together / n_left).
    """
    baskets = collapsed_baskets(rows)
    counts = (
        baskets.select(F.explode(F.array_union("left", "right")).alias("item"), "weight").groupBy("item").agg(F.sum("weight").alias("n_item"))
    )
    total = baskets.agg(F.sum("weight").alias("n"))
    pairs = (
        baskets.where("size(left) > 0 and size(right) > 0")
        .select(F.explode("left").alias("left"), "right", "weight")
        .select("left", F.explode("right").alias("right"), "weight")
        .groupBy("left", "right")
        .agg(F.sum("weight").alias("together"))
    )
    out = (
        pairs.join(counts.select(F.col("item").alias("left"), F.col("n_item").alias("n_left")), "left")
        .join(counts.select(F.col("item").alias("right"), F.col("n_item").alias("n_right")), "right")
        .join(F.broadcast(total))  # one row
    )
    return out.select(
        "left", "right", "together", "n_left", "n_right", "n",
        (F.col("together") * F.col("n") / (F.col("n_left") * F.col("n_right")).cast("double")).alias("lift"),
        F.when(
            F.col("together") < F.col("n_left"),
            (1 - F.col("n_right") / F.col("n")) / (1 - F.col("together") / F.col("n_left")),
        ).alias("conviction"),
    )


def keyword_rows(opinion_keywords: DataFrame, keywords: DataFrame) -> DataFrame:
    """The assignments as rows(basket, item, side): side 0 for tier field_of_law, 1 for any other tier, else null."""
    tiers = keywords.where("id is not null").groupBy(F.col("id").alias("item")).agg(
        F.min(F.when(F.col("tier") == "field_of_law", 0).when(F.col("tier").isNotNull(), 1)).alias("side")
    )
    rows = opinion_keywords.select(F.col("opinion_curie").alias("basket"), F.col("keyword_id").alias("item"))
    return rows.join(tiers, "item", "left")


def strong_pairs(scores: DataFrame, least: int = 4, times: int = 3) -> DataFrame:
    """Pairs together in ``least`` baskets or more and ``times`` as often as expected; integers only, so no rounding."""
    return scores.where(
        (F.col("together") >= least) & (F.col("together") * F.col("n") >= times * F.col("n_left") * F.col("n_right"))
    )
