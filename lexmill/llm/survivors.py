"""Problem 6: the best representative of each duplicate group.

Two parts. ``survivors`` picks one row a group by a fixed order of preference, with aggregates that combine partially, so
a group of any size is never gathered. ``true_values`` is the named method, a latent two-sided quality model: each source
has a sensitivity and a specificity, inferred by expectation-maximisation over its claims, and a field keeps every value
judged true. It runs over the distinct claim patterns with their weights, which are bounded by the patterns that occur,
whatever the number of groups; only how far the rates moved comes to the driver.

Defined cases: a null or unknown doctrine id makes no group with another; a null field of law equals a null one; null,
blank and filler values claim nothing; ties end at the smaller source_ref and old_id; repeated rows count once; empty
tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut

#: values that stand for nothing, in lower case
FILLERS = ("n/a", "na", "-", "--", "tbd", "none", "null", "unknown", "?", "n.a.", "todo", "...", ".")
TIERS = ("expertreviewed", "llmclassified", "uncurated")
STATUSES = ("promoted", "pending", "dismissed")


def squeezed(value: Column) -> Column:
    """Lower case, without spaces and underscores."""
    return F.regexp_replace(F.lower(value), r"[\s_ ]+", "")


def plain(value: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", "")


def described(value: Column) -> Column:
    """The trimmed description, null for nothing and for fillers."""
    text = F.regexp_replace(value, r"^\s+|\s+$", "")
    return F.when((text != "") & ~F.lower(text).isin(*FILLERS), text)


def _rank(value: Column, order: tuple[str, ...]) -> Column:
    rank = F.lit(len(order))
    for i, name in enumerate(order):
        rank = F.when(squeezed(value) == name, i).otherwise(rank)
    return rank


def anchor_groups(anchors: DataFrame, source_keywords: DataFrame) -> DataFrame:
    """The staged anchors with ``doctrine`` and ``field``, the texts of their keywords apart from case and punctuation."""
    texts = source_keywords.where("id is not null").groupBy("id").agg(F.min(plain(F.col("keyword_text"))).alias("word"))

    def joined(df: DataFrame, key: str, to: str) -> DataFrame:
        # an id that no keyword has is a keyword of its own
        word = texts.select(F.col("id").alias(key), F.col("word").alias("_w"))
        return df.join(word, key, "left").withColumn(to, F.coalesce("_w", F.concat(F.lit("#"), F.col(key)))).drop("_w")

    cols = ["source_ref", "old_id", "old_doctrine_keyword_id", "old_field_of_law_keyword_id", "description", "confidence_tier", "status", "last_reviewed_at"]
    rows = joined(joined(anchors.select(*cols), "old_doctrine_keyword_id", "doctrine"), "old_field_of_law_keyword_id", "field")
    return rows.where("doctrine is not null").withColumn("field", F.coalesce("field", F.lit("")))


def survivors(groups: DataFrame) -> DataFrame:
    """One row of each group (doctrine, field) of two or more distinct (source_ref, old_id), with its values."""
    order = F.struct(
        _rank(F.col("confidence_tier"), TIERS).alias("tier_rank"),
        _rank(F.col("status"), STATUSES).alias("status_rank"),
        F.coalesce(-F.unix_micros(F.col("last_reviewed_at").cast("timestamp")), F.lit(2**62)).alias("age"),
        (-F.length(F.coalesce(described(F.col("description")), F.lit("")))).alias("shortness"),
        "source_ref", "old_id", "description", "confidence_tier", "status", "last_reviewed_at",
    )
    members = groups.groupBy("doctrine", "field", "source_ref", "old_id").agg(F.min(order).alias("best"))
    best = members.groupBy("doctrine", "field").agg(F.count(F.lit(1)).alias("n_members"), F.min("best").alias("best")).where("n_members > 1")
    return best.select("doctrine", "field", "n_members", "best.*").drop("tier_rank", "status_rank", "age", "shortness")


def claims(groups: DataFrame) -> DataFrame:
    """(doctrine, field, attribute, value, source_ref): what each source says of a group, normalised and without repeats."""
    said = F.explode(
        F.array(
            F.struct(F.lit("confidence_tier").alias("attribute"), squeezed(F.col("confidence_tier")).alias("value")),
            F.struct(F.lit("status").alias("attribute"), squeezed(F.col("status")).alias("value")),
            F.struct(F.lit("description").alias("attribute"), described(F.col("description")).alias("value")),
        )
    )
    rows = groups.where("source_ref is not null").select("doctrine", "field", "source_ref", said.alias("c"))
    return rows.select("doctrine", "field", "c.attribute", "c.value", "source_ref").where("value is not null and value <> ''").distinct()


def true_values(said: DataFrame, rounds: int = 30, prior: float = 0.5, settled: float = 1e-4) -> DataFrame:
    """(doctrine, field, attribute, value, probability): each claimed value with the probability that it is true.

    A source that says something of a group's attribute, but not this value, claims against it. Each source has a
    sensitivity and a specificity for each attribute. The rounds end when no rate moves by ``settled``, after ``rounds`` at
    most. Rates stay in tables, whatever the number of sources.
    """
    per = ["doctrine", "field", "attribute"]
    speakers = said.groupBy(*per).agg(F.sort_array(F.collect_set("source_ref")).alias("speakers"))
    facts = said.groupBy(*per, "value").agg(F.sort_array(F.collect_set("source_ref")).alias("ayes")).join(speakers, per)
    facts = facts.withColumn("nays", F.array_except("speakers", "ayes"))
    facts = cut(facts.select(*per, "value", "ayes", "nays", F.xxhash64("attribute", "ayes", F.lit("|"), "nays").alias("pattern")))
    # groups that were claimed alike are judged alike
    patterns = facts.groupBy("pattern", "attribute").agg(F.first("ayes").alias("ayes"), F.first("nays").alias("nays"), F.count(F.lit(1)).cast("double").alias("weight"))
    vote = lambda aye: lambda s: F.struct(s.alias("s"), F.lit(aye).alias("aye"))
    votes = cut(patterns.select("pattern", "attribute", "weight", F.explode(F.concat(F.transform("ayes", vote(1.0)), F.transform("nays", vote(0.0)))).alias("v")).select("pattern", "attribute", "weight", "v.*"))
    quality = cut(votes.select("attribute", "s").distinct().select("*", F.lit(0.7).alias("a"), F.lit(0.7).alias("b")))

    def judged() -> DataFrame:
        a, b, aye = F.col("a"), F.col("b"), F.col("aye")
        odds = F.sum(F.when(aye == 1, F.log(a / (1 - b))).otherwise(F.log((1 - a) / b))) + F.log(F.lit(prior / (1 - prior)))
        return votes.join(quality, ["attribute", "s"]).groupBy("pattern").agg((1 / (1 + F.exp(-odds))).alias("probability"))

    p, w, aye = F.col("probability"), F.col("weight"), F.col("aye")
    # one pseudo-count of each kind keeps the rates inside (0, 1)
    rate = lambda yes, all_: F.least(F.lit(0.99), (F.sum(yes) + 1) / (F.sum(all_) + 2))
    for _ in range(rounds):
        new = votes.join(judged(), "pattern").groupBy("attribute", "s").agg(rate(w * p * aye, w * p).alias("a"), rate(w * (1 - p) * (1 - aye), w * (1 - p)).alias("b"))
        new = cut(new)
        both = new.alias("n").join(quality.alias("o"), ["attribute", "s"])
        moved = both.agg(F.max(F.greatest(F.abs(F.col("n.a") - F.col("o.a")), F.abs(F.col("n.b") - F.col("o.b"))))).first()[0]
        quality = new
        if moved is None or moved < settled:
            break
    return facts.join(judged(), "pattern").select(*per, "value", "probability")


def fused(groups: DataFrame) -> DataFrame:
    """(doctrine, field, attribute, kept, best): every value judged true (p >= 0.5), and the likeliest, field by field."""
    judged = true_values(claims(groups))
    return judged.groupBy("doctrine", "field", "attribute").agg(
        F.sort_array(F.collect_set(F.when(F.col("probability") >= 0.5, F.col("value")))).alias("kept"),
        F.max_by("value", F.struct("probability", "value")).alias("best"),
    )
