"""Problem 3: mapping freely typed values to a canonical list.

Method: values are deduplicated and normalised, candidates are retrieved through an inverted index of character n-grams
(of two and three letters, whatever their order, since swapped letters are the commonest slip), scored by cosine under idf
weights, and accepted above a threshold and with a margin over the next entry. An exact check of the edit distance to the
entry's forms follows, for titles that share a whole word and nothing else.

Only a value's rarest n-grams are looked up: those beyond which what is left could not reach the threshold (the cosine of
a pair that shares none of them is at most the root of the rest of the value's weight).

Normalising takes off what introduces a value ("see", "cited as", "["), repairs digits read for letters, reads the series
("2d", "Second Series", "third") into a column of its own and drops the generic words of a title ("Reports", "Rpts").
A value and a form of an entry are compared only within the same series. Everything is done on distinct normalised
values, so a value that fills a third of all rows is scored once; only the way back to the rows is salted.

Defined cases: null and blank values, and those that are a canonical name or alias character by character, take no part;
a value without a letter stands for no entry (0); if two entries come within ``margin``, none is taken; the same entry's
own forms do not compete. An empty reference list gives 0 for every value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut, salted_join

THRESHOLD = 0.3
LIKENESS = 0.48
MARGIN = 0.02
#: the weight of an n-gram of no form, as a share of that of the rarest
UNSEEN = 0.5
LEADS = r"^[\[\(\"' ]*((see also|see|cited as|cited in|quoted in|quoting|citing|cf\.?|accord|but see|in|the|from|at) +)*"
SECOND = r"[\s,.\-(]*\b(second series|second|2nd series|2d series|2nd|2d|ii)\b[\s.,)]*$"
THIRD = r"[\s,.\-(]*\b(third series|third|3rd series|3d series|3rd|3d|iii)\b[\s.,)]*$"
GENERIC = r"\b(reports|reporter|reporters|report|rpts|rpt|reps|rep)\b"


def normalised(value: Column) -> tuple[Column, Column]:
    """The letters of ``value`` without introduction, series and generic words, and its series (1, 2 or 3)."""
    v = F.regexp_replace(F.lower(F.trim(value)), r"[\s ]+", " ")
    v = F.regexp_replace(v, LEADS, "")
    v = F.regexp_replace(v, r"(?<=[a-z])0|0(?=[a-z])", "o")
    v = F.regexp_replace(v, r"(?<=[a-z])1(?=[a-z])", "l")
    v = F.regexp_replace(v, r"(?<=[a-z])5(?=[a-z])", "s")
    v = F.regexp_replace(v, r"[, ]*\b1[5-9]\d\d\b|[, ]*\b20\d\d\b", "")
    v = F.regexp_replace(v, r"(?<=[a-z])(?=[23](n?d|rd)\b)", " ")
    series = F.when(v.rlike(SECOND), 2).when(v.rlike(THIRD), 3).otherwise(1)
    base = F.regexp_replace(F.regexp_replace(v, SECOND, ""), THIRD, "")
    base = F.regexp_replace(base, r"[^a-z ]+", " ")
    bare = F.regexp_replace(F.regexp_replace(base, GENERIC, " "), r" +", "")
    return F.when(bare == "", F.regexp_replace(base, r" +", "")).otherwise(bare), series


def grams(word: Column) -> Column:
    """The distinct pairs and triples of neighbouring letters of ``word`` between end marks, each in the alphabet's order."""
    w = F.concat(F.lit("^"), word, F.lit("$"))

    def runs(n: int) -> Column:
        starts = F.when(F.length(w) >= n, F.sequence(F.lit(1), F.length(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.array_sort(F.split(F.substring(w, i, F.lit(n)), "")), ""))

    return F.array_distinct(F.concat(runs(2), runs(3)))


def reference_forms(reporters: DataFrame) -> DataFrame:
    """(entry, base, series): the distinct normalised forms of each entry's canonical name, aliases and full title."""
    written = reporters.select(
        F.col("reporter_id").alias("entry"),
        F.explode(F.array_union(F.array("canonical", "notes"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("form"),
    ).where("form is not null and trim(form) <> ''")
    base, series = normalised(F.col("form"))
    return written.select("entry", base.alias("base"), series.alias("series")).where("base <> ''").distinct()


def resolve(values: DataFrame, forms: DataFrame, threshold: float = THRESHOLD, likeness: float = LIKENESS, margin: float = MARGIN) -> DataFrame:
    """values(base, series), distinct -> (base, series, entry, score): the entry meant, 0 if none is.

    score is the greatest cosine to a form of the entry; a form equal to the value scores 1.
    """
    n_forms = F.broadcast(forms.select("base").distinct().agg(F.count(F.lit(1)).alias("n_forms")))
    each = forms.withColumn("gram", F.explode(grams(F.col("base"))))
    weight = (
        each.select("base", "gram").distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("df")).join(n_forms)
        .select("gram", F.pow(F.log((F.col("n_forms") + 1.0) / (F.col("df") + 0.5)), 2).alias("w2"))
    )
    index = each.join(weight, "gram").select("gram", "series", "entry", F.col("base").alias("form"), "w2")
    ref = index.groupBy("entry", "form", "series").agg(F.collect_set("gram").alias("form_grams"), F.sum("w2").alias("ref_norm"))
    unseen = F.pow(UNSEEN * F.log((F.col("n_forms") + 1.0) / 0.5), 2)
    value = ["base", "series"]
    asked = values.where("base <> ''").withColumn("gram", F.explode(grams(F.col("base")))).join(weight, "gram", "left").join(n_forms)
    asked = asked.select(*value, "gram", F.coalesce("w2", unseen).alias("w2"))
    own = asked.groupBy(*value).agg(F.map_from_entries(F.collect_list(F.struct("gram", "w2"))).alias("weights"), F.sum("w2").alias("own_norm"))
    by_value = Window.partitionBy(*value)
    left = F.sum("w2").over(by_value.orderBy("w2", "gram").rowsBetween(Window.unboundedPreceding, 0))
    looked_up = asked.withColumn("left", left).withColumn("own_norm", F.sum("w2").over(by_value)).where(F.col("left") >= threshold**2 * F.col("own_norm"))
    met = looked_up.select("gram", *value).join(index.select("gram", "series", "entry", "form"), ["gram", "series"]).select(*value, "entry", "form").distinct()
    dot = F.aggregate(F.array_intersect(F.map_keys("weights"), "form_grams"), F.lit(0.0), lambda total, g: total + F.col("weights")[g])
    scored = (
        met.join(own, value).join(ref, ["entry", "form", "series"])
        .withColumn("cosine", F.when(F.col("base") == F.col("form"), 1.0).otherwise(dot / F.sqrt(F.col("ref_norm") * F.col("own_norm"))))
        .where(F.col("cosine") >= threshold)
        .withColumn("alike", 1 - F.levenshtein("base", "form") / F.greatest(F.length("base"), F.length("form")))
        .groupBy(*value, "entry").agg(F.max("cosine").alias("score"), F.max("alike").alias("alike"))
    )
    rank = by_value.orderBy(F.desc("score"), "entry")
    best = (
        scored.withColumn("next", F.lead("score").over(rank)).withColumn("place", F.row_number().over(rank)).where("place = 1")
        .where((F.col("score") - F.coalesce("next", F.lit(0.0)) >= margin) & (F.col("alike") >= likeness))
    )
    return values.join(best.select(*value, "entry", "score"), value, "left").select(*value, F.coalesce("entry", F.lit(0)).alias("entry"), "score")


def resolved_rows(rows: DataFrame, reporters: DataFrame) -> DataFrame:
    """rows(table_name, row_id, value) -> (table_name, row_id, value, reporter_id, score) of the freely typed values."""
    listed = reporters.select(
        F.explode(F.array_union(F.array("canonical"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("value")
    ).distinct()
    free = rows.where("value is not null and trim(value) <> ''").join(listed, "value", "left_anti")
    base, series = normalised(F.col("value"))
    # a file of many rows holds few values: they are deduplicated before and after they are normalised
    spelt = cut(free.select("value").distinct().select("value", base.alias("base"), series.alias("series")))
    found = resolve(spelt.select("base", "series").distinct(), reference_forms(reporters))
    by_value = spelt.join(found, ["base", "series"]).select("value", F.col("entry").alias("reporter_id"), "score")
    return salted_join(free, by_value, ["value"], F.col("row_id"))


def reporter_rows(citations: DataFrame, corrections: DataFrame) -> DataFrame:
    """The typed reporters as rows(table_name, row_id, value)."""
    return citations.select(F.lit("case_citations").alias("table_name"), F.col("id").cast("long").alias("row_id"), F.col("reporter").alias("value")).unionByName(
        corrections.select(
            F.lit("citation_corrections").alias("table_name"), F.col("id").cast("long").alias("row_id"), F.col("observed_reporter").alias("value")
        )
    )
