"""Keyword, hybrid and related search over opinions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_row_each(df: DataFrame, key: str, *cols: str) -> DataFrame:
    """``key`` and the columns of its least row, nulls last: repeated deliveries become one that there was."""
    order = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    row = F.min_by(F.struct(*cols), F.struct(*(x.alias(f"o{i}") for i, x in enumerate(order))))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(row.alias("_row")).select(key, "_row.*")


class Corpus:
    """The tables a search reads, each cut to the columns it needs."""

    def __init__(self, keywords: DataFrame, assignments: DataFrame, opinions: DataFrame, cases: DataFrame, paragraphs: DataFrame):
        self.keywords = keywords.select(F.col("id").alias("keyword_id"), "keyword_text", "tier", "frequency")
        self.assignments = assignments.select("keyword_id", "opinion_curie", "relevance_score", "category", "status").distinct()
        self.opinions = one_row_each(opinions, "id", "case_id", "curie").withColumnRenamed("id", "opinion_id")
        self.cases = one_row_each(cases, "id", "name").select(F.col("id").alias("case_id"), F.col("name").alias("case_name"))
        self.paragraphs = paragraphs.select("id", "opinion_id", "raw_text").distinct()

    def tagged(self, terms: list[str], least: float = 0.0) -> DataFrame:
        """Assignments of the terms: one row an opinion, keyword and score."""
        hits = self.keywords.where(F.col("keyword_text").isin(terms)).join(self.assignments.where(F.col("relevance_score") >= least), "keyword_id")
        return hits.join(self.opinions, hits.opinion_curie == self.opinions.curie).join(self.cases, "case_id")


def mentions(text: Column, terms: list[str]) -> Column:
    """Whether the text holds any term, whatever its case; % and _ in a term are wildcards."""
    return reduce(lambda a, b: a | b, (F.ilike(text, F.lit(f"%{t}%")) for t in terms), F.lit(False))


def _keyword_side(c: Corpus, terms: list[str], least: float, every: bool) -> DataFrame:
    hits = c.tagged(terms, least).groupBy("opinion_id", "case_id", "case_name").agg(
        F.sum("relevance_score").alias("k_score"),
        F.sort_array(F.collect_set("keyword_text")).alias("k_words"),
        F.countDistinct("keyword_id").alias("k_count"),
        F.countDistinct("keyword_text").alias("k_texts"),
    )
    return hits.where(F.col("k_texts") == len(set(terms))).drop("k_texts") if every else hits.drop("k_texts")


def _text_side(c: Corpus, terms: list[str], strategy: str, scale: float, base: float) -> DataFrame:
    """Paragraph hits an opinion. For ``all``, every paragraph counts once each term stands somewhere in the opinion."""
    paragraphs = c.paragraphs.where("opinion_id is not null")
    if strategy == "all":
        flags = [F.max(F.coalesce(F.ilike("raw_text", F.lit(f"%{t}%")), F.lit(False))).alias(f"_t{i}") for i, t in enumerate(terms)]
        hits = paragraphs.groupBy("opinion_id").agg(F.countDistinct("id").alias("n"), *flags)
        hits = hits.where(" and ".join(f"_t{i}" for i in range(len(terms)))).select("opinion_id", "n")
    else:
        hits = paragraphs.where(mentions(F.col("raw_text"), terms)).groupBy("opinion_id").agg(F.countDistinct("id").alias("n"))
    score = F.least(F.col("n") / F.lit(scale) + F.lit(base), F.lit(1.0))
    return hits.join(c.opinions, "opinion_id").join(c.cases, "case_id").select(
        F.col("opinion_id").alias("t_opinion"), F.col("case_id").alias("t_case"), F.col("case_name").alias("t_name"), score.alias("t_score"), F.col("n").alias("t_matches")
    )


def hybrid_search(c: Corpus, terms: list[str], strategy: str = "any", least: float = 0.5, limit: int | None = 50, text: bool = True, dates: DataFrame | None = None) -> DataFrame:
    """Opinions by keyword and text hits, best first; limit None gives all.

    dates(case_id, decision_date): then the latest come first, undated ones last, and relevance breaks ties.

    strategy ``any``: any term; ``all``: every term, by keywords or by text; ``phrase``: the terms joined, text only.
    """
    order = [F.desc("total_relevance"), F.desc("text_matches"), F.col("opinion_id")]
    if strategy == "phrase":
        phrase = " ".join(terms)
        found = _text_side(c, [phrase], "any", 5.0, 0.7).select(
            F.col("t_opinion").alias("opinion_id"), F.col("t_case").alias("case_id"), F.col("t_name").alias("case_name"), F.col("t_score").alias("total_relevance"),
            F.array(F.lit(phrase)).alias("matching_keywords"), F.lit(1).cast("long").alias("keyword_count"), F.col("t_matches").alias("text_matches"), F.lit("text").alias("search_source"),
        )
    elif strategy in ("any", "all"):
        k = _keyword_side(c, terms, least, strategy == "all")
        t = _text_side(c, terms, strategy, 10.0, 0.5).where(F.lit(text))
        both = k.join(t, k.opinion_id == t.t_opinion, "full")
        found = both.select(
            F.coalesce("opinion_id", "t_opinion").alias("opinion_id"), F.coalesce("case_id", "t_case").alias("case_id"), F.coalesce("case_name", "t_name").alias("case_name"),
            (F.coalesce("k_score", F.lit(0.0)) + F.coalesce("t_score", F.lit(0.0))).alias("total_relevance"),
            F.coalesce("k_words", F.array(*map(F.lit, terms))).alias("matching_keywords"), F.coalesce("k_count", F.lit(len(terms)).cast("long")).alias("keyword_count"),
            F.coalesce("t_matches", F.lit(0).cast("long")).alias("text_matches"),
            F.when(F.col("opinion_id").isNotNull() & F.col("t_opinion").isNotNull(), "both").when(F.col("opinion_id").isNotNull(), "keyword").otherwise("text").alias("search_source"),
        )
    else:
        raise ValueError(f"no strategy {strategy!r}")
    # ranks that differ only in the last bits of a sum are ties
    found = found.withColumn("total_relevance", F.round("total_relevance", 6))
    if dates is not None:
        found, order = found.join(dates, "case_id", "left"), [F.desc_nulls_last("decision_date"), *order]
    return found.orderBy(*order).limit(limit) if limit is not None else found


def rarity_search(c: Corpus, terms: list[str]) -> DataFrame:
    """Any-term search where a hit counts its relevance over the keyword's frequency, times log10 of the terms matched."""
    hits = c.tagged(terms).withColumn("match", F.col("relevance_score") / F.greatest(F.col("frequency"), F.lit(1)))
    return hits.groupBy("opinion_id", "case_id").agg(
        F.countDistinct("keyword_text").alias("matched"),
        F.round(F.sum("match") * F.log10(F.countDistinct("keyword_text") + 1), 8).alias("score"),
    )


def all_terms_search(c: Corpus, terms: list[str]) -> DataFrame:
    """Opinions that have every term as a keyword, by mean relevance."""
    hits = c.tagged(terms).groupBy("opinion_id", "case_id").agg(F.round(F.avg("relevance_score"), 6).alias("mean_relevance"), F.countDistinct("keyword_text").alias("n"))
    return hits.where(F.col("n") == len(set(terms))).drop("n")


def related_keywords(c: Corpus, term: str, least: int = 2) -> DataFrame:
    """Keywords that share opinions with ``term``, by count times mean relevance."""
    base = c.keywords.where(F.col("keyword_text") == term).join(c.assignments, "keyword_id").select("opinion_curie").distinct()
    others = c.assignments.join(base, "opinion_curie", "left_semi").join(c.keywords.where(F.col("keyword_text") != term), "keyword_id")
    rows = others.groupBy("keyword_id", "keyword_text", "tier").agg(F.countDistinct("opinion_curie").alias("shared"), F.avg("relevance_score").alias("mean"))
    return rows.where(F.col("shared") >= least).select("keyword_id", "keyword_text", "tier", "shared", F.round(F.col("shared") * F.col("mean"), 6).alias("score"))


def keyword_stats(c: Corpus) -> DataFrame:
    """Every keyword with the number and range of its assignments, unused ones with zeros and nulls."""
    use = c.assignments.groupBy("keyword_id").agg(
        F.count(F.lit(1)).alias("n_assignments"), F.countDistinct("opinion_curie").alias("n_opinions"),
        F.round(F.min("relevance_score"), 6).alias("least"), F.round(F.max("relevance_score"), 6).alias("most"), F.round(F.avg("relevance_score"), 6).alias("mean"),
    )
    return c.keywords.join(use, "keyword_id", "left").select(
        "keyword_id", "keyword_text", "tier", F.coalesce("n_assignments", F.lit(0)).alias("n_assignments"), F.coalesce("n_opinions", F.lit(0)).alias("n_opinions"), "least", "most", "mean"
    )


def suggestions(c: Corpus, prefix: str, limit: int = 10) -> DataFrame:
    """The most frequent keywords that begin with ``prefix``."""
    return c.keywords.where(F.ilike("keyword_text", F.lit(f"{prefix}%"))).orderBy(F.desc_nulls_last("frequency"), "keyword_text", "keyword_id").limit(limit).select("keyword_id", "keyword_text", "frequency")


def popular(c: Corpus, per_tier: int = 5) -> DataFrame:
    """The most used keywords of each tier."""
    use = c.assignments.groupBy("keyword_id").agg(F.countDistinct("opinion_curie").alias("n_opinions"))
    rows = c.keywords.join(use, "keyword_id")
    place = F.row_number().over(Window.partitionBy("tier").orderBy(F.desc("n_opinions"), "keyword_id"))
    return rows.withColumn("place", place).where(F.col("place") <= per_tier).select("tier", "place", "keyword_id", "keyword_text", "n_opinions")


def top_keywords(c: Corpus, most: int = 5) -> DataFrame:
    """Each opinion's best keywords as an array ordered by score, and its categories as counts in JSON."""
    rows = c.assignments.join(c.keywords.select("keyword_id", "keyword_text"), "keyword_id")
    best = rows.groupBy("opinion_curie", "keyword_text").agg(F.max("relevance_score").alias("score"))
    place = F.row_number().over(Window.partitionBy("opinion_curie").orderBy(F.desc_nulls_last("score"), "keyword_text"))
    top = best.withColumn("place", place).where(F.col("place") <= most)
    return top.groupBy("opinion_curie").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "keyword_text"))), lambda x: x.keyword_text), "; ").alias("top"))
