"""Search queries, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search as S
from ..sources.tables import table

TERMS = ["contract law", "tort law", "waiver of probable cause"]
TEXT = ["probable cause", "marketable title"]


def corpus(spark: SparkSession, d: str) -> S.Corpus:
    return S.Corpus(*(table(spark, d, t) for t in ("keywords", "opinion_keywords", "opinions", "cases", "opinion_paragraphs")))


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("matching_keywords", F.array_join("matching_keywords", "; "))


def _hybrid(terms, strategy, least=0.5, limit=50):
    return lambda spark, d: _joined(S.hybrid_search(corpus(spark, d), terms, strategy, least, limit))


def search_stats(spark: SparkSession, d: str) -> DataFrame:
    c = corpus(spark, d)
    rows = c.assignments.join(c.keywords, "keyword_id", "left")
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("opinion_curie").alias("n_opinions"), F.countDistinct("keyword_id").alias("n_keywords"),
        F.countDistinct("tier").alias("n_tiers"), F.round(F.avg("relevance_score"), 6).alias("mean"), F.count_if(F.col("status") == "active").alias("n_active"),
    )


def category_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = corpus(spark, d).assignments.groupBy("opinion_curie", F.coalesce("category", F.lit("uncategorized")).alias("category")).count()
    entries = F.sort_array(F.collect_list(F.struct("category", "count")))
    return rows.groupBy("opinion_curie").agg(F.to_json(F.map_from_entries(entries)).alias("counts"))


def approved_relations(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "keywords")
    pairs = table(spark, d, "keyword_validation").select("field_of_law_keyword_id", "doctrine_or_concept_keyword_id").dropna().distinct()
    a = words.select(F.col("id").alias("field_of_law_keyword_id"), F.col("keyword_text").alias("field_of_law"))
    b = words.select(F.col("id").alias("doctrine_or_concept_keyword_id"), F.col("keyword_text").alias("doctrine_or_concept"), F.col("tier"))
    return pairs.join(a, "field_of_law_keyword_id").join(b, "doctrine_or_concept_keyword_id").select("field_of_law", "doctrine_or_concept", "tier")


def tier_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Any-term search with weights by tier."""
    weights = F.create_map(*map(F.lit, ["field_of_law", 1.0, "major_doctrine", 2.0, "legal_concept", 1.5]))
    hits = corpus(spark, d).tagged(TERMS)
    return hits.groupBy("opinion_id").agg(F.round(F.sum(F.col("relevance_score") * F.coalesce(weights[F.col("tier")], F.lit(1.0))), 6).alias("score"))


QUERIES = {
    "hybrid_search_any": _hybrid(TERMS + TEXT, "any"),
    "hybrid_search_all": _hybrid(TEXT[:1], "all", limit=None),
    "hybrid_search_phrase": _hybrid(["marketable", "title"], "phrase"),
    "hybrid_search_unlimited": _hybrid(TERMS + TEXT, "any", 0.2, None),
    "keyword_any_idf_score": lambda spark, d: S.rarity_search(corpus(spark, d), TERMS),
    "keyword_all_avg": lambda spark, d: S.all_terms_search(corpus(spark, d), ["contract law", "tort law"]),
    "keyword_tier_weighted": tier_weighted,
    "related_keywords": lambda spark, d: S.related_keywords(corpus(spark, d), "contract law"),
    "keyword_stats": lambda spark, d: S.keyword_stats(corpus(spark, d)),
    "keyword_suggestions": lambda spark, d: S.suggestions(corpus(spark, d), "sc"),
    "popular_keywords": lambda spark, d: S.popular(corpus(spark, d)),
    "opinion_top_keywords": lambda spark, d: S.top_keywords(corpus(spark, d)),
    "search_stats_wide": search_stats,
    "category_counts_json": category_counts,
    "approved_relations": approved_relations,
}

_BASE = """
WITH a AS (SELECT DISTINCT keyword_id, opinion_curie, relevance_score, category, status FROM opinion_keywords),
o AS (SELECT id AS opinion_id, case_id, curie FROM opinions WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY case_id NULLS LAST, curie NULLS LAST) = 1),
c AS (SELECT id AS case_id, min(name) AS case_name FROM cases WHERE id IS NOT NULL GROUP BY id),
p AS (SELECT DISTINCT id, opinion_id, raw_text FROM opinion_paragraphs WHERE opinion_id IS NOT NULL),
t AS (SELECT k.id AS keyword_id, k.keyword_text, k.tier, k.frequency, a.opinion_curie, a.relevance_score, o.opinion_id, o.case_id, c.case_name
      FROM keywords k JOIN a ON a.keyword_id = k.id JOIN o ON o.curie = a.opinion_curie JOIN c ON c.case_id = o.case_id)"""


def _in(terms: list[str]) -> str:
    return ", ".join(f"'{t}'" for t in terms)


def _sql_hybrid(terms: list[str], least: float, limit: int | None, every: bool = False) -> str:
    likes = " OR ".join(f"raw_text ILIKE '%{t}%'" for t in terms)
    having = f"HAVING count(DISTINCT keyword_text) = {len(set(terms))}" if every else ""
    hits = (
        "SELECT opinion_id, count(DISTINCT id) AS n FROM p GROUP BY opinion_id HAVING " + " AND ".join(f"bool_or(coalesce(raw_text ILIKE '%{t}%', false))" for t in terms)
        if every
        else f"SELECT opinion_id, count(DISTINCT id) AS n FROM p WHERE {likes} GROUP BY opinion_id"
    )
    return f"""{_BASE},
k AS (SELECT opinion_id, case_id, case_name, sum(relevance_score) AS s, string_agg(DISTINCT keyword_text, '; ' ORDER BY keyword_text) AS w, count(DISTINCT keyword_id) AS n
      FROM t WHERE keyword_text IN ({_in(terms)}) AND relevance_score >= {least} GROUP BY ALL {having}),
h AS ({hits}),
x AS (SELECT h.opinion_id, o.case_id, c.case_name, least(n / 10.0 + 0.5, 1.0) AS s, n FROM h JOIN o USING (opinion_id) JOIN c USING (case_id))
SELECT coalesce(k.opinion_id, x.opinion_id) AS opinion_id, coalesce(k.case_id, x.case_id) AS case_id, coalesce(k.case_name, x.case_name) AS case_name,
  round(CAST(coalesce(k.s, 0) + coalesce(x.s, 0) AS DOUBLE), 6) AS total_relevance, coalesce(k.w, '{'; '.join(terms)}') AS matching_keywords,
  coalesce(k.n, {len(terms)}) AS keyword_count, coalesce(x.n, 0) AS text_matches,
  CASE WHEN k.opinion_id IS NOT NULL AND x.opinion_id IS NOT NULL THEN 'both' WHEN k.opinion_id IS NOT NULL THEN 'keyword' ELSE 'text' END AS search_source
FROM k FULL JOIN x ON k.opinion_id = x.opinion_id
ORDER BY total_relevance DESC, text_matches DESC, opinion_id {f'LIMIT {limit}' if limit else ''}"""


SQL = {
    "hybrid_search_any": _sql_hybrid(TERMS + TEXT, 0.5, 50),
    "hybrid_search_all": _sql_hybrid(TEXT[:1], 0.5, None, True),
    "hybrid_search_unlimited": _sql_hybrid(TERMS + TEXT, 0.2, None),
    "hybrid_search_phrase": f"""{_BASE}
SELECT opinion_id, o.case_id, case_name, round(least(count(DISTINCT p.id) / 5.0 + 0.7, 1.0), 6)::DOUBLE AS total_relevance, 'marketable title' AS matching_keywords,
  1::BIGINT AS keyword_count, count(DISTINCT p.id) AS text_matches, 'text' AS search_source
FROM p JOIN o USING (opinion_id) JOIN c USING (case_id) WHERE raw_text ILIKE '%marketable title%' GROUP BY opinion_id, o.case_id, case_name
ORDER BY total_relevance DESC, text_matches DESC, opinion_id LIMIT 50""",
    "keyword_any_idf_score": f"""{_BASE}
SELECT opinion_id, case_id, count(DISTINCT keyword_text) AS matched, round(sum(relevance_score / greatest(frequency, 1)) * log10(count(DISTINCT keyword_text) + 1), 8) AS score
FROM t WHERE keyword_text IN ({_in(TERMS)}) AND relevance_score >= 0 GROUP BY opinion_id, case_id""",
    "keyword_all_avg": f"""{_BASE}
SELECT opinion_id, case_id, round(avg(relevance_score), 6) AS mean_relevance FROM t WHERE keyword_text IN ('contract law', 'tort law') AND relevance_score >= 0
GROUP BY opinion_id, case_id HAVING count(DISTINCT keyword_text) = 2""",
    "keyword_tier_weighted": f"""{_BASE}
SELECT opinion_id, round(sum(relevance_score * CASE tier WHEN 'major_doctrine' THEN 2.0 WHEN 'legal_concept' THEN 1.5 ELSE 1.0 END), 6) AS score
FROM t WHERE keyword_text IN ({_in(TERMS)}) AND relevance_score >= 0 GROUP BY opinion_id""",
    "related_keywords": f"""{_BASE},
b AS (SELECT DISTINCT opinion_curie FROM a JOIN keywords k ON k.id = a.keyword_id WHERE keyword_text = 'contract law')
SELECT k.id AS keyword_id, keyword_text, tier, count(DISTINCT a.opinion_curie) AS shared, round(count(DISTINCT a.opinion_curie) * avg(relevance_score), 6) AS score
FROM a JOIN b USING (opinion_curie) JOIN keywords k ON k.id = a.keyword_id WHERE keyword_text <> 'contract law' GROUP BY ALL HAVING count(DISTINCT a.opinion_curie) >= 2""",
    "keyword_stats": f"""{_BASE}
SELECT k.id AS keyword_id, keyword_text, tier, count(a.keyword_id) AS n_assignments, count(DISTINCT opinion_curie) AS n_opinions, round(min(relevance_score), 6) AS least,
  round(max(relevance_score), 6) AS most, round(avg(relevance_score), 6) AS mean FROM keywords k LEFT JOIN a ON a.keyword_id = k.id GROUP BY k.id, keyword_text, tier""",
    "keyword_suggestions": "SELECT id AS keyword_id, keyword_text, frequency FROM keywords WHERE keyword_text ILIKE 'sc%' ORDER BY frequency DESC NULLS LAST, keyword_text, id LIMIT 10",
    "popular_keywords": f"""{_BASE},
u AS (SELECT keyword_id, count(DISTINCT opinion_curie) AS n_opinions FROM a GROUP BY keyword_id),
r AS (SELECT tier, row_number() OVER (PARTITION BY tier ORDER BY n_opinions DESC, keyword_id) AS place, keyword_id, keyword_text, n_opinions FROM u JOIN keywords k ON k.id = keyword_id)
SELECT * FROM r WHERE place <= 5""",
    "opinion_top_keywords": f"""{_BASE},
b AS (SELECT opinion_curie, keyword_text, max(relevance_score) AS score FROM a JOIN keywords k ON k.id = a.keyword_id GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY opinion_curie ORDER BY score DESC NULLS LAST, keyword_text) AS place FROM b)
SELECT opinion_curie, string_agg(keyword_text, '; ' ORDER BY place) AS top FROM r WHERE place <= 5 GROUP BY opinion_curie""",
    "search_stats_wide": f"""{_BASE}
SELECT count(*) AS n_rows, count(DISTINCT opinion_curie) AS n_opinions, count(DISTINCT a.keyword_id) AS n_keywords, count(DISTINCT tier) AS n_tiers,
  round(avg(relevance_score), 6) AS mean, count(*) FILTER (WHERE status = 'active') AS n_active FROM a LEFT JOIN keywords k ON k.id = a.keyword_id""",
    "category_counts_json": f"""{_BASE},
n AS (SELECT opinion_curie, coalesce(category, 'uncategorized') AS category, count(*) AS n FROM a GROUP BY ALL)
SELECT opinion_curie, '{{' || string_agg('"' || category || '":' || n, ',' ORDER BY category) || '}}' AS counts FROM n GROUP BY opinion_curie""",
    "approved_relations": """
SELECT a.keyword_text AS field_of_law, b.keyword_text AS doctrine_or_concept, b.tier
FROM (SELECT DISTINCT field_of_law_keyword_id AS f, doctrine_or_concept_keyword_id AS g FROM keyword_validation) v JOIN keywords a ON a.id = v.f JOIN keywords b ON b.id = v.g""",
}
