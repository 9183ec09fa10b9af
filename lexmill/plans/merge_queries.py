"""Merge queries, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators.ids import dense_ids, first_by, remap
from ..sources.tables import table

PREFERENCE = ("Tam.3d", "Tam.2d", "Tam.")


def canonical(spark: SparkSession, d: str) -> DataFrame:
    return M.canonical_keywords(table(spark, d, "source_keywords"))


def case_map(spark: SparkSession, d: str) -> DataFrame:
    return remap(table(spark, d, "cases").where("id is not null"))


def citation_fk(spark: SparkSession, d: str) -> DataFrame:
    """Corrections on remapped cases: the nullable leg stays, by source and old id."""
    rows = table(spark, d, "citation_corrections").select("id", F.col("source_id").alias("source_ref"), "case_id").distinct()
    return M.remapped(rows, case_map(spark, d), "source_ref", "case_id", "new_case_id", keep=True).select("id", "source_ref", "case_id", "new_case_id")


def multi_leg(spark: SparkSession, d: str) -> DataFrame:
    """Citation edges whose citing and first cited case both resolve."""
    rows = table(spark, d, "case_citations").select("id", F.col("case_id").alias("citing"), F.explode("cited_case_ids").alias("cited")).distinct()
    cases = first_by(table(spark, d, "cases").where("id is not null"), ["id"], ["source_ref"]).select("id", "source_ref")
    a = cases.select(F.col("id").alias("citing"), F.col("source_ref").alias("citing_ref"))
    b = cases.select(F.col("id").alias("cited"), F.col("source_ref").alias("cited_ref"))
    return rows.join(a, "citing").join(b, "cited").groupBy("citing_ref", "cited_ref").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("citing").alias("n_citing"))


def legs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "citation_corrections").select("id", "citation_id", "case_id").distinct()
    return M.leg_counts(rows, {"citation": (table(spark, d, "case_citations").select("id"), "citation_id"), "case": (table(spark, d, "cases").select("id"), "case_id")})


def audit(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    checks = [
        ("opinions.case_id", "opinions", "case_id", "cases", "id"), ("case_citations.case_id", "case_citations", "case_id", "cases", "id"),
        ("citation_corrections.citation_id", "citation_corrections", "citation_id", "case_citations", "id"), ("citation_corrections.case_id", "citation_corrections", "case_id", "cases", "id"),
        ("opinion_keywords.opinion_curie", "opinion_keywords", "opinion_curie", "opinions", "curie"), ("opinion_keywords.keyword_id", "opinion_keywords", "keyword_id", "keywords", "id"),
        ("opinion_paragraphs.opinion_id", "opinion_paragraphs", "opinion_id", "opinions", "id"), ("stage_doctrine_anchors.doctrine", "stage_doctrine_anchors", "old_doctrine_keyword_id", "source_keywords", "id"),
        ("stage_doctrine_anchors.field", "stage_doctrine_anchors", "old_field_of_law_keyword_id", "source_keywords", "id"), ("stage_opinions.curie", "stage_opinions", "curie", "opinions", "curie"),
    ]
    return M.orphan_audit([(n, t(c), k, t(p), pk) for n, c, k, p, pk in checks])


def preferred_citation(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "case_citations").where("case_id is not null").select("case_id", "id", "cited_case", "reporter").distinct()
    rank = F.lit(9)
    for i, r in enumerate(PREFERENCE):
        rank = F.when(F.col("reporter") == r, i).otherwise(rank)
    return first_by(rows.withColumn("rank", rank), ["case_id"], ["rank", "id", F.asc_nulls_last("cited_case")]).select("case_id", F.col("id").alias("citation_id"), "cited_case", "rank")


def case_summary(spark: SparkSession, d: str) -> DataFrame:
    """Each case with its cites and children, counted apart so that nothing fans out."""
    cases = first_by(table(spark, d, "cases").where("id is not null"), ["id"], [F.asc_nulls_last("name"), F.asc_nulls_last("decision_date")]).select("id", "name")
    cites = table(spark, d, "case_citations").groupBy(F.col("case_id").alias("id")).agg(F.array_join(F.sort_array(F.collect_set("cited_case")), "; ").alias("cites"), F.countDistinct("id").alias("n_citations"))
    opinions = table(spark, d, "opinions").groupBy(F.col("case_id").alias("id")).agg(F.countDistinct("id").alias("n_opinions"))
    return cases.join(cites, "id", "left").join(opinions, "id", "left").select("id", "name", F.coalesce("cites", F.lit("")).alias("cites"), F.coalesce("n_citations", F.lit(0)).alias("n_citations"), F.coalesce("n_opinions", F.lit(0)).alias("n_opinions"))


def string_agg(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "opinions").where("case_id is not null").select("case_id", "id", "opinion_index", F.coalesce("author", F.lit("?")).alias("author")).distinct()
    order = F.struct(F.coalesce("opinion_index", F.lit(2**31 - 1)).alias("i"), "id", "author")
    return rows.groupBy("case_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(order)), lambda x: x.author), " | ").alias("authors"))


def json_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Keyword contexts, all later assignments merged over the first one of the same opinion and keyword."""
    rows = table(spark, d, "opinion_keywords").select("id", "opinion_curie", "keyword_id", "relevance_score", "context").distinct()
    return M.folded(rows, ["opinion_curie", "keyword_id"], "id", "context", greatest=["relevance_score"]).where("frequency > 1")


def greatest_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "opinion_keywords").select("id", "opinion_curie", "keyword_id", "relevance_score", "category")
    return rows.groupBy("opinion_curie", "keyword_id").agg(F.max("relevance_score").alias("relevance_score"), F.max_by("category", "id").alias("category"))


def null_guard(spark: SparkSession, d: str) -> DataFrame:
    """Departments filled in from the majority of the court's cases, only where they are missing."""
    rows = first_by(table(spark, d, "cases").where("id is not null"), ["id"], [F.asc_nulls_last("court_department"), F.asc_nulls_last("court_id")]).select("id", "court_id", "court_department")
    votes = rows.where("court_department is not null").groupBy("court_id", "court_department").count()
    best = first_by(votes, ["court_id"], [F.desc("count"), "court_department"]).select("court_id", "court_department")
    return M.guarded_update(rows, best, "court_id", "court_department").select("id", "court_id", "court_department", "changed")


def insert_missing(spark: SparkSession, d: str) -> DataFrame:
    cols = ["case_id", "observed_reporter"]
    rows = table(spark, d, "citation_corrections").select(*cols)
    known = table(spark, d, "case_citations").select("case_id", F.col("reporter").alias("observed_reporter"))
    return M.insert_new(known, rows, cols)


def replace_config(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "stage_opinions").select("source_ref", "curie").distinct()
    b = table(spark, d, "opinions").where("curie is not null").select("source_ref", "curie").distinct()
    return M.replaced(b, a, ["source_ref"]).groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "keyword_merge_canonical": canonical,
    "keyword_merge_conflicts": lambda spark, d: M.tier_conflicts(table(spark, d, "source_keywords")),
    "keyword_remap": lambda spark, d: M.keyword_remap(table(spark, d, "source_keywords")),
    "case_remap": case_map,
    "citation_remap_fk": citation_fk,
    "multi_leg_remap": multi_leg,
    "multi_leg_unresolved_counts": legs,
    "anchor_collapse": lambda spark, d: M.collapsed_anchors(table(spark, d, "stage_doctrine_anchors"), table(spark, d, "source_keywords")),
    "opinion_keyword_dedup_active": lambda spark, d: M.active_assignments(table(spark, d, "opinion_keywords")).select("id", "opinion_curie", "keyword_id", "relevance_score"),
    "orphan_audit": audit,
    "preferred_citation": preferred_citation,
    "case_summary": case_summary,
    "string_agg_by_case": string_agg,
    "upsert_json_merge": json_upsert,
    "upsert_greatest": greatest_upsert,
    "bulk_update_null_guard": null_guard,
    "insert_if_missing": insert_missing,
    "replace_by_key": replace_config,
}

_CANON = """
WITH r AS (SELECT *, lower(keyword_text) AS key FROM source_keywords WHERE keyword_text IS NOT NULL),
t AS (SELECT key, tier, sum(frequency) AS f, string_agg(DISTINCT source_ref, ',' ORDER BY source_ref) AS sources FROM r GROUP BY ALL),
w AS (SELECT key, tier AS winning_tier FROM t QUALIFY row_number() OVER (PARTITION BY key ORDER BY f DESC NULLS LAST, tier NULLS LAST) = 1),
x AS (SELECT key, keyword_text AS canonical_text FROM r QUALIFY row_number() OVER (PARTITION BY key ORDER BY frequency DESC NULLS LAST, keyword_text) = 1),
canon AS (SELECT key, winning_tier, canonical_text, sum(frequency)::BIGINT AS total_frequency FROM r JOIN w USING (key) JOIN x USING (key) GROUP BY ALL)"""
_MAP = "WITH m AS (SELECT source_ref, old_id, row_number() OVER (ORDER BY source_ref NULLS FIRST, old_id) AS new_id FROM (SELECT DISTINCT source_ref, id AS old_id FROM cases WHERE id IS NOT NULL))"
_AUDIT = [
    ("opinions", "case_id", "cases", "id", "opinions.case_id"), ("case_citations", "case_id", "cases", "id", "case_citations.case_id"),
    ("citation_corrections", "citation_id", "case_citations", "id", "citation_corrections.citation_id"), ("citation_corrections", "case_id", "cases", "id", "citation_corrections.case_id"),
    ("opinion_keywords", "opinion_curie", "opinions", "curie", "opinion_keywords.opinion_curie"), ("opinion_keywords", "keyword_id", "keywords", "id", "opinion_keywords.keyword_id"),
    ("opinion_paragraphs", "opinion_id", "opinions", "id", "opinion_paragraphs.opinion_id"), ("stage_doctrine_anchors", "old_doctrine_keyword_id", "source_keywords", "id", "stage_doctrine_anchors.doctrine"),
    ("stage_doctrine_anchors", "old_field_of_law_keyword_id", "source_keywords", "id", "stage_doctrine_anchors.field"), ("stage_opinions", "curie", "opinions", "curie", "stage_opinions.curie"),
]

SQL = {
    "keyword_merge_canonical": _CANON + " SELECT * FROM canon",
    "keyword_merge_conflicts": _CANON
    + " SELECT a.key, winning_tier, a.f::BIGINT AS winning_count, a.sources AS sources_winning, b.tier AS losing_tier, b.f::BIGINT AS losing_count, b.sources AS sources_losing FROM w JOIN t a ON a.key = w.key AND a.tier = winning_tier JOIN t b ON b.key = w.key AND b.tier <> winning_tier",
    "keyword_remap": _CANON + ", i AS (SELECT key, row_number() OVER (ORDER BY key) AS new_id FROM canon) SELECT DISTINCT source_ref, id AS old_id, new_id FROM r JOIN i USING (key)",
    "case_remap": _MAP + " SELECT * FROM m",
    "citation_remap_fk": _MAP
    + " SELECT c.id, c.source_id AS source_ref, c.case_id, m.new_id AS new_case_id FROM (SELECT DISTINCT id, source_id, case_id FROM citation_corrections) c LEFT JOIN m ON m.source_ref = c.source_id AND m.old_id = c.case_id",
    "multi_leg_remap": """WITH e AS (SELECT DISTINCT id, case_id AS citing, cited FROM (SELECT id, case_id, unnest(cited_case_ids) AS cited FROM case_citations)),
s AS (SELECT id, min(source_ref) AS ref FROM cases WHERE id IS NOT NULL GROUP BY id)
SELECT a.ref AS citing_ref, b.ref AS cited_ref, count(*) AS n_edges, count(DISTINCT citing) AS n_citing FROM e JOIN s a ON a.id = citing JOIN s b ON b.id = cited GROUP BY ALL""",
    "multi_leg_unresolved_counts": """SELECT count(*) AS n_rows, count(*) FILTER (WHERE citation_id IS NOT NULL AND citation_id NOT IN (SELECT id FROM case_citations WHERE id IS NOT NULL)) AS unresolved_citation,
  count(*) FILTER (WHERE case_id IS NOT NULL AND case_id NOT IN (SELECT id FROM cases WHERE id IS NOT NULL)) AS unresolved_case FROM (SELECT DISTINCT id, citation_id, case_id FROM citation_corrections)""",
    "anchor_collapse": _CANON + """,
k AS (SELECT DISTINCT id, key FROM r),
a AS (SELECT DISTINCT * FROM stage_doctrine_anchors),
j AS (SELECT p.key AS doctrine, q.key AS field, a.* FROM a JOIN k p ON p.id = old_doctrine_keyword_id LEFT JOIN k q ON q.id = old_field_of_law_keyword_id)
SELECT doctrine, field, sum(co_occurrence_count)::BIGINT AS total_count,
  CASE max(CASE confidence_tier WHEN 'expert_reviewed' THEN 3 WHEN 'llm_classified' THEN 2 WHEN 'uncurated' THEN 1 END) WHEN 3 THEN 'expert_reviewed' WHEN 2 THEN 'llm_classified' WHEN 1 THEN 'uncurated' END AS confidence_tier,
  CASE max(CASE status WHEN 'promoted' THEN 3 WHEN 'pending' THEN 2 WHEN 'dismissed' THEN 1 END) WHEN 3 THEN 'promoted' WHEN 2 THEN 'pending' WHEN 1 THEN 'dismissed' END AS status,
  first(description ORDER BY length(description) DESC NULLS LAST, source_ref, old_id, description) AS description, max(last_reviewed_at) AS last_reviewed_at
FROM j GROUP BY doctrine, field""",
    "opinion_keyword_dedup_active": """SELECT id, opinion_curie, keyword_id, relevance_score FROM opinion_keywords WHERE status = 'active'
QUALIFY row_number() OVER (PARTITION BY opinion_curie, keyword_id ORDER BY relevance_score DESC NULLS LAST, created_at NULLS LAST, id) = 1""",
    "orphan_audit": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS orphans FROM {c} x WHERE {k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{pk} = x.{k})" for c, k, p, pk, n in _AUDIT),
    "preferred_citation": """WITH r AS (SELECT DISTINCT case_id, id, cited_case, CASE reporter WHEN 'Tam.3d' THEN 0 WHEN 'Tam.2d' THEN 1 WHEN 'Tam.' THEN 2 ELSE 9 END AS rank FROM case_citations WHERE case_id IS NOT NULL)
SELECT case_id, id AS citation_id, cited_case, rank FROM r QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY rank, id, cited_case NULLS LAST) = 1""",
    "case_summary": """WITH c AS (SELECT id, name FROM cases WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY name NULLS LAST, decision_date NULLS LAST) = 1),
a AS (SELECT case_id, string_agg(DISTINCT cited_case, '; ' ORDER BY cited_case) AS cites, count(DISTINCT id) AS n FROM case_citations GROUP BY case_id),
o AS (SELECT case_id, count(DISTINCT id) AS n FROM opinions GROUP BY case_id)
SELECT c.id, name, coalesce(cites, '') AS cites, coalesce(a.n, 0) AS n_citations, coalesce(o.n, 0) AS n_opinions FROM c LEFT JOIN a ON a.case_id = c.id LEFT JOIN o ON o.case_id = c.id""",
    "string_agg_by_case": """SELECT case_id, string_agg(author, ' | ' ORDER BY opinion_index NULLS LAST, id, author) AS authors
FROM (SELECT DISTINCT case_id, id, opinion_index, coalesce(author, '?') AS author FROM opinions WHERE case_id IS NOT NULL) GROUP BY case_id""",
    "upsert_json_merge": """WITH r AS (SELECT DISTINCT id, opinion_curie, keyword_id, relevance_score, context FROM opinion_keywords),
n AS (SELECT opinion_curie, keyword_id, k, arg_max(json_extract(context, '$.' || k), id) AS v FROM (SELECT *, unnest(json_keys(context)) AS k FROM r) GROUP BY ALL),
o AS (SELECT opinion_curie, keyword_id, string_agg('"' || k || '":' || v::VARCHAR, ',' ORDER BY k) AS inside FROM n GROUP BY ALL),
g AS (SELECT opinion_curie, keyword_id, max(relevance_score) AS relevance_score, count(*) AS frequency FROM r GROUP BY ALL HAVING count(*) > 1)
SELECT g.*, '{' || coalesce(inside, '') || '}' AS context FROM g LEFT JOIN o ON g.opinion_curie IS NOT DISTINCT FROM o.opinion_curie AND g.keyword_id IS NOT DISTINCT FROM o.keyword_id""",
    "upsert_greatest": "SELECT opinion_curie, keyword_id, max(relevance_score) AS relevance_score, first(category ORDER BY id DESC) AS category FROM opinion_keywords GROUP BY ALL",
    "bulk_update_null_guard": """WITH r AS (SELECT id, court_id, court_department FROM cases WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY court_department NULLS LAST, court_id NULLS LAST) = 1),
u AS (SELECT court_id, court_department, count(*) AS n FROM r WHERE court_department IS NOT NULL GROUP BY court_id, court_department),
v AS (SELECT court_id, court_department FROM u QUALIFY row_number() OVER (PARTITION BY court_id ORDER BY n DESC, court_department) = 1)
SELECT r.id, r.court_id, coalesce(r.court_department, v.court_department) AS court_department, r.court_department IS NULL AND v.court_department IS NOT NULL AS changed FROM r LEFT JOIN v ON v.court_id = r.court_id""",
    "insert_if_missing": """SELECT DISTINCT case_id, observed_reporter FROM citation_corrections c
WHERE NOT EXISTS (SELECT 1 FROM case_citations k WHERE k.case_id IS NOT DISTINCT FROM c.case_id AND k.reporter IS NOT DISTINCT FROM c.observed_reporter)""",
    "replace_by_key": """WITH a AS (SELECT DISTINCT source_ref, curie FROM stage_opinions), b AS (SELECT DISTINCT source_ref, curie FROM opinions WHERE curie IS NOT NULL)
SELECT source_ref, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.source_ref = b.source_ref)) GROUP BY source_ref""",
}
