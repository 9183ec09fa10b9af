"""The queries of the training-data operators, and SQL for those that SQL can express. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import canonical, cooccurrence, leakage, neardup, neighbours, scans, subjects, survivors, tokens


def _texts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, d, "opinions").where("not coalesce(is_valueless, false)")
    return neardup.similar_texts(rows, shingle=3, similarity=0.5, least_words=40)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    opinions = neardup.member_pairs(*_texts(spark, d)).withColumn("table_name", F.lit("opinions"))
    cases = neardup.member_pairs(*neardup.similar_names(table(spark, d, "cases"))).withColumn("table_name", F.lit("cases"))
    return opinions.unionByName(cases).select("table_name", "id_a", "id_b")


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """Near copies by the usual five words and 0.8: one row a text."""
    rows = table(spark, d, "opinions").where("not coalesce(is_valueless, false)")
    return neardup.duplicate_classes(*neardup.similar_texts(rows, shingle=5, similarity=0.8, least_words=5)).drop("class")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return cooccurrence.pair_scores(cooccurrence.keyword_rows(table(spark, d, "opinion_keywords"), table(spark, d, "keywords")))


PAIR = ("left AS field_of_law_keyword_id", "right AS doctrine_or_concept_keyword_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return cooccurrence.strong_pairs(_scores(spark, d)).selectExpr(*PAIR)


def p2_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).selectExpr(*PAIR, "together", "n_left", "n_right", "floor(lift * 1e6 + 0.5) / 1e6 AS lift", "floor(conviction * 1e6 + 0.5) / 1e6 AS conviction")


def p2_approved(spark: SparkSession, d: str) -> DataFrame:
    approved = table(spark, d, "keyword_validation").select("field_of_law_keyword_id", "doctrine_or_concept_keyword_id").dropna().distinct()
    scores = p2_scores(spark, d)
    return approved.join(scores, approved.columns, "left").select(*approved.columns, F.coalesce("together", F.lit(0)).alias("together"), "lift")


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    rows = canonical.reporter_rows(table(spark, d, "case_citations"), table(spark, d, "citation_corrections"))
    return canonical.resolved_rows(rows, table(spark, d, "reporters"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).select("table_name", "row_id", "reporter_id").distinct()


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return _resolved(spark, d).where("reporter_id = 0").groupBy("table_name", "value").agg(F.countDistinct("row_id").alias("n_rows"))


VECTORS = ("usc_chunks", "opinion_paragraphs")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Only pairs of cosine 0.9 and more are asked for, so queries go no further than such a pair can reach."""
    out = None
    for name in VECTORS:
        near = neighbours.nearest_vectors(table(spark, d, name), k=5, visits=3, reach=0.15, beam=16, degree=12, shard=1250, least=0.9)
        rows = near.select(F.lit(name).alias("table_name"), F.least("id", "other").cast("int").alias("id_a"), F.greatest("id", "other").cast("int").alias("id_b"))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def p5_knn(spark: SparkSession, d: str) -> DataFrame:
    """The 5 nearest of every id divisible by 20, among all rows, by all shards."""
    out = None
    for name in VECTORS:
        near = neighbours.nearest_vectors(table(spark, d, name), k=5, beam=40, degree=20, asked=20).withColumn("table_name", F.lit(name))
        out = near if out is None else out.unionByName(near)
    return out.select("table_name", "id", "other", F.round("cosine", 5).alias("cosine"))


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return survivors.anchor_groups(table(spark, d, "stage_doctrine_anchors"), table(spark, d, "source_keywords"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(_groups(spark, d)).select("source_ref", "old_id").distinct()


def p6_fused(spark: SparkSession, d: str) -> DataFrame:
    return survivors.fused(_groups(spark, d))


def _scans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    opinions = table(spark, d, "opinions")
    return opinions.select("text"), scans.scanned_opinions(opinions, table(spark, d, "stage_opinions"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.faulty_lines(*_scans(spark, d)).select(F.col("id").cast("int").alias("opinion_id"), "line_no", "kind")


def p7_text(spark: SparkSession, d: str) -> DataFrame:
    return scans.repaired_texts(*_scans(spark, d)).select(F.col("id").cast("int").alias("opinion_id"), "text")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def _leaks(spark: SparkSession, d: str, edits: int) -> DataFrame:
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), edits)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """By the embedding, near windows too; then the exact edit distance leaves those of distance 0."""
    return _leaks(spark, d, 1).where("edits = 0").select("doc_id", "item_id")


def p9_near(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d, 1)


def _areas(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subject_areas(table(spark, d, "documents"), table(spark, d, "doc_subject_labels"), table(spark, d, "subjects"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _areas(spark, d).select("doc_id", "subject").distinct()


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    found = _areas(spark, d).groupBy("subject").agg(F.countDistinct("doc_id").alias("n_docs"), F.round(F.avg("share"), 4).alias("mean_share"))
    total = table(spark, d, "documents").agg(F.countDistinct("doc_id").alias("n_all"))
    return found.join(F.broadcast(total)).select("subject", "n_docs", "mean_share", (F.col("n_docs") / F.col("n_all")).alias("corpus_share"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(f)}


_P2 = """
WITH tiers AS (SELECT id, min(CASE WHEN tier = 'field_of_law' THEN 0 WHEN tier IS NOT NULL THEN 1 END) AS side FROM keywords WHERE id IS NOT NULL GROUP BY id),
k AS (SELECT DISTINCT o.opinion_curie, o.keyword_id, t.side FROM opinion_keywords o JOIN tiers t ON t.id = o.keyword_id WHERE o.opinion_curie IS NOT NULL),
c AS (SELECT keyword_id, count(*) AS n FROM k GROUP BY keyword_id),
total AS (SELECT count(DISTINCT opinion_curie) AS n FROM opinion_keywords),
p AS (SELECT a.keyword_id AS l, b.keyword_id AS r, count(*) AS together FROM k a JOIN k b ON a.opinion_curie = b.opinion_curie AND a.side = 0 AND b.side = 1 GROUP BY 1, 2),
s AS (SELECT p.l AS field_of_law_keyword_id, p.r AS doctrine_or_concept_keyword_id, p.together, x.n AS n_left, y.n AS n_right, total.n AS n
      FROM p JOIN c x ON x.keyword_id = p.l JOIN c y ON y.keyword_id = p.r CROSS JOIN total),
scores AS (SELECT field_of_law_keyword_id, doctrine_or_concept_keyword_id, together, n_left, n_right,
      floor(together * n / CAST(n_left * n_right AS DOUBLE) * 1e6 + 0.5) / 1e6 AS lift,
      floor(CASE WHEN together < n_left THEN (1 - n_right / CAST(n AS DOUBLE)) / (1 - together / CAST(n_left AS DOUBLE)) END * 1e6 + 0.5) / 1e6 AS conviction FROM s)
"""
_WORD = "regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_SQUEEZED = "regexp_replace(lower({}), '[\\s_ ]+', '', 'g')"


_P5 = """SELECT DISTINCT '{t}' AS table_name, least(x, y) AS id_a, greatest(x, y) AS id_b FROM (
  SELECT a.id AS x, b.id AS y, list_cosine_similarity(a.e, b.e) AS c, row_number() OVER (PARTITION BY a.id ORDER BY list_cosine_similarity(a.e, b.e) DESC, b.id) AS place
  FROM (SELECT id, any_value(embedding) AS e FROM {t} WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL)) = 64 AND len(list_filter(embedding, lambda v: v <> 0)) > 0 GROUP BY id) a
  JOIN (SELECT id, any_value(embedding) AS e FROM {t} WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL)) = 64 AND len(list_filter(embedding, lambda v: v <> 0)) > 0 GROUP BY id) b ON a.id <> b.id)
WHERE place <= 5 AND c >= 0.9"""
_P1_CLASSES = """
WITH t AS (SELECT DISTINCT id, w FROM (SELECT id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM opinions WHERE NOT coalesce(is_valueless, false) AND text IS NOT NULL AND id IS NOT NULL) WHERE len(w) >= 5),
k AS (SELECT w, row_number() OVER () AS c FROM (SELECT DISTINCT w FROM t)), m AS (SELECT DISTINCT c, id FROM t JOIN k USING (w)),
s AS (SELECT DISTINCT c, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT c, w, unnest(range(1, len(w) - 3)) AS i FROM k)),
n AS (SELECT c, count(*) AS n FROM s GROUP BY c),
p AS (SELECT a.c AS x, b.c AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.c < b.c GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n u ON u.c = x JOIN n v ON v.c = y WHERE CAST(shared AS DOUBLE) / (u.n + v.n - shared) >= CAST(0.8 AS DOUBLE)),
e AS (SELECT c, count(*) AS links FROM (SELECT x AS c FROM l UNION ALL SELECT y FROM l) GROUP BY c)
SELECT m.id, (SELECT count(*) FROM m o WHERE o.c = m.c) AS copies, coalesce(e.links, 0) AS links FROM m LEFT JOIN e USING (c)"""
_P9 = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM eval_items WHERE text IS NOT NULL),
dw AS (SELECT doc_id, array_to_string(w[k:k + 9], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 8)) AS k FROM d)),
iw AS (SELECT item_id, array_to_string(w[k:k + 9], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS k FROM i))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (s)"""


def oracle_sql() -> dict[str, str]:
    word = _WORD.format("keyword_text")
    tier, status = _SQUEEZED.format("confidence_tier"), _SQUEEZED.format("status")
    trimmed = "regexp_replace(description, '^\\s+|\\s+$', '', 'g')"
    fillers = ", ".join(f"'{x}'" for x in ("", *survivors.FILLERS))
    return {
        "p2_found": _P2
        + "SELECT field_of_law_keyword_id, doctrine_or_concept_keyword_id FROM s WHERE together >= 4 AND together * n >= 3 * n_left * n_right",
        "p2_scores": _P2 + "SELECT * FROM scores",
        "p2_approved": _P2
        + "SELECT v.field_of_law_keyword_id, v.doctrine_or_concept_keyword_id, coalesce(together, 0) AS together, lift FROM (SELECT DISTINCT field_of_law_keyword_id, doctrine_or_concept_keyword_id FROM keyword_validation WHERE field_of_law_keyword_id IS NOT NULL AND doctrine_or_concept_keyword_id IS NOT NULL) v LEFT JOIN scores USING (field_of_law_keyword_id, doctrine_or_concept_keyword_id)",
        "p1_classes": _P1_CLASSES,
        "p5_found": " UNION ALL ".join(_P5.format(t=t) for t in VECTORS),
        "p9_found": _P9,
        "p6_found": f"""
WITH w AS (SELECT id, min({word}) AS word FROM source_keywords WHERE id IS NOT NULL GROUP BY id),
g AS (SELECT coalesce(a.word, '#' || s.old_doctrine_keyword_id) AS doctrine,
             coalesce(b.word, '#' || s.old_field_of_law_keyword_id, '') AS field, source_ref, old_id,
             CASE {tier} WHEN 'expertreviewed' THEN 0 WHEN 'llmclassified' THEN 1 WHEN 'uncurated' THEN 2 ELSE 3 END AS t,
             CASE {status} WHEN 'promoted' THEN 0 WHEN 'pending' THEN 1 WHEN 'dismissed' THEN 2 ELSE 3 END AS u, last_reviewed_at,
             CASE WHEN lower({trimmed}) IN ({fillers}) OR description IS NULL THEN 0 ELSE length({trimmed}) END AS n
      FROM stage_doctrine_anchors s LEFT JOIN w a ON a.id = s.old_doctrine_keyword_id LEFT JOIN w b ON b.id = s.old_field_of_law_keyword_id
      WHERE s.old_doctrine_keyword_id IS NOT NULL),
big AS (SELECT doctrine, field FROM (SELECT DISTINCT doctrine, field, source_ref, old_id FROM g) GROUP BY 1, 2 HAVING count(*) > 1),
r AS (SELECT g.*, row_number() OVER (PARTITION BY doctrine, field ORDER BY t, u, last_reviewed_at DESC NULLS LAST, n DESC, source_ref, old_id) AS rn
      FROM g JOIN big USING (doctrine, field))
SELECT DISTINCT source_ref, old_id FROM r WHERE rn = 1""",
    }
