"""Queries that resolve references and check a merge, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import citations
from ..operators import merge as M
from ..operators import resolution as R
from ..operators import search as S
from ..operators.ids import dense_ids, first_by
from ..sources.tables import table
from .search_queries import TERMS, TEXT, _sql_hybrid, corpus

FILES = "https://example.org/files"
RULES: dict[str, R.Rule] = {"status": (True, ("active", "retired")), "extraction_method": (True, ()), "category": (False, ("doctrine", "field_of_law"))}


def _cases(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return first_by(table(spark, d, "cases").where("id is not null"), ["id"], [F.asc_nulls_last(c) for c in cols]).select("id", *cols)


def _c(*cols: str) -> str:
    return f"(SELECT id, {', '.join(cols)} FROM cases WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY {', '.join(f'{c} NULLS LAST' for c in cols)}) = 1)"


def backfill(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d, "name_abbreviation", "docket_number")
    return R.backfilled(c, c, "name_abbreviation", "id", "docket_number").select("id", "docket_number", "filled")


def alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    names = R.named_units(table(spark, d, "reporters"), "reporter_id", "canonical", "aliases")
    rows = table(spark, d, "case_citations").select("id", "reporter").distinct()
    return R.resolved_names(rows, "reporter", names, "reporter_id").select("id", "reporter", "reporter_id", "by")


def links(spark: SparkSession, d: str) -> DataFrame:
    """The sections that a chunk's text names, resolved to the first chunk of the element of that address in its title."""
    u = table(spark, d, "usc_chunks").where("element_id is not null").select("id", "element_id", "original_text").distinct()
    found = u.select("id", F.regexp_extract("element_id", "^(/us/usc/t[0-9]+)", 1).alias("title"), F.explode(F.regexp_extract_all("original_text", F.lit(r"[Ss]ections? ([0-9]+)"), F.lit(1))).alias("n")).distinct()
    to = found.select("id", F.concat("title", F.lit("/s"), "n").alias("destination"))
    units = u.select("id", F.regexp_extract("element_id", "^(/us/usc/t[0-9]+/s[0-9]+)", 1).alias("address"))
    return R.resolved_links(to, "destination", units, "address", "id")


def _merged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = table(spark, d, "cases").where("id is not null").select("source_ref", F.col("id").alias("old_id"), "curie").distinct()
    one = first_by(rows, ["source_ref", "old_id"], [F.asc_nulls_last("curie")])
    ids = dense_ids(one, ["source_ref", "old_id"])
    return rows, ids.select("new_id", "curie"), ids.select("source_ref", "old_id", "new_id")


def bounds(spark: SparkSession, d: str) -> DataFrame:
    anchors, words = table(spark, d, "stage_doctrine_anchors"), table(spark, d, "source_keywords")
    known = words.where("keyword_text is not null").select(F.col("id").alias("old_doctrine_keyword_id")).distinct()
    return R.collapse_bounds(anchors.distinct().join(known, "old_doctrine_keyword_id", "left_semi"), M.collapsed_anchors(anchors, words))


def cite_checks(spark: SparkSession, d: str) -> DataFrame:
    """Observed citations against the expected reporter and volume, by issue."""
    c = table(spark, d, "citation_corrections").select("id", "observed_cite", "expected_reporter", "file_volume").distinct()
    return c.groupBy(R.cite_issue(F.col("observed_cite"), F.col("expected_reporter"), F.col("file_volume")).alias("issue")).agg(F.count(F.lit(1)).alias("n"))


def official(spark: SparkSession, d: str) -> DataFrame:
    """Each case's official citation: built of its reporter, volume and first page, else the first citation it came with."""
    c = _cases(spark, d, "file_name", "first_page")
    volume = F.regexp_extract("file_name", "_([0-9]+)", 1).try_cast("int")
    built = citations.official_cite(F.nullif(F.regexp_extract("file_name", "^([a-z0-9]+)_", 1), F.lit("")), volume, F.col("first_page"))
    given = table(spark, d, "case_citations").where("cited_case is not null").groupBy(F.col("case_id").alias("id")).agg(F.min_by("cited_case", F.struct("id", "cited_case")).alias("given"))
    return c.select("id", built.alias("built")).join(given, "id", "left").select("id", F.coalesce("built", "given").alias("cite"), F.when(F.col("built").isNotNull(), "built").when(F.col("given").isNotNull(), "given").otherwise("none").alias("by"))


def sections(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "usc_chunks").select("id", "heading", "original_text").distinct()
    rows = u.select("id", F.explode(R.section_chunks(F.col("heading"), F.col("original_text"), 8)).alias("c"))
    return rows.select("id", "c.chunk_index", "c.total_chunks", "c.content")


def curie_checks(spark: SparkSession, d: str) -> DataFrame:
    every = None
    for name, column in (("cases", "curie"), ("opinions", "curie"), ("usc_chunks", "element_id"), ("case_citations", "cited_case")):
        t = table(spark, d, name).select(F.col(column).alias("c")).distinct()
        row = t.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.count_if(citations.valid_curie(F.col("c"))).alias("valid"))
        every = row if every is None else every.unionByName(row)
    return every


def law_places(spark: SparkSession, d: str) -> DataFrame:
    """Statutes and rules cited in all documents, opinions and chunks of the code."""
    every = None
    for name, key, text in (("documents", "doc_id", "text"), ("opinions", "id", "text"), ("usc_chunks", "id", "original_text")):
        t = table(spark, d, name).where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).distinct()
        rows = citations.law_citations(t).select(F.lit(name).alias("table_name"), "id", "curie", "format")
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy("table_name", "format").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("curie").alias("n_places"), F.countDistinct("id").alias("n_texts"))


def full_audit(spark: SparkSession, d: str) -> DataFrame:
    """Twenty checks of references, by parent; the last ones are of keywords that are there but of the wrong tier."""
    t = {n: table(spark, d, n) for n in ("cases", "opinions", "case_citations", "citation_corrections", "opinion_keywords", "keywords", "opinion_paragraphs", "source_keywords", "stage_doctrine_anchors", "stage_opinions", "keyword_validation", "doc_subject_labels", "documents", "subjects", "deleted_records")}
    cited = t["case_citations"].select(F.explode("cited_case_ids").alias("cited"))
    gone = t["deleted_records"].where("table_name = 'cases'").select("record_id")
    gone_cites = t["deleted_records"].where("table_name = 'case_citations'").select("record_id")
    checks = [
        ("opinions.case_id", t["opinions"], "case_id", t["cases"], "id"), ("case_citations.case_id", t["case_citations"], "case_id", t["cases"], "id"),
        ("case_citations.cited_case_ids", cited, "cited", t["cases"], "id"), ("citation_corrections.case_id", t["citation_corrections"], "case_id", t["cases"], "id"),
        ("deleted_records.cases", gone, "record_id", t["cases"], "id"), ("citation_corrections.citation_id", t["citation_corrections"], "citation_id", t["case_citations"], "id"),
        ("deleted_records.case_citations", gone_cites, "record_id", t["case_citations"], "id"), ("opinion_keywords.opinion_curie", t["opinion_keywords"], "opinion_curie", t["opinions"], "curie"),
        ("stage_opinions.curie", t["stage_opinions"], "curie", t["opinions"], "curie"), ("opinion_paragraphs.opinion_id", t["opinion_paragraphs"], "opinion_id", t["opinions"], "id"),
        ("opinion_keywords.keyword_id", t["opinion_keywords"], "keyword_id", t["keywords"], "id"), ("keyword_validation.field", t["keyword_validation"], "field_of_law_keyword_id", t["keywords"], "id"),
        ("keyword_validation.doctrine", t["keyword_validation"], "doctrine_or_concept_keyword_id", t["keywords"], "id"), ("stage_doctrine_anchors.doctrine", t["stage_doctrine_anchors"], "old_doctrine_keyword_id", t["source_keywords"], "id"),
        ("stage_doctrine_anchors.field", t["stage_doctrine_anchors"], "old_field_of_law_keyword_id", t["source_keywords"], "id"), ("doc_subject_labels.doc_id", t["doc_subject_labels"], "doc_id", t["documents"], "doc_id"),
        ("doc_subject_labels.subject", t["doc_subject_labels"], "subject", t["subjects"], "subject"),
    ]
    out = M.audit_by_parent(checks)
    for name, child, key, parent, ok in (
        ("keyword_validation.field tier", t["keyword_validation"], "field_of_law_keyword_id", t["keywords"], "tier = 'field_of_law'"), ("keyword_validation.doctrine tier", t["keyword_validation"], "doctrine_or_concept_keyword_id", t["keywords"], "tier <> 'field_of_law'"),
        ("stage_doctrine_anchors.field tier", t["stage_doctrine_anchors"], "old_field_of_law_keyword_id", t["source_keywords"], "tier = 'field_of_law'"),
    ):
        wrong = parent.where(f"not ({ok})").select(F.col("id").alias(key)).distinct()
        row = child.join(wrong, key).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("orphans"))
        out = out.unionByName(row)
    return out


_AUDIT = (
    ("opinions.case_id", "opinions", "case_id", "cases", "id"), ("case_citations.case_id", "case_citations", "case_id", "cases", "id"),
    ("case_citations.cited_case_ids", "(SELECT unnest(cited_case_ids) AS cited FROM case_citations)", "cited", "cases", "id"), ("citation_corrections.case_id", "citation_corrections", "case_id", "cases", "id"),
    ("deleted_records.cases", "(SELECT * FROM deleted_records WHERE table_name = 'cases')", "record_id", "cases", "id"), ("citation_corrections.citation_id", "citation_corrections", "citation_id", "case_citations", "id"),
    ("deleted_records.case_citations", "(SELECT * FROM deleted_records WHERE table_name = 'case_citations')", "record_id", "case_citations", "id"), ("opinion_keywords.opinion_curie", "opinion_keywords", "opinion_curie", "opinions", "curie"),
    ("stage_opinions.curie", "stage_opinions", "curie", "opinions", "curie"), ("opinion_paragraphs.opinion_id", "opinion_paragraphs", "opinion_id", "opinions", "id"),
    ("opinion_keywords.keyword_id", "opinion_keywords", "keyword_id", "keywords", "id"), ("keyword_validation.field", "keyword_validation", "field_of_law_keyword_id", "keywords", "id"),
    ("keyword_validation.doctrine", "keyword_validation", "doctrine_or_concept_keyword_id", "keywords", "id"), ("stage_doctrine_anchors.doctrine", "stage_doctrine_anchors", "old_doctrine_keyword_id", "source_keywords", "id"),
    ("stage_doctrine_anchors.field", "stage_doctrine_anchors", "old_field_of_law_keyword_id", "source_keywords", "id"), ("doc_subject_labels.doc_id", "doc_subject_labels", "doc_id", "documents", "doc_id"),
    ("doc_subject_labels.subject", "doc_subject_labels", "subject", "subjects", "subject"),
)
_TIERS = (
    ("keyword_validation.field tier", "keyword_validation", "field_of_law_keyword_id", "keywords", "tier = 'field_of_law'"), ("keyword_validation.doctrine tier", "keyword_validation", "doctrine_or_concept_keyword_id", "keywords", "tier <> 'field_of_law'"),
    ("stage_doctrine_anchors.field tier", "stage_doctrine_anchors", "old_field_of_law_keyword_id", "source_keywords", "tier = 'field_of_law'"),
)


def by_date(spark: SparkSession, d: str) -> DataFrame:
    dates = _cases(spark, d, "decision_date").select(F.col("id").alias("case_id"), "decision_date")
    return S.hybrid_search(corpus(spark, d), TERMS + TEXT, least=0.5, limit=50, dates=dates).select("opinion_id", "case_id", "total_relevance", "decision_date")


def nested_mean(spark: SparkSession, d: str) -> DataFrame:
    """The fields of law that a doctrine is approved for: on the mean, at most, and in all."""
    v = table(spark, d, "keyword_validation").dropna().select("field_of_law_keyword_id", "doctrine_or_concept_keyword_id").distinct()
    per = v.groupBy("doctrine_or_concept_keyword_id").agg(F.countDistinct("field_of_law_keyword_id").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_doctrines"), F.round(F.avg("n"), 6).alias("mean_fields"), F.max("n").alias("most_fields"), F.sum("n").alias("n_relations"))


def scalars(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d, "decision_date", "docket_number", "name_abbreviation")
    year, number = F.substring("decision_date", 1, 4).try_cast("int"), F.regexp_extract("docket_number", "([0-9]+)", 1)
    return c.select(
        "id", R.page_anchor(R.public_file(FILES, year, number), F.col("id") % 7).alias("anchor"), R.distinguishing_key(F.lit(" case "), F.col("name_abbreviation")).alias("key"),
        R.batch_size(F.col("id") * 3).alias("batch"), citations.plain_citation(F.concat_ws(" sec. ", "docket_number", "id")).alias("plain"),
    )


def settings(spark: SparkSession, d: str) -> DataFrame:
    """Assignments as settings with defaults: what is wrong with them, by kind."""
    k = table(spark, d, "opinion_keywords").select("id", "status", "extraction_method", "category").distinct()
    given = F.map_filter(F.create_map(*(x for c in RULES for x in (F.lit(c), F.col(c)))), lambda n, v: v.isNotNull())
    faults = R.config_faults(R.with_defaults(given, {"status": "active"}), RULES)
    return k.groupBy(F.array_join(faults, ",").alias("faults")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "name_backfill": backfill, "alias_union_lookup": alias_lookup, "internal_link_resolution": links, "cite_expectations": cite_checks, "official_cite_rebuild": official, "section_chunks": sections,
    "curie_round_trip": lambda spark, d: R.curie_round_trip(*_merged(spark, d)), "anchor_bounds": bounds, "curie_validity": curie_checks, "law_citation_places": law_places, "orphan_audit_full": full_audit,
    "hybrid_search_by_date": by_date, "nested_mean_relations": nested_mean, "record_scalars": scalars, "config_faults": settings,
}

_LAW = citations.LAW_PATTERN.replace("'", "''")
_PARSE = "'^([0-9]+)\\s+(.+)\\s+([0-9]+)(.*)$'"
_STOPS = ", ".join(f"'{w}'" for w in __import__("lexmill.functions.text", fromlist=["STOP_WORDS"]).STOP_WORDS)
SQL = {
    "name_backfill": f"""WITH c AS {_c('name_abbreviation', 'docket_number')},
f AS (SELECT name_abbreviation, arg_min(docket_number, id) AS v FROM c WHERE name_abbreviation IS NOT NULL AND docket_number IS NOT NULL GROUP BY 1)
SELECT id, coalesce(docket_number, v) AS docket_number, docket_number IS NULL AND v IS NOT NULL AS filled FROM c LEFT JOIN f USING (name_abbreviation)""",
    "alias_union_lookup": """WITH n AS (SELECT canonical AS name, reporter_id, 0 AS r FROM reporters UNION ALL SELECT unnest(aliases), reporter_id, 1 FROM reporters),
o AS (SELECT name, reporter_id, r FROM n WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY r, reporter_id) = 1)
SELECT id, reporter, reporter_id, CASE r WHEN 0 THEN 'canonical' WHEN 1 THEN 'alias' END AS "by" FROM (SELECT DISTINCT id, reporter FROM case_citations) c LEFT JOIN o ON o.name = c.reporter""",
    "internal_link_resolution": """WITH u AS (SELECT DISTINCT id, element_id, original_text FROM usc_chunks WHERE element_id IS NOT NULL),
f AS (SELECT DISTINCT id, regexp_extract(element_id, '^(/us/usc/t[0-9]+)', 1) AS title, unnest(regexp_extract_all(original_text, '[Ss]ections? ([0-9]+)', 1)) AS n FROM u),
a AS (SELECT regexp_extract(element_id, '^(/us/usc/t[0-9]+/s[0-9]+)', 1) AS address, min(id) AS target FROM u GROUP BY 1)
SELECT f.id, title || '/s' || n AS destination, target FROM f LEFT JOIN a ON a.address = title || '/s' || n""",
    "cite_expectations": f"""WITH c AS (SELECT DISTINCT id, observed_cite AS t, expected_reporter AS e, file_volume AS v FROM citation_corrections),
p AS (SELECT *, regexp_matches(t, {_PARSE}) AS ok, upper(regexp_replace(regexp_extract(t, {_PARSE}, 2), '[\\s.]+', '', 'g')) AS r, upper(regexp_replace(coalesce(e, ''), '[\\s.]+', '', 'g')) AS x, try_cast(regexp_extract(t, {_PARSE}, 1) AS INT) AS w FROM c)
SELECT CASE WHEN t IS NULL OR trim(t) = '' THEN 'db_missing_official' WHEN NOT ok THEN 'db_cite_parse_error' WHEN r <> x THEN 'db_reporter_mismatch' WHEN w IS DISTINCT FROM v THEN 'db_volume_or_page_mismatch' ELSE 'ok' END AS issue, count(*) AS n FROM p GROUP BY 1""",
    "official_cite_rebuild": f"""WITH c AS (SELECT id, nullif(regexp_extract(file_name, '^([a-z0-9]+)_', 1), '') AS r, try_cast(regexp_extract(file_name, '_([0-9]+)', 1) AS INT) AS v, try_cast(regexp_extract(first_page, '^\\s*([0-9]+)', 1) AS INT) AS p FROM {_c('file_name', 'first_page')}),
g AS (SELECT case_id AS id, arg_min(cited_case, (id, cited_case)) AS given FROM case_citations WHERE cited_case IS NOT NULL GROUP BY 1),
b AS (SELECT c.id, CASE WHEN r IS NOT NULL AND v IS NOT NULL AND p IS NOT NULL THEN v || ' ' || r || ' ' || p END AS built, given FROM c LEFT JOIN g USING (id))
SELECT id, coalesce(built, given) AS cite, CASE WHEN built IS NOT NULL THEN 'built' WHEN given IS NOT NULL THEN 'given' ELSE 'none' END AS "by" FROM b""",
    "section_chunks": f"""WITH u AS (SELECT id, regexp_split_to_array(CASE WHEN coalesce(heading, '') <> '' THEN heading || chr(10) ELSE '' END || coalesce(original_text, ''), '\\s+') AS w FROM (SELECT DISTINCT id, heading, original_text FROM usc_chunks)),
i AS (SELECT id, w, unnest(range(0, CAST(ceil(len(w) / 8.0) AS BIGINT))) AS n FROM u)
SELECT id, CAST(n AS INT) AS chunk_index, CAST(ceil(len(w) / 8.0) AS INT) AS total_chunks, coalesce(array_to_string(list_filter(w[n * 8 + 1:n * 8 + 8], lambda x: lower(x) NOT IN ({_STOPS})), ' '), '') AS content FROM i""",
    "curie_round_trip": """WITH r AS (SELECT DISTINCT source_ref, id, curie FROM cases WHERE id IS NOT NULL),
m AS (SELECT source_ref, id, curie AS b FROM r QUALIFY row_number() OVER (PARTITION BY source_ref, id ORDER BY curie NULLS LAST) = 1)
SELECT r.source_ref, count(*) AS n, count(*) FILTER (WHERE curie IS DISTINCT FROM b) AS mismatches FROM r JOIN m ON m.source_ref = r.source_ref AND m.id = r.id GROUP BY 1""",
    "anchor_bounds": """WITH k AS (SELECT DISTINCT id, lower(keyword_text) AS key FROM source_keywords WHERE keyword_text IS NOT NULL),
a AS (SELECT DISTINCT * FROM stage_doctrine_anchors), s AS (SELECT source_ref, count(*) AS n FROM a WHERE old_doctrine_keyword_id IN (SELECT id FROM k) GROUP BY 1),
j AS (SELECT DISTINCT p.key AS doctrine, q.key AS field FROM a JOIN k p ON p.id = old_doctrine_keyword_id LEFT JOIN k q ON q.id = old_field_of_law_keyword_id), m AS (SELECT count(*) AS merged_count FROM j)
SELECT CAST(sum(n) AS BIGINT) AS source_sum, max(n) AS source_max, merged_count, merged_count <= sum(n) AND merged_count >= max(n) AS ok FROM s CROSS JOIN m GROUP BY merged_count""",
    "curie_validity": " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS n, count(*) FILTER (WHERE regexp_matches(c, '^[A-Za-z][A-Za-z0-9_-]*:[^:]+$')) AS valid FROM (SELECT DISTINCT {c} AS c FROM {n})"
        for n, c in (("cases", "curie"), ("opinions", "curie"), ("usc_chunks", "element_id"), ("case_citations", "cited_case"))
    ),
    "law_citation_places": f"""WITH t AS (SELECT DISTINCT 'documents' AS table_name, doc_id AS id, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT DISTINCT 'opinions', id, text FROM opinions WHERE text IS NOT NULL
  UNION ALL SELECT DISTINCT 'usc_chunks', id, original_text FROM usc_chunks WHERE original_text IS NOT NULL),
h AS (SELECT table_name, id, unnest(regexp_extract_all(text, '{_LAW}')) AS raw FROM t),
f AS (SELECT *, CASE WHEN regexp_matches(raw, '^[0-9]+\\s*RCNY') THEN 'rcny' WHEN regexp_matches(raw, '^[0-9]+\\s*NYCRR') THEN 'nycrr' WHEN regexp_matches(raw, '^[0-9]+\\s*U') THEN 'usc' WHEN regexp_matches(raw, '^[0-9]+\\s*C') THEN 'cfr'
  WHEN regexp_matches(raw, '^(NYC\\s+)?Admin') THEN 'nyc-admin-code' WHEN regexp_matches(raw, '^(NYC\\s+)?Charter') THEN 'nyc-charter' WHEN regexp_matches(raw, '^[A-Z]{{2}}\\s*(Code|Stat|Ann)') THEN 'state_statute' ELSE 'nys_statute' END AS format FROM h)
SELECT table_name, format, count(*) AS n, count(DISTINCT raw) AS n_places, count(DISTINCT id) AS n_texts FROM f GROUP BY ALL""",
    "orphan_audit_full": " UNION ALL ".join(
        [f"SELECT '{n}' AS name, count(*) AS orphans FROM {c} x WHERE {k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{q} = x.{k})" for n, c, k, p, q in _AUDIT]
        + [f"SELECT '{n}' AS name, count(*) AS orphans FROM {c} x WHERE {k} IN (SELECT id FROM {p} WHERE NOT ({ok}))" for n, c, k, p, ok in _TIERS]
    ),
    "hybrid_search_by_date": f"""WITH h AS ({_sql_hybrid(TERMS + TEXT, 0.5, None)}) SELECT opinion_id, case_id, total_relevance, decision_date FROM h LEFT JOIN {_c('decision_date')} c ON c.id = h.case_id
ORDER BY decision_date DESC NULLS LAST, total_relevance DESC, text_matches DESC, opinion_id LIMIT 50""",
    "nested_mean_relations": """WITH v AS (SELECT DISTINCT field_of_law_keyword_id AS f, doctrine_or_concept_keyword_id AS g FROM keyword_validation WHERE id IS NOT NULL AND field_of_law_keyword_id IS NOT NULL AND doctrine_or_concept_keyword_id IS NOT NULL),
p AS (SELECT g, count(DISTINCT f) AS n FROM v GROUP BY g) SELECT count(*) AS n_doctrines, round(avg(n), 6) AS mean_fields, max(n) AS most_fields, CAST(sum(n) AS BIGINT) AS n_relations FROM p""",
    "record_scalars": f"""WITH c AS (SELECT *, try_cast(substr(decision_date, 1, 4) AS INT) AS y, regexp_extract(docket_number, '([0-9]+)', 1) AS k, id * 3 AS m FROM {_c('decision_date', 'docket_number', 'name_abbreviation')}),
f AS (SELECT *, CASE WHEN y IS NOT NULL AND k <> '' THEN '{FILES}/' || y || '/' || y || '_' || CASE WHEN length(k) < 5 THEN lpad(k, 5, '0') ELSE k END || '.pdf' END AS url FROM c)
SELECT id, CASE WHEN id % 7 > 0 THEN url || '#page=' || id % 7 ELSE url END AS anchor, 'case: ' || trim(name_abbreviation) AS "key",
  CASE WHEN m <= 500 THEN m WHEN m > 10000 THEN 200 WHEN m > 5000 THEN 500 ELSE CAST(ceil(m / least(10, greatest(5, ceil(m / 500.0)))) AS BIGINT) END AS batch,
  trim(regexp_replace(regexp_replace(concat_ws(' sec. ', docket_number, id), '\\s+', ' ', 'g'), 'sec\\.?', '§', 'gi')) AS plain FROM f""",
    "config_faults": """WITH k AS (SELECT DISTINCT id, coalesce(status, 'active') AS s, extraction_method AS e, category AS c FROM opinion_keywords)
SELECT concat_ws(',', CASE WHEN trim(s) = '' OR s NOT IN ('active', 'retired') THEN 'status' END, CASE WHEN coalesce(trim(e), '') = '' THEN 'extraction_method' END, CASE WHEN c NOT IN ('doctrine', 'field_of_law') THEN 'category' END) AS faults, count(*) AS n FROM k GROUP BY 1""",
}
