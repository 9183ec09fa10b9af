"""Queries of the scalar functions, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.ids import first_by
from ..sources.tables import table


def _cases(spark: SparkSession, d: str) -> DataFrame:
    return first_by(table(spark, d, "cases").where("id is not null"), ["id"], [F.asc_nulls_last(c) for c in ("name", "decision_date", "court_name", "first_page", "curie")])


def _cites(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_citations").select("id", "cited_case", "reporter").distinct()


def curies(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers of cases, numbered where they collide."""
    c = _cases(spark, d)
    base = T.case_curie(F.regexp_extract("file_name", "^([a-z0-9]+)_", 1), F.regexp_extract("file_name", "_([0-9]+)", 1), F.col("first_page"), F.regexp_replace("name_abbreviation", " .*", ""))
    rows = c.select("id", base.alias("base"))
    n = F.row_number().over(Window.partitionBy("base").orderBy("id"))
    return rows.where("base is not null").withColumn("n", n).select("id", T.occurrence_suffix(F.col("base"), F.col("n")).alias("curie"))


def opinion_curies(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "opinions").select("id", "case_id", "opinion_index", "opinion_type", "author").distinct()
    made = T.opinion_curie(F.col("case_id").cast("string"), F.col("opinion_index"), F.col("opinion_type"), F.col("author"))
    return o.select("id", made.alias("curie")).distinct()


def slips(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).select("id", F.substring("decision_date", 1, 4).alias("year"), F.regexp_extract("docket_number", "([0-9]+)", 1).alias("number"))
    u = F.col("id") % 3 == 0
    return c.select("id", T.slip_curie("slip", F.col("year"), F.col("number"), u).alias("curie"), T.slip_cite("Slip Op", F.col("year"), F.col("number"), u).alias("cite"))


def dates(spark: SparkSession, d: str) -> DataFrame:
    return _cases(spark, d).select("id", T.iso_date(F.col("decision_date")).alias("iso"), F.substring("decision_date", 1, 4).try_cast("int").alias("year"))


def parsed_cites(spark: SparkSession, d: str) -> DataFrame:
    c = _cites(spark, d).withColumn("p", T.volume_reporter_page(F.col("cited_case"), True)).withColumn("q", T.volume_reporter_page(F.col("cited_case")))
    return c.select("id", "cited_case", "p.volume", "p.reporter", "p.page", F.col("q.reporter").alias("tolerant"), T.rebuilt_cite(F.col("p"), F.lit("X.")).alias("rebuilt"), T.dotted_series(F.col("cited_case")).alias("dotted")).distinct()


def cite_check(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each citation, by its own reporter and the reporters known."""
    known = table(spark, d, "reporters").select(T.reporter_token(F.col("canonical")).alias("token")).distinct().withColumn("known", F.lit(True))
    c = _cites(spark, d).withColumn("p", T.volume_reporter_page(F.col("cited_case"), True)).withColumn("token", T.reporter_token(F.col("p.reporter")))
    status = (
        F.when(F.col("cited_case").isNull(), "missing").when(F.col("p").isNull(), "parse_error").when(F.col("known").isNull(), "unknown_reporter")
        .when(F.col("token") != T.reporter_token(F.col("reporter")), "reporter_mismatch").otherwise("ok")
    )
    return c.join(known, "token", "left").select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def reporter_decision(spark: SparkSession, d: str) -> DataFrame:
    """Whether a correction swaps the reporter or only its format."""
    c = table(spark, d, "citation_corrections").where("expected_reporter is not null").select("id", "observed_reporter", "expected_reporter").distinct()
    kind = F.when(F.col("observed_reporter").eqNullSafe(F.col("expected_reporter")), "none").when(T.reporter_token(F.col("observed_reporter")) == T.reporter_token(F.col("expected_reporter")), "format").otherwise("swap")
    return c.select("id", kind.alias("decision"))


def courts(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).withColumn("of", T.court_of(F.col("court_name")))
    return c.groupBy(T.court_class(F.col("court_name")).alias("court"), "of.reporter", "of.source_ref", "of.department").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("court_id").alias("n_courts"))


ADDRESS = "CASE id % 9 WHEN 0 THEN 'T0' || id || 'C01_1-02' WHEN 1 THEN 'T' || id || 'AppB_3' WHEN 2 THEN 'T7C019.1AppC' WHEN 3 THEN 'T24HC_1.0' || id WHEN 4 THEN 'T38-aC001_1-01' WHEN 5 THEN 'T50C002-01' WHEN 6 THEN 'T6C019A' WHEN 7 THEN 'T9AppQ' ELSE 'T00' || id END"


def addresses(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).select("id", F.expr(ADDRESS).alias("address"))
    return c.select("id", T.address_curie(F.col("address")).alias("curie"), T.natural_key(F.col("address")).alias("sort_key"))


def elements(spark: SparkSession, d: str) -> DataFrame:
    """The elements of the code with those that only stand above others, and what each is."""
    e = table(spark, d, "usc_chunks").where("element_id is not null").select("element_id").distinct()
    up = e.select(F.explode(T.ancestors(F.col("element_id"))).alias("path")).distinct()
    return up.select("path", T.level_of(F.col("path")).alias("level"), F.size(F.split("path", "/")).alias("depth"))


def headings(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "usc_chunks").where("heading is not null").select("heading").distinct().withColumn("h", T.split_heading(F.col("heading")))
    return h.select("heading", "h.number", "h.label")


def pivoted(spark: SparkSession, d: str) -> DataFrame:
    """Heading and body of each element, the last one of each by chunk."""
    u = table(spark, d, "usc_chunks").where("element_id is not null").select("element_id", "id", "content_type", "original_text")
    of = lambda kind: F.max_by("original_text", F.when(F.col("content_type") == kind, F.col("id")))
    return u.groupBy("element_id").agg(of("heading").alias("heading"), of("body").alias("body"))


def element_checks(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "usc_chunks")
    rules = {
        "identifier": ~F.coalesce(F.col("element_id").rlike("^/us/usc/t[0-9]+(/[A-Za-z0-9.\\-]+)*$"), F.lit(False)), "type": ~F.coalesce(F.col("content_type").isin("heading", "body"), F.lit(False)),
        "empty": F.coalesce(F.trim("original_text"), F.lit("")) == "", "marker": F.coalesce(F.col("original_text").rlike(r"^\([a-z0-9]\)"), F.lit(False)),
    }
    return u.agg(*(F.count_if(c).alias(n) for n, c in rules.items()))


def chunks(kind: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        docs = table(spark, d, "documents").where("text is not null")
        made = T.word_chunks(F.col("text"), 60, 30) if kind == "word" else T.char_chunks(F.col("text"))
        rows = docs.select("doc_id", F.posexplode(made).alias("i", "chunk"))
        return rows.select("doc_id", "i", F.length("chunk").alias("n_chars"), F.md5("chunk").alias("digest"))

    return run


def chunk_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Distinct chunks of each element, numbered anew from 0."""
    u = table(spark, d, "usc_chunks").where("element_id is not null").select("element_id", "chunk_index", "content_type", "heading", "original_text").distinct()
    n = F.row_number().over(Window.partitionBy("element_id", "content_type").orderBy("chunk_index", F.asc_nulls_first("heading"), F.asc_nulls_first("original_text"))) - 1
    return u.select("element_id", "content_type", n.alias("n"), F.md5(F.coalesce("original_text", F.lit(""))).alias("digest"))


def stop_words(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "usc_chunks").where("original_text is not null")
    return u.select("id", T.without_stop_words(F.col("original_text")).alias("text"), T.token_estimate(F.col("original_text")).alias("tokens"))


def quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null")
    flags = T.quality_flags(F.col("text"))
    rows = docs.select("doc_id", *(c.alias(n) for n, c in flags.items()))
    return rows.withColumn("score", sum((F.col(n).cast("int") for n in flags), F.lit(0)))


def weak(spark: SparkSession, d: str) -> DataFrame:
    """Opinions that are short, or small beside the longest of their case."""
    o = table(spark, d, "opinions").where("case_id is not null").select("id", "case_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    longest = o.groupBy("case_id").agg(F.max(F.struct(F.length("text").alias("n"), F.col("text").alias("longest"))).alias("m")).select("case_id", "m.longest")
    return o.join(longest, "case_id").select("id", T.is_substantial(F.col("text"), F.col("longest")).alias("substantial"))


def spans(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text", (F.col("doc_id") % 97).cast("int").alias("a"))
    return docs.select("doc_id", F.md5(T.slice_or_null(F.col("text"), F.col("a"), F.col("a") + 120)).alias("digest"))


def normalised(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "opinions").select("id", "text").distinct()
    t = T.normal_text(F.col("text"))
    return docs.select("id", F.length(t).alias("n"), F.sha2(t, 256).alias("digest"))


QUERIES = {
    "curie_slug": lambda spark, d: _cases(spark, d).select("id", T.slug(F.col("name")).alias("slug")),
    "curie_occurrence_suffix": curies,
    "opinion_curie": opinion_curies,
    "slip_op_curie": slips,
    "month_name_date": dates,
    "reporter_parse_rebuild": parsed_cites,
    "citation_validation": cite_check,
    "reporter_correction_decision": reporter_decision,
    "court_class": courts,
    "canonical_address_curie": addresses,
    "ancestor_paths": elements,
    "split_heading": headings,
    "heading_body_pivot": pivoted,
    "element_rule_checks": element_checks,
    "word_chunks": chunks("word"),
    "char_chunks": chunks("char"),
    "chunk_dedup_reindex": chunk_dedup,
    "stopword_removal": stop_words,
    "text_quality_flags": quality,
    "weak_opinion_flag": weak,
    "evidence_slice": spans,
    "normal_opinion_text": normalised,
}

_C = "SELECT * FROM cases WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY name NULLS LAST, decision_date NULLS LAST, court_name NULLS LAST, first_page NULLS LAST, curie NULLS LAST) = 1"
_SLUG = "coalesce(regexp_replace(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '')"
_TOKEN = "upper(regexp_replace(coalesce({}, ''), '[\\s.]+', '', 'g'))"
_GREEDY = "'^([0-9]+)\\s+(.+)\\s+([0-9]+)(.*)$'"
_TOL = "'^([0-9]+)\\s*([A-Za-z0-9.\\s]+?)\\s*([0-9]+)(.*)$'"
_MONTH = "CASE {} " + " ".join(f"WHEN '{m}' THEN '{i:02d}'" for i, m in enumerate(T.MONTHS, 1)) + " END"
_NAMES = "|".join(T.MONTHS)
_US, _EU = f"'^({_NAMES}) ([0-9]{{1,2}}), ?([0-9]{{4}})$'", f"'^([0-9]{{1,2}}) ({_NAMES}),? ([0-9]{{4}})$'"


def _g(pattern: str, i: int, col: str = "t") -> str:
    return f"regexp_extract({col}, {pattern}, {i})"


_WORDS = "list_filter(regexp_split_to_array(text, '[ \\t\\r\\n\\f]+'), lambda w: length(w) > 2)"
_ADDRESS_SQL = "CASE " + " ".join(
    f"WHEN regexp_matches(address, '{p}') THEN 'rcny:{k}' || regexp_extract(address, '^T0*([0-9]+)', 1)" + e
    for (p, k, _), e in zip(
        T.ADDRESSES,
        [
            f" || '-' || {_g(repr(T.ADDRESSES[0][0]), 2, 'address')}", f" || '-App' || {_g(repr(T.ADDRESSES[1][0]), 2, 'address')} || '-' || {_g(repr(T.ADDRESSES[1][0]), 3, 'address')}",
            f" || '-App' || {_g(repr(T.ADDRESSES[2][0]), 2, 'address')}", f" || '-' || {_g(repr(T.ADDRESSES[3][0]), 2, 'address')}",
            f" || {_g(repr(T.ADDRESSES[4][0]), 2, 'address')} || '-' || {_g(repr(T.ADDRESSES[4][0]), 3, 'address')}", f" || '-' || {_g(repr(T.ADDRESSES[5][0]), 2, 'address')} || '-' || {_g(repr(T.ADDRESSES[5][0]), 3, 'address')}",
            f" || '-' || {_g(repr(T.ADDRESSES[6][0]), 2, 'address')}", f" || '-App' || {_g(repr(T.ADDRESSES[7][0]), 2, 'address')}", "",
        ],
        strict=True,
    )
) + " END"

_FLAGS = {
    "legal": f"regexp_matches(lower(text), '{T.LEGAL_WORDS}')",
    "substantial": "len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s: length(trim(s)) > 20)) >= 5",
    "structured": "len(list_filter(regexp_split_to_array(text, '\\n'), lambda s: length(trim(s)) > 10)) >= 3",
    "dense": "len(w) / greatest(length(text), 1) * 1000 > 3 AND len(w) / greatest(length(text), 1) * 1000 < 8",
    "even": "coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / greatest(len(w), 1) > 3 AND coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) / greatest(len(w), 1) < 12",
    "worded": "length(regexp_replace(text, '[^0-9]', '', 'g')) <= length(text) * 0.3::DOUBLE",
    "whole": "len(regexp_extract_all(text, '\\b[a-zA-Z]{1,2}\\b')) <= len(w) * 0.4::DOUBLE",
    # the SQL engine's patterns have no back-references: each letter five times
    "varied": "NOT regexp_matches(text, '" + "|".join(c * 5 for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") + "')",
}

SQL = {
    "text_quality_flags": f"WITH d AS (SELECT doc_id, text, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), f AS (SELECT doc_id, {', '.join(f'({c}) AS {n}' for n, c in _FLAGS.items())} FROM d) SELECT *, {' + '.join(f'{n}::INT' for n in _FLAGS)} AS score FROM f",
    "curie_slug": f"SELECT id, {_SLUG.format('name')} AS slug FROM ({_C})",
    "curie_occurrence_suffix": f"""WITH b AS (SELECT id, regexp_extract(file_name, '^([a-z0-9]+)_', 1) || ':' || regexp_extract(file_name, '_([0-9]+)', 1) || ':' || first_page
  || CASE WHEN {_SLUG.format("regexp_replace(name_abbreviation, ' .*', '')")} = '' THEN '' ELSE ':' || {_SLUG.format("regexp_replace(name_abbreviation, ' .*', '')")} END AS base
  FROM ({_C}) WHERE file_name IS NOT NULL AND regexp_extract(file_name, '^([a-z0-9]+)_', 1) <> ''),
n AS (SELECT id, base, row_number() OVER (PARTITION BY base ORDER BY id) AS n FROM b WHERE base IS NOT NULL)
SELECT id, CASE WHEN n = 1 THEN base WHEN n < 10 THEN base || ':0' || n ELSE base || ':' || n END AS curie FROM n""",
    "opinion_curie": f"""SELECT DISTINCT id, CASE WHEN opinion_index >= 0 THEN case_id || '#' || opinion_index || '-' || CASE WHEN {_SLUG.format('opinion_type')} = '' THEN 'opinion' ELSE {_SLUG.format('opinion_type')} END
  || CASE WHEN {_SLUG.format("split_part(author, ',', 1)")} = '' THEN '' ELSE '-' || {_SLUG.format("split_part(author, ',', 1)")} END END AS curie FROM opinions""",
    "slip_op_curie": f"""WITH c AS (SELECT id, substr(decision_date, 1, 4) AS y, regexp_extract(docket_number, '([0-9]+)', 1) AS n FROM ({_C}))
SELECT id, 'slip' || CASE WHEN id % 3 = 0 THEN 'u' ELSE '' END || ':' || y || ':' || CASE WHEN regexp_matches(n, '^[0-9]+$') THEN CAST(CAST(n AS BIGINT) AS VARCHAR) END AS curie,
  y || ' Slip Op ' || CASE WHEN length(n) >= 5 THEN n ELSE lpad(n, 5, '0') END || CASE WHEN id % 3 = 0 THEN '(U)' ELSE '' END AS cite FROM c""",
    "month_name_date": f"""WITH c AS (SELECT id, lower(trim(decision_date)) AS t, try_cast(substr(decision_date, 1, 4) AS INT) AS year FROM ({_C}))
SELECT id, CASE WHEN regexp_matches(t, '^[0-9]{{4}}(-[0-9]{{2}}){{0,2}}$') THEN t
  WHEN regexp_matches(t, {_US}) THEN {_g(_US, 3)} || '-' || {_MONTH.format(_g(_US, 1))} || '-' || lpad({_g(_US, 2)}, 2, '0')
  WHEN regexp_matches(t, {_EU}) THEN {_g(_EU, 3)} || '-' || {_MONTH.format(_g(_EU, 2))} || '-' || lpad({_g(_EU, 1)}, 2, '0') END AS iso, year FROM c""",
    "reporter_parse_rebuild": f"""WITH c AS (SELECT DISTINCT id, cited_case AS t FROM case_citations),
g AS (SELECT id, t, regexp_matches(t, {_GREEDY}) AS ok, try_cast({_g(_GREEDY, 1)} AS INT) AS volume, trim(regexp_replace({_g(_GREEDY, 2)}, '\\s+', ' ', 'g')) AS reporter, try_cast({_g(_GREEDY, 3)} AS INT) AS page, {_g(_GREEDY, 4)} AS tail,
  CASE WHEN regexp_matches(t, {_TOL}) THEN trim(regexp_replace({_g(_TOL, 2)}, '\\s+', ' ', 'g')) END AS tolerant FROM c)
SELECT DISTINCT id, t AS cited_case, CASE WHEN ok THEN volume END AS volume, CASE WHEN ok THEN reporter END AS reporter, CASE WHEN ok THEN page END AS page, tolerant,
  CASE WHEN ok THEN trim(volume || ' X. ' || page || tail) END AS rebuilt, regexp_replace(regexp_replace(t, '\\.\\s+([23]d)', '.\\1', 'g'), '([A-Za-z])([23]d)\\b', '\\1.\\2', 'g') AS dotted FROM g""",
    "citation_validation": f"""WITH c AS (SELECT DISTINCT id, cited_case AS t, reporter FROM case_citations),
k AS (SELECT DISTINCT {_TOKEN.format('canonical')} AS token FROM reporters),
p AS (SELECT *, regexp_matches(t, {_GREEDY}) AS ok, {_TOKEN.format(_g(_GREEDY, 2))} AS token FROM c)
SELECT CASE WHEN t IS NULL THEN 'missing' WHEN NOT ok THEN 'parse_error' WHEN k.token IS NULL THEN 'unknown_reporter' WHEN p.token <> {_TOKEN.format('reporter')} THEN 'reporter_mismatch' ELSE 'ok' END AS status, count(*) AS n
FROM p LEFT JOIN k ON k.token = p.token GROUP BY 1""",
    "reporter_correction_decision": f"""SELECT DISTINCT id, CASE WHEN observed_reporter IS NOT DISTINCT FROM expected_reporter THEN 'none' WHEN {_TOKEN.format('observed_reporter')} = {_TOKEN.format('expected_reporter')} THEN 'format' ELSE 'swap' END AS decision
FROM (SELECT DISTINCT id, observed_reporter, expected_reporter FROM citation_corrections WHERE expected_reporter IS NOT NULL)""",
    "court_class": f"""WITH c AS (SELECT lower(court_name) AS n, court_id FROM ({_C}))
SELECT CASE WHEN contains(n, 'court of appeals') THEN 'appeals' WHEN regexp_matches(n, 'app(ellate)?\\.? div') THEN 'appellate-division' WHEN regexp_matches(n, 'app(ellate)?\\.? term') THEN 'appellate-term'
  WHEN regexp_matches(n, 'sup(reme|\\.)') THEN 'supreme' WHEN regexp_matches(n, 'surr') THEN 'surrogate' WHEN regexp_matches(n, 'fam') THEN 'family'
  WHEN regexp_matches(n, 'city') THEN 'city' WHEN regexp_matches(n, 'county|co\\.') THEN 'county' WHEN n IS NOT NULL THEN 'other' END AS court,
  CASE WHEN contains(n, 'court of appeals') THEN 'NY3d' WHEN contains(n, 'appellate division') THEN 'AD3d' WHEN trim(n) <> '' THEN 'Misc 3d' END AS reporter,
  CASE WHEN contains(n, 'court of appeals') THEN 'ny_supreme' WHEN contains(n, 'appellate division') THEN 'ny_appellate' WHEN trim(n) <> '' THEN 'ny_trial' END AS source_ref,
  CASE WHEN contains(n, 'appellate division') AND NOT contains(n, 'court of appeals') THEN CASE regexp_extract(n, '\\b(first|second|third|fourth)\\b\\s*department', 1) WHEN 'first' THEN 1 WHEN 'second' THEN 2 WHEN 'third' THEN 3 WHEN 'fourth' THEN 4 END END AS department,
  count(*) AS n, count(DISTINCT court_id) AS n_courts FROM c GROUP BY ALL""",
    "canonical_address_curie": f"""WITH a AS (SELECT id, {ADDRESS} AS address FROM ({_C}))
SELECT id, {_ADDRESS_SQL} AS curie, list_aggregate(list_transform(regexp_extract_all(address, '[0-9]+|[^0-9]+'), lambda p: CASE WHEN regexp_matches(p, '^[0-9]') AND length(p) < 6 THEN lpad(p, 6, '0') ELSE p END), 'string_agg', '') AS sort_key FROM a""",
    "ancestor_paths": """WITH e AS (SELECT DISTINCT element_id, string_split(element_id, '/') AS p FROM usc_chunks WHERE element_id IS NOT NULL),
u AS (SELECT DISTINCT array_to_string(p[1:n], '/') AS path, array_to_string(p[1:n], '/') AS q FROM (SELECT p, unnest(range(4, greatest(len(p), 4) + 1)) AS n FROM e))
SELECT path, CASE WHEN regexp_matches(path, '/t[0-9]+$') THEN 'title' WHEN regexp_matches(path, '/ch[0-9]+$') THEN 'chapter' WHEN regexp_matches(path, '/s[0-9][^/]*$') THEN 'section' WHEN regexp_matches(path, '/[a-z]$') THEN 'subsection' ELSE 'part' END AS level,
  len(string_split(path, '/')) AS depth FROM u""",
    "split_heading": """WITH h AS (SELECT DISTINCT heading, '^\\s*(?:§+|Section|Sec\\.?)\\s*([0-9A-Za-z.\\-]*[0-9A-Za-z])\\.?\\s*(.*)$' AS p FROM usc_chunks WHERE heading IS NOT NULL)
SELECT heading, CASE WHEN regexp_matches(heading, '^\\s*(?:§+|Section|Sec\\.?)\\s*([0-9A-Za-z.\\-]*[0-9A-Za-z])\\.?\\s*(.*)$') THEN regexp_extract(heading, '^\\s*(?:§+|Section|Sec\\.?)\\s*([0-9A-Za-z.\\-]*[0-9A-Za-z])\\.?\\s*(.*)$', 1) END AS number,
  CASE WHEN regexp_matches(heading, '^\\s*(?:§+|Section|Sec\\.?)\\s*([0-9A-Za-z.\\-]*[0-9A-Za-z])\\.?\\s*(.*)$') THEN regexp_replace(regexp_extract(heading, '^\\s*(?:§+|Section|Sec\\.?)\\s*([0-9A-Za-z.\\-]*[0-9A-Za-z])\\.?\\s*(.*)$', 2), '[\\s.;,]+$', '') END AS label FROM h""",
    "heading_body_pivot": """SELECT element_id, first(original_text ORDER BY id DESC) FILTER (WHERE content_type = 'heading') AS heading, first(original_text ORDER BY id DESC) FILTER (WHERE content_type = 'body') AS body
FROM usc_chunks WHERE element_id IS NOT NULL GROUP BY element_id""",
    "element_rule_checks": """SELECT count(*) FILTER (WHERE NOT coalesce(regexp_matches(element_id, '^/us/usc/t[0-9]+(/[A-Za-z0-9.\\-]+)*$'), false)) AS identifier, count(*) FILTER (WHERE NOT coalesce(content_type IN ('heading', 'body'), false)) AS type,
  count(*) FILTER (WHERE coalesce(trim(original_text), '') = '') AS empty, count(*) FILTER (WHERE coalesce(regexp_matches(original_text, '^\\([a-z0-9]\\)'), false)) AS marker FROM usc_chunks""",
    "word_chunks": """WITH w AS (SELECT doc_id, regexp_split_to_array(text, '\\s+') AS w FROM documents WHERE text IS NOT NULL),
s AS (SELECT doc_id, w, unnest(range(0, CAST(greatest(ceil((len(w) - 60) / 30.0), 0) AS INT) + 1)) AS i FROM w),
c AS (SELECT doc_id, i, array_to_string(w[i * 30 + 1 : i * 30 + 60], ' ') AS chunk FROM s)
SELECT doc_id, i, length(chunk) AS n_chars, md5(chunk) AS digest FROM c""",
    "char_chunks": """WITH s AS (SELECT doc_id, text, unnest(range(0, CAST(greatest(ceil((length(text) - 512) / 256.0), 0) AS INT) + 1)) AS i FROM documents WHERE text IS NOT NULL AND length(text) > 0),
c AS (SELECT doc_id, i, substr(text, i * 256 + 1, 512) AS chunk FROM s)
SELECT doc_id, i, length(chunk) AS n_chars, md5(chunk) AS digest FROM c""",
    "chunk_dedup_reindex": """SELECT element_id, content_type, row_number() OVER (PARTITION BY element_id, content_type ORDER BY chunk_index, heading NULLS FIRST, original_text NULLS FIRST) - 1 AS n, md5(coalesce(original_text, '')) AS digest
FROM (SELECT DISTINCT element_id, chunk_index, content_type, heading, original_text FROM usc_chunks WHERE element_id IS NOT NULL)""",
    "stopword_removal": f"""SELECT id, array_to_string(list_filter(regexp_split_to_array(original_text, '\\s+'), lambda w: lower(w) NOT IN ({', '.join(repr(w) for w in T.STOP_WORDS)})), ' ') AS text, CAST(ceil(length(original_text) / 4.0) AS BIGINT) AS tokens
FROM usc_chunks WHERE original_text IS NOT NULL""",
    "weak_opinion_flag": """WITH o AS (SELECT DISTINCT id, case_id, coalesce(text, '') AS text FROM opinions WHERE case_id IS NOT NULL),
m AS (SELECT case_id, text AS longest FROM o QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY length(text) DESC, text DESC) = 1),
n AS (SELECT id, length(regexp_replace(text, '[ \\t\\r\\n\\f]+', '', 'g')) AS a, length(regexp_replace(longest, '[ \\t\\r\\n\\f]+', '', 'g')) AS b FROM o JOIN m USING (case_id))
SELECT id, a >= 100 AND a / greatest(b, 1) >= 0.3 AS substantial FROM n""",
    "evidence_slice": """SELECT doc_id, md5(CASE WHEN doc_id % 97 + 120 <= length(text) THEN substr(text, CAST(doc_id % 97 AS INT) + 1, 120) END) AS digest FROM documents WHERE text IS NOT NULL""",
    "normal_opinion_text": """WITH o AS (SELECT DISTINCT id, trim(regexp_replace(regexp_replace(coalesce(text, ''), '-\\s*\\n\\s*', '', 'g'), '[ \\t\\r\\n\\f]+', ' ', 'g')) AS t FROM (SELECT DISTINCT id, text FROM opinions))
SELECT id, length(t) AS n, sha256(t) AS digest FROM o""",
}
