"""Queries of spans, payload states, trees, set operations, predicates and reports, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import merge as M
from ..operators import spans
from ..operators.ids import dense_ids, first_by, tree_depths
from ..operators.search import one_row_each
from ..sources.tables import table
from .text_queries import _C, _cases

LINE = """CASE o_orderkey % 4 WHEN 0 THEN '{"custom_id":"opinion_' || o_orderkey || '","error":{"code":"rate_limit","message":"m"}}'
  WHEN 1 THEN '{"custom_id":"opinion_' || o_orderkey || '","content":"{broken"}' WHEN 2 THEN '{"custom_id":"opinion_' || o_orderkey || '","content":{"valueless":true}}'
  ELSE '{"custom_id":"opinion_' || o_orderkey || '","content":{"valueless":false,"f":[1,2]}}' END"""


def batch_states(spark: SparkSession, d: str) -> DataFrame:
    """What became of each answer line of a batch: an error, no JSON, a valueless text, an invalid answer, or ok."""
    lines = table(spark, d, "orders").select("o_orderkey", F.expr(LINE).alias("line"))
    x = lines.withColumn("error", F.get_json_object("line", "$.error.code")).withColumn("content", F.get_json_object("line", "$.content"))
    p = x.withColumn("p", F.from_json("content", "struct<valueless:boolean,f:array<int>>"))
    state = (
        F.when(F.col("error").isNotNull(), "api_error").when(F.col("content").isNull(), "no_content").when(F.try_parse_json("content").isNull(), "parse_error")
        .when(F.col("p.valueless"), "valueless").when(F.coalesce(F.size("p.f"), F.lit(-1)) <= 0, "invalid").otherwise("ok")
    )
    return p.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"), F.min(F.regexp_extract("line", "opinion_([0-9]+)", 1).cast("long")).alias("first_id"))


def descriptors(spark: SparkSession, d: str) -> DataFrame:
    """Distinct descriptors with ids, and each row pointing to its one."""
    rows = table(spark, d, "source_keywords").where("keyword_text is not null").select("id", F.trim("keyword_text").alias("text"))
    ids = dense_ids(rows.select("text").distinct(), ["text"], "descriptor_id")
    return rows.join(ids, "text").select("id", "descriptor_id")


def _breaks(spark: SparkSession, d: str) -> DataFrame:
    marks = F.transform(F.from_json("page_breaks", "array<struct<offset:bigint>>"), lambda x: x.offset)
    s = table(spark, d, "stage_opinions").where("page_breaks is not null and text is not null").select("curie", "text", "page_breaks")
    s = first_by(s, ["curie"], ["page_breaks", "text"])
    return s.select("curie", "text", F.filter(marks, lambda m: m.isNotNull()).alias("marks"))


def page_lookup(spark: SparkSession, d: str) -> DataFrame:
    b = _breaks(spark, d).select("curie", "marks", F.explode(F.array(*(F.lit(k) for k in (100, 1500, 4000)))).alias("at"))
    return b.select("curie", F.col("at").alias("place"), spans.page_at(F.col("marks"), F.col("at")).alias("page"))


def page_segments(spark: SparkSession, d: str) -> DataFrame:
    b = _breaks(spark, d).select("curie", F.posexplode(spans.segments(F.col("text"), F.col("marks"))).alias("n", "segment"))
    return b.select("curie", "n", F.length("segment").alias("length"), F.md5("segment").alias("digest"))


def free_spans(spark: SparkSession, d: str) -> DataFrame:
    """What the line items of an order, laid out as spans, leave free."""
    li = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 10).alias("start"), (F.col("l_linenumber") * 10 + F.col("l_quantity").cast("int") % 15).alias("end"), F.lit(100).alias("length"))
    return spans.complement(li, ["l_orderkey"], "length").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("end") - F.col("start")).alias("free"))


def footnotes(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", F.col("l_quantity").cast("int").alias("q")))), lambda x: x.q).alias("marks"))
    return li.select("l_orderkey", F.array_join(spans.plausible_sequence(F.col("marks")), ",").alias("kept"))


def paired(spark: SparkSession, d: str) -> DataFrame:
    """The view nearest before each purchase, not one that an earlier purchase had, within two hours."""
    e = table(spark, d, "events").withColumn("sec", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    buys = e.where("event_type = 'purchase'").select("event_id", "user_id", "sec")
    views = first_by(e.where("event_type = 'view'").select("user_id", "sec", F.col("event_id").alias("view_id")), ["user_id", "sec"], [F.desc("view_id")])
    return spans.preceding(buys, views, ["user_id"], "sec", "view_id", 7200).select("event_id", "view_id")


def prefix_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many elements stand at or below each path."""
    e = table(spark, d, "usc_chunks").where("element_id is not null").select("element_id").distinct()
    parts = F.split("element_id", "/")
    prefixes = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return e.select(F.explode(prefixes).alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def court_report(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).where("decision_date <> ''")
    return c.groupBy("court_id").agg(F.count(F.lit(1)).alias("n"), F.min("decision_date").alias("first"), F.max("decision_date").alias("last")).orderBy(F.desc("n"), F.asc_nulls_last("court_id")).limit(10)


def worst_volumes(spark: SparkSession, d: str) -> DataFrame:
    """Volumes whose corrections change the reporter most often."""
    c = table(spark, d, "citation_corrections").select("id", "file_volume", "observed_reporter", "expected_reporter").distinct()
    g = c.groupBy("file_volume").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("expected_reporter").isNotNull() & (T.reporter_token(F.col("observed_reporter")) != T.reporter_token(F.col("expected_reporter")))).alias("bad"))
    return g.where("n >= 2 and bad > 0").select("file_volume", "n", "bad", F.round(F.col("bad") / F.col("n"), 6).alias("rate")).orderBy(F.desc("rate"), F.desc("n"), "file_volume").limit(15)


def token_report(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("text is not null").select("doc_type", T.token_estimate(F.col("text")).alias("t"))
    return t.groupBy("doc_type").agg(F.min("t").alias("least"), F.max("t").alias("most"), F.round(F.avg("t"), 4).alias("mean"), F.sum("t").alias("total"))


def completion(spark: SparkSession, d: str) -> DataFrame:
    """The share of embedded chunks by kind."""
    u = table(spark, d, "usc_chunks")
    return u.groupBy("content_type").agg(F.count(F.lit(1)).alias("n"), F.count("embedding").alias("done"), F.round(F.count("embedding") * 100.0 / F.count(F.lit(1)), 2).alias("pct"))


def override(spark: SparkSession, d: str) -> DataFrame:
    """Court departments of one source, replaced by another's where that has three votes or more."""
    from ..operators.voting import roster

    c = _cases(spark, d)
    static, volume = (roster(c.where(F.col("source_ref") == s), "court_id", "court_department") for s in ("ny_supreme", "ny_trial"))
    b = volume.select("court_id", F.col("court_department").alias("v"), F.col("n").alias("vn"))
    return static.select("court_id", F.col("court_department").alias("s")).join(b, "court_id", "full").select("court_id", F.coalesce(F.when(F.col("vn") >= 3, F.col("v")), F.col("s")).alias("department"))


def set_ops(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "opinions").select("curie").where("curie is not null")
    b = table(spark, d, "opinion_keywords").select(F.col("opinion_curie").alias("curie"))
    c = table(spark, d, "stage_opinions").select("curie").where("curie is not null")
    out = None
    for name, x in (("both", a.intersect(b)), ("only_opinions", a.exceptAll(b).distinct()), ("scanned_without_keywords", c.subtract(b)), ("any", a.union(b).union(c).distinct())):
        row = x.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def predicates(spark: SparkSession, d: str) -> DataFrame:
    """Counts under the filters that the searches compose."""
    c = table(spark, d, "case_citations")
    pins = F.from_json("pin_cites", "array<struct<page:string>>")
    rules = {
        "in_list": F.col("reporter").isin("Tam.", "Tam.2d"), "not_in_list": ~F.col("reporter").isin("Tam.", "Tam.2d"), "null_or_equal": F.col("category").isNull() | (F.col("category") == "reporters:state"),
        "distinct_from": ~F.col("category").eqNullSafe(F.lit("reporters:state")), "json_exists": F.exists(pins, lambda p: p.page.try_cast("int") > 500), "array_has": F.exists("cited_case_ids", lambda x: x == F.col("case_id")),
        "prefix": F.col("cited_case").like("1%"), "pattern": F.col("cited_case").rlike(r"2d\b"), "anycase": F.ilike("cited_case", F.lit("%tam%")), "recent": F.col("created_at") >= F.to_timestamp_ntz(F.lit("2022-01-01 00:00:00")) - F.expr("INTERVAL 30 DAYS"),
    }
    return c.agg(*(F.count_if(r).alias(n) for n, r in rules.items()))


def richest(spark: SparkSession, d: str) -> DataFrame:
    """Cases by citations, span of pages, length of text and id."""
    c = _cases(spark, d).select("id", F.coalesce(F.col("last_page").try_cast("int") - F.col("first_page").try_cast("int"), F.lit(0)).alias("pages"))
    n = table(spark, d, "case_citations").groupBy(F.col("case_id").alias("id")).agg(F.countDistinct("id").alias("cites"))
    t = table(spark, d, "opinions").groupBy(F.col("case_id").alias("id")).agg(F.max(F.length("text")).alias("chars"))
    rows = c.join(n, "id", "left").join(t, "id", "left").select("id", F.coalesce("cites", F.lit(0)).alias("cites"), "pages", F.coalesce("chars", F.lit(0)).alias("chars"))
    return rows.orderBy(F.desc("cites"), F.desc("pages"), F.desc("chars"), "id").limit(25)


def depths(spark: SparkSession, d: str) -> DataFrame:
    """The depth of each element in the tree of those present; one whose parent is missing is a root."""
    e = table(spark, d, "usc_chunks").where("element_id is not null").select(F.col("element_id").alias("id")).distinct().withColumn("parent", F.regexp_replace("id", "/[^/]*$", ""))
    return tree_depths(e).select("id", F.col("depth").cast("int").alias("depth"))


def overlap(spark: SparkSession, d: str) -> DataFrame:
    """Shared words of a case's name and its abbreviation, and their share."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace(c, "[^A-Za-z ]", " ")), " +"), lambda w: F.length(w) > 2))
    c = _cases(spark, d).select("id", words(F.col("name")).alias("a"), words(F.col("name_abbreviation")).alias("b")).where("a is not null and b is not null")
    return c.select("id", F.size(F.array_intersect("a", "b")).alias("shared"), F.round(F.size(F.array_intersect("a", "b")) / F.greatest(F.size("b"), F.lit(1)), 6).alias("share"))


def created_keywords(spark: SparkSession, d: str) -> DataFrame:
    """Keywords found or made from texts typed: counted up where they exist, new ones with the number of times typed."""
    old = table(spark, d, "keywords").select(F.col("keyword_text").alias("text"), "tier", F.col("frequency").cast("long").alias("frequency"))
    typed = table(spark, d, "source_keywords").where("keyword_text is not null").select(F.lower(F.trim("keyword_text")).alias("text"), "tier", "id")
    new = typed.groupBy("text").agg(F.max_by("tier", F.when(F.col("tier").isNotNull(), F.col("id"))).alias("tier"), F.count(F.lit(1)).alias("frequency"))
    return M.upsert(old, new, ["text"], add=["frequency"]).select("text", "tier", "frequency")


def cascaded(spark: SparkSession, d: str) -> DataFrame:
    """What is left of jobs and requests when the failed jobs go."""
    gone = table(spark, d, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    jobs = table(spark, d, "orders").join(gone, "o_orderkey", "left_anti").agg(F.lit("jobs").alias("kind"), F.count(F.lit(1)).alias("n"))
    li = table(spark, d, "lineitem")
    return jobs.unionByName(li.join(gone, li.l_orderkey == gone.o_orderkey, "left_anti").agg(F.lit("requests").alias("kind"), F.count(F.lit(1)).alias("n")))


def search_documents(spark: SparkSession, d: str) -> DataFrame:
    """The words of each case's name and latest opinion that a text search would index."""
    c = _cases(spark, d).select(F.col("id").alias("case_id"), F.coalesce("name", F.lit("")).alias("name"))
    o = first_by(table(spark, d, "opinions").where("case_id is not null").select("case_id", "id", "text", "created_at"), ["case_id"], [F.desc_nulls_last("created_at"), F.desc("id"), F.asc_nulls_last("text")])
    doc = F.concat_ws(" ", "name", F.coalesce("text", F.lit("")))
    words = F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(doc), F.lit("([a-z0-9]+)"), F.lit(1))), F.array(*map(F.lit, T.STOP_WORDS)))
    return c.join(o, "case_id").select("case_id", F.size(words).alias("n_lexemes"), F.md5(F.array_join(F.array_sort(words), " ")).alias("digest"))


def sliding(spark: SparkSession, d: str) -> DataFrame:
    """Events of the same kind in the 24 hours up to each error."""
    e = table(spark, d, "events").where("event_type = 'error'").withColumn("sec", F.unix_seconds(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("user_id").orderBy("sec").rangeBetween(-86400, 0)
    return e.select("event_id", F.count(F.lit(1)).over(w).alias("n_day"))


def first_citation(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "case_citations").where("case_id is not null and cited_case is not null")
    first = c.groupBy(F.col("case_id").alias("id")).agg(F.min(F.struct("id", "cited_case")).alias("f")).select("id", "f.cited_case")
    return _cases(spark, d).select("id").join(first, "id", "left").select("id", "cited_case")


def tier_queue(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "source_keywords")
    bad = ~F.coalesce(F.col("tier").isin("field_of_law", "major_doctrine", "legal_concept"), F.lit(False))
    return k.where(bad).select("id", F.coalesce("tier", F.lit("")).alias("tier")).distinct()


def monitoring(spark: SparkSession, d: str) -> DataFrame:
    """How far the keyword work of each source is, and what to do."""
    o = one_row_each(table(spark, d, "opinions").where("not coalesce(is_valueless, false)"), "id", "curie", "source_ref")
    done = table(spark, d, "opinion_keywords").select(F.col("opinion_curie").alias("curie")).distinct().withColumn("done", F.lit(1))
    g = o.join(done, "curie", "left").groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"), F.count("done").alias("done"))
    left = F.col("n") - F.col("done")
    advice = F.when(left == 0, "finished").when(left > F.col("n") * 0.5, "add workers").when(left > F.col("n") * 0.1, "keep going").otherwise("nearly done")
    return g.select("source_ref", "n", "done", F.round(F.col("done") * 100.0 / F.col("n"), 1).alias("pct"), advice.alias("advice"))


QUERIES = {
    "batch_result_states": batch_states, "descriptor_normalisation": descriptors, "offset_page_lookup": page_lookup, "marker_segments": page_segments, "span_complement": free_spans, "footnote_plausibility": footnotes,
    "nearest_preceding_pairing": paired, "path_prefix_counts": prefix_counts, "court_report": court_report, "worst_volumes": worst_volumes, "token_report": token_report, "completion_percentage": completion, "roster_override": override,
    "set_operations": set_ops, "predicate_counts": predicates, "richness_order": richest, "tree_depth": depths, "token_overlap": overlap, "get_or_create_keyword": created_keywords, "cascade_delete": cascaded, "search_documents": search_documents,
    "sliding_24h": sliding, "first_citation": first_citation, "tier_queue": tier_queue, "monitoring_advice": monitoring,
}

_B = """b AS (SELECT curie, text, list_filter(list_transform(from_json(page_breaks, '[{"offset":"BIGINT"}]'), lambda x: x.offset), lambda m: m IS NOT NULL) AS marks
  FROM (SELECT curie, text, page_breaks FROM stage_opinions WHERE page_breaks IS NOT NULL AND text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY curie ORDER BY page_breaks, text) = 1))"""
_TOKEN = "upper(regexp_replace(coalesce({}, ''), '[\\s.]+', '', 'g'))"
_ROSTER = "(SELECT court_id, court_department, n FROM (SELECT court_id, court_department, count(*) AS k, sum(count(*)) OVER (PARTITION BY court_id) AS n, row_number() OVER (PARTITION BY court_id ORDER BY count(*) DESC, court_department) AS rn FROM c WHERE source_ref = '{}' AND court_id IS NOT NULL AND court_department IS NOT NULL GROUP BY court_id, court_department) WHERE rn = 1)"

SQL = {
    "batch_result_states": "SELECT CASE o_orderkey % 4 WHEN 0 THEN 'api_error' WHEN 1 THEN 'parse_error' WHEN 2 THEN 'valueless' ELSE 'ok' END AS state, count(*) AS n, min(o_orderkey) AS first_id FROM orders GROUP BY 1",
    "descriptor_normalisation": "WITH r AS (SELECT id, trim(keyword_text) AS t FROM source_keywords WHERE keyword_text IS NOT NULL), i AS (SELECT t, row_number() OVER (ORDER BY t) AS descriptor_id FROM (SELECT DISTINCT t FROM r)) SELECT id, descriptor_id FROM r JOIN i USING (t)",
    "offset_page_lookup": f"WITH {_B} SELECT curie, v.k AS place, len(list_filter(marks, lambda m: m <= v.k)) AS page FROM b, (VALUES (100), (1500), (4000)) v(k)",
    "marker_segments": f"""WITH {_B}, s AS (SELECT curie, text, list_concat([0], list_sort(list_distinct(list_filter(marks, lambda m: m > 0 AND m < length(text))))) AS st FROM b),
e AS (SELECT curie, text, st, unnest(range(1, len(st) + 1)) AS i FROM s), g AS (SELECT curie, i - 1 AS n, substr(text, st[i] + 1, coalesce(st[i + 1], length(text)) - st[i]) AS segment FROM e)
SELECT curie, n, length(segment) AS length, md5(segment) AS digest FROM g""",
    "span_complement": """WITH s AS (SELECT l_orderkey AS k, l_linenumber * 10 AS a, l_linenumber * 10 + CAST(trunc(l_quantity) AS INT) % 15 AS z FROM lineitem),
f AS (SELECT *, CASE WHEN max(z) OVER w IS NULL OR a > max(z) OVER w THEN 1 ELSE 0 END AS f FROM s WINDOW w AS (PARTITION BY k ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, sum(f) OVER (PARTITION BY k ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS g FROM f), m AS (SELECT k, min(a) AS a, max(z) AS z FROM g GROUP BY k, g),
c AS (SELECT k, coalesce(lag(z) OVER (PARTITION BY k ORDER BY a), 0) AS a, a AS z FROM m UNION ALL SELECT k, max(z), 100 FROM m GROUP BY k)
SELECT k AS l_orderkey, count(*) AS n, CAST(sum(z - a) AS BIGINT) AS free FROM c WHERE z > a GROUP BY k""",
    "nearest_preceding_pairing": """WITH v AS (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY ALL),
p AS (SELECT event_id, user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events WHERE event_type = 'purchase')
SELECT event_id, (SELECT CASE WHEN epoch(p.ts) - epoch(max(v.ts)) <= 7200 THEN arg_max(view_id, v.ts) END FROM v WHERE v.user_id = p.user_id AND v.ts <= p.ts AND (before IS NULL OR v.ts > before)) AS view_id FROM p""",
    "path_prefix_counts": """WITH e AS (SELECT DISTINCT element_id, string_split(element_id, '/') AS p FROM usc_chunks WHERE element_id IS NOT NULL),
u AS (SELECT array_to_string(p[1:n], '/') AS path FROM (SELECT p, unnest(range(2, len(p) + 1)) AS n FROM e)) SELECT path, count(*) AS n FROM u GROUP BY 1""",
    "court_report": f"SELECT court_id, count(*) AS n, min(decision_date) AS first, max(decision_date) AS last FROM ({_C}) WHERE decision_date <> '' GROUP BY 1 ORDER BY n DESC, court_id NULLS LAST LIMIT 10",
    "worst_volumes": f"""WITH c AS (SELECT DISTINCT id, file_volume, observed_reporter, expected_reporter FROM citation_corrections),
g AS (SELECT file_volume, count(*) AS n, count(*) FILTER (WHERE expected_reporter IS NOT NULL AND {_TOKEN.format('observed_reporter')} <> {_TOKEN.format('expected_reporter')}) AS bad FROM c GROUP BY 1)
SELECT file_volume, n, bad, round(bad / n, 6) AS rate FROM g WHERE n >= 2 AND bad > 0 ORDER BY rate DESC, n DESC, file_volume LIMIT 15""",
    "token_report": "WITH t AS (SELECT doc_type, CAST(ceil(length(text) / 4.0) AS BIGINT) AS t FROM documents WHERE text IS NOT NULL) SELECT doc_type, min(t) AS least, max(t) AS most, round(avg(t), 4) AS mean, CAST(sum(t) AS BIGINT) AS total FROM t GROUP BY 1",
    "completion_percentage": "SELECT content_type, count(*) AS n, count(embedding) AS done, round(count(embedding) * 100.0 / count(*), 2) AS pct FROM usc_chunks GROUP BY 1",
    "roster_override": f"""WITH c AS ({_C}), s AS {_ROSTER.format('ny_supreme')}, v AS {_ROSTER.format('ny_trial')}
SELECT coalesce(s.court_id, v.court_id) AS court_id, coalesce(CASE WHEN v.n >= 3 THEN v.court_department END, s.court_department) AS department FROM s FULL JOIN v ON s.court_id = v.court_id""",
    "set_operations": """WITH a AS (SELECT curie FROM opinions WHERE curie IS NOT NULL), b AS (SELECT opinion_curie AS curie FROM opinion_keywords), c AS (SELECT curie FROM stage_opinions WHERE curie IS NOT NULL)
SELECT 'both' AS name, count(*) AS n FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'only_opinions', count(*) FROM (SELECT DISTINCT curie FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b))
UNION ALL SELECT 'scanned_without_keywords', count(*) FROM (SELECT * FROM c EXCEPT SELECT * FROM b) UNION ALL SELECT 'any', count(*) FROM (SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM c)""",
    "predicate_counts": """SELECT count(*) FILTER (WHERE reporter IN ('Tam.', 'Tam.2d')) AS in_list, count(*) FILTER (WHERE reporter NOT IN ('Tam.', 'Tam.2d')) AS not_in_list, count(*) FILTER (WHERE category IS NULL OR category = 'reporters:state') AS null_or_equal,
  count(*) FILTER (WHERE category IS DISTINCT FROM 'reporters:state') AS distinct_from, count(*) FILTER (WHERE len(list_filter(from_json(pin_cites, '[{"page":"VARCHAR"}]'), lambda p: try_cast(p.page AS INT) > 500)) > 0) AS json_exists,
  count(*) FILTER (WHERE list_contains(cited_case_ids, case_id)) AS array_has, count(*) FILTER (WHERE cited_case LIKE '1%') AS prefix, count(*) FILTER (WHERE regexp_matches(cited_case, '2d\\b')) AS pattern, count(*) FILTER (WHERE cited_case ILIKE '%tam%') AS anycase,
  count(*) FILTER (WHERE created_at >= TIMESTAMP '2022-01-01' - INTERVAL 30 DAYS) AS recent FROM case_citations""",
    "richness_order": f"""WITH n AS (SELECT case_id, count(DISTINCT id) AS cites FROM case_citations GROUP BY 1), t AS (SELECT case_id, max(length(text)) AS chars FROM opinions GROUP BY 1)
SELECT c.id, coalesce(cites, 0) AS cites, coalesce(try_cast(last_page AS INT) - try_cast(first_page AS INT), 0) AS pages, coalesce(chars, 0) AS chars FROM ({_C}) c LEFT JOIN n ON n.case_id = c.id LEFT JOIN t ON t.case_id = c.id
ORDER BY cites DESC, pages DESC, chars DESC, c.id LIMIT 25""",
    "tree_depth": """WITH RECURSIVE e AS (SELECT DISTINCT element_id AS id, regexp_replace(element_id, '/[^/]*$', '') AS parent FROM usc_chunks WHERE element_id IS NOT NULL),
t AS (SELECT id, 0 AS depth FROM e WHERE parent NOT IN (SELECT id FROM e) UNION ALL SELECT e.id, t.depth + 1 FROM e JOIN t ON e.parent = t.id) SELECT id, depth FROM t""",
    "token_overlap": f"""WITH c AS (SELECT id, list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(name, '[^A-Za-z ]', ' ', 'g')), ' +'), lambda w: length(w) > 2)) AS a,
  list_distinct(list_filter(regexp_split_to_array(lower(regexp_replace(name_abbreviation, '[^A-Za-z ]', ' ', 'g')), ' +'), lambda w: length(w) > 2)) AS b FROM ({_C}) WHERE name IS NOT NULL AND name_abbreviation IS NOT NULL)
SELECT id, len(list_intersect(a, b)) AS shared, round(len(list_intersect(a, b)) / greatest(len(b), 1), 6) AS share FROM c""",
    "get_or_create_keyword": """WITH n AS (SELECT lower(trim(keyword_text)) AS text, first(tier ORDER BY id DESC) FILTER (WHERE tier IS NOT NULL) AS tier, count(*) AS f FROM source_keywords WHERE keyword_text IS NOT NULL GROUP BY 1)
SELECT coalesce(k.keyword_text, n.text) AS text, coalesce(n.tier, k.tier) AS tier, CAST(coalesce(k.frequency, 0) + coalesce(n.f, 0) AS BIGINT) AS frequency FROM keywords k FULL JOIN n ON n.text = k.keyword_text""",
    "cascade_delete": """SELECT 'jobs' AS kind, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL
UNION ALL SELECT 'requests', count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')""",
    "search_documents": f"""WITH o AS (SELECT case_id, text FROM opinions WHERE case_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY created_at DESC NULLS LAST, id DESC, text NULLS LAST) = 1),
w AS (SELECT c.id AS case_id, list_sort(list_filter(list_distinct(regexp_extract_all(lower(coalesce(name, '') || ' ' || coalesce(text, '')), '[a-z0-9]+')), lambda w: w NOT IN ({', '.join(repr(x) for x in T.STOP_WORDS)}))) AS w FROM ({_C}) c JOIN o ON o.case_id = c.id)
SELECT case_id, len(w) AS n_lexemes, md5(array_to_string(w, ' ')) AS digest FROM w""",
    "sliding_24h": "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n_day FROM events WHERE event_type = 'error'",
    "first_citation": f"SELECT c.id, f.cited_case FROM ({_C}) c LEFT JOIN (SELECT case_id, cited_case FROM case_citations WHERE case_id IS NOT NULL AND cited_case IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY id, cited_case) = 1) f ON f.case_id = c.id",
    "tier_queue": "SELECT DISTINCT id, coalesce(tier, '') AS tier FROM source_keywords WHERE tier IS NULL OR tier NOT IN ('field_of_law', 'major_doctrine', 'legal_concept')",
    "monitoring_advice": """WITH o AS (SELECT id, min(curie) AS curie, min(source_ref) AS source_ref FROM opinions WHERE NOT coalesce(is_valueless, false) AND id IS NOT NULL GROUP BY id),
g AS (SELECT source_ref, count(*) AS n, count(*) FILTER (WHERE curie IN (SELECT opinion_curie FROM opinion_keywords)) AS done FROM o GROUP BY 1)
SELECT source_ref, n, done, round(done * 100.0 / n, 1) AS pct, CASE WHEN n = done THEN 'finished' WHEN n - done > n * 0.5 THEN 'add workers' WHEN n - done > n * 0.1 THEN 'keep going' ELSE 'nearly done' END AS advice FROM g""",
}
