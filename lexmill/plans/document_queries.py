"""Queries over documents, captions, bylines and files of records, with SQL."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payload as P
from ..operators import documents as D
from ..operators import volumes as V
from ..operators.ids import first_by
from ..sources import archives, markup, sinks
from ..sources.tables import table

ENDS = ["(?i)judgment affirmed", "(?i)it is so ordered", "(?i)with costs"]


def _cases(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return first_by(table(spark, d, "cases").where("id is not null"), ["id"], [F.asc_nulls_last(c) for c in cols]).select("id", *cols)


def _c(*cols: str) -> str:
    return f"(SELECT id, {', '.join(cols)} FROM cases WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY {', '.join(f'{c} NULLS LAST' for c in cols)}) = 1)"


def _opinions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "opinions").where("id is not null and text is not null").groupBy("id").agg(F.min("text").alias("text"))


_O = "(SELECT id, min(text) AS text FROM opinions WHERE id IS NOT NULL AND text IS NOT NULL GROUP BY id)"


def caption_scalars(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d, "name", "name_abbreviation", "docket_number")
    return c.select("id", D.matter_name(F.col("name")).alias("matter"), D.docket_of(F.concat(F.lit("Index No. "), F.col("docket_number"))).alias("docket"), D.fallback(F.col("name_abbreviation"), F.col("name"), F.col("docket_number")).alias("shown"))


def bylines(spark: SparkSession, d: str) -> DataFrame:
    first = F.split("text", "\n")[0]
    volume = D.volume_of(F.col("text"))
    return _opinions(spark, d).select("id", V.opinion_kind(first).alias("kind"), V.author_of(first).alias("author"), volume["volume"].alias("volume"), volume["series"].alias("series"), D.first_of(F.col("text"), ENDS).alias("end"))


def opinion_sections(spark: SparkSession, d: str) -> DataFrame:
    """Texts cut at lines that begin as a finding of the court does."""
    lines = _opinions(spark, d).select(F.col("id").alias("case_id"), F.posexplode(F.split("text", "\n")).alias("n", "text"))
    return V.opinions_of(lines, r"^\s*(Judgment|Appeal|The motion|There is)\b").select("case_id", "opinion_index", "kind", F.md5("text").alias("digest"))


def fronts(spark: SparkSession, d: str) -> DataFrame:
    x = D.front_and_body(F.col("text"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", x["title"].alias("title"), F.length(x["body"]).alias("n_body"))


def pins(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "case_citations").where("pin_cites is not null").select("id", F.array_join(V.split_marker(F.col("pin_cites")), "|").alias("pins")).distinct()


def unit_curies(spark: SparkSession, d: str) -> DataFrame:
    x = D.law_curies(F.col("canonical"), F.col("aliases"), "section", F.col("reporter_id").cast("string"))
    return table(spark, d, "reporters").select("reporter_id", x["primary"].alias("curie"), F.array_join(F.sort_array(x["aliases"]), " ").alias("others"))


def answer_rows(spark: SparkSession, d: str) -> DataFrame:
    """Assignments as a model's answers, each with an introduction before its JSON, and back to rows."""
    k = table(spark, d, "opinion_keywords").where("opinion_curie is not null").join(table(spark, d, "keywords").select(F.col("id").alias("keyword_id"), "keyword_text").distinct(), "keyword_id")
    item = lambda c: F.collect_list(F.when(F.col("category") == c, F.struct(F.concat(F.lit(" "), F.upper("keyword_text")).alias("keyword"), F.col("relevance_score").alias("relevance"))))
    said = k.groupBy(F.col("opinion_curie").alias("id")).agg(F.concat(F.lit("Here is the answer:\n"), F.to_json(F.struct(item("doctrine").alias("doctrine"), item("field_of_law").alias("field_of_law")))).alias("answer"))
    return P.keyword_rows(said.select("id", P.json_in(P.truncated(F.col("answer"), 1_000_000)).alias("json")), "json", ["doctrine", "field_of_law"])


def outline(spark: SparkSession, d: str) -> DataFrame:
    """Keywords as an outline by tier and first letter, and the outline read again."""
    k = table(spark, d, "keywords").where("tier is not null and keyword_text is not null").select("tier", F.substring("keyword_text", 1, 1).alias("letter"), "keyword_text").distinct()
    part = k.groupBy("tier", "letter").agg(F.array_join(F.transform(F.sort_array(F.collect_list("keyword_text")), lambda x: F.concat(F.lit("- "), x)), "\n").alias("items"))
    text = part.groupBy("tier").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("letter", "items"))), lambda x: F.concat(F.lit("### "), x.letter, F.lit("\n"), x["items"])), "\n").alias("body"))
    return D.outlined(text.select(F.col("tier").alias("id"), F.concat(F.lit("## "), F.col("tier"), F.lit("\n"), F.col("body")).alias("text"))).select("category", "subcategory", "item")


HARD = {"no_name": "coalesce(trim(name), '') = ''", "no_first_page": "first_page is null", "page_not_number": "try_cast(first_page as int) is null and first_page is not null", "pages_reversed": "try_cast(last_page as int) < try_cast(first_page as int)", "no_curie": "curie is null"}
SOFT = {"no_docket": "docket_number is null", "no_date": "decision_date is null", "partial_date": "length(decision_date) < 10", "no_court": "court_id is null", "long_name": "length(name) > 120", "many_pages": "try_cast(last_page as int) - try_cast(first_page as int) > 100"}


def rule_report(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d, "name", "first_page", "last_page", "curie", "docket_number", "decision_date", "court_id")
    return P.rule_report(c, {n: F.expr(e) for n, e in HARD.items()}, {n: F.expr(e) for n, e in SOFT.items()})


def _zipped(pdf: pd.DataFrame) -> pd.DataFrame:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, body in sorted(zip(pdf["id"], pdf["body"], strict=True)):
            z.writestr(f"json/{i}.json", body)
        z.writestr("html/1.html", "<p>")
    return pd.DataFrame({"path": [f"{pdf['volume'].iloc[0]}.zip"], "content": [out.getvalue()]})


def zipped_cases(spark: SparkSession, d: str) -> DataFrame:
    """Cases as archives of JSON documents, one archive bad, and the cases read from them."""
    c = _cases(spark, d, "name", "docket_number", "court_name").withColumn("volume", F.pmod(F.xxhash64("id"), F.lit(64)))
    body = F.to_json(F.struct("id", "name", "docket_number", F.struct(F.lit(1).alias("id"), F.col("court_name").alias("name")).alias("court")))
    files = c.select("volume", "id", body.alias("body")).groupBy("volume").applyInPandas(_zipped, "path string, content binary")
    bad = spark.range(1).select(F.lit("bad.zip").alias("path"), F.encode(F.lit("no archive"), "utf-8").alias("content"))
    entries = archives.archive_entries(files.unionByName(bad))
    fields = archives.case_fields(entries.where("fault is null").select(F.lit("s").alias("source"), F.lit(1).alias("volume"), "entry", "body"))
    faults = entries.where("fault is not null").select(F.lit(-1).cast("long").alias("id"), F.lit("fault").alias("name"), F.lit(None).cast("string").alias("docket_number"), F.lit(None).cast("string").alias("court_name"))
    return fields.select("id", "name", "docket_number", "court_name").unionByName(faults)


def json_files(spark: SparkSession, d: str) -> DataFrame:
    """Keywords as files: an array, and a record a line with one malformed; all records and faults."""
    k = table(spark, d, "keywords").select("id", "keyword_text", "tier").distinct()
    one = F.to_json(F.struct("id", "keyword_text", "tier"))
    array = k.where("id % 2 = 0").agg(F.lit("a.json").alias("path"), F.concat(F.lit("["), F.array_join(F.collect_list(one), ","), F.lit("]")).alias("t"))
    lines = k.where("id % 2 = 1").agg(F.lit("b.ndjson").alias("path"), F.concat(F.array_join(F.collect_list(one), "\n"), F.lit("\n{broken")).alias("t"))
    records = archives.file_records(array.unionByName(lines).select("path", F.encode("t", "utf-8").alias("content")))
    return records.select("path", F.get_json_object("record", "$.id").cast("int").alias("id"), F.get_json_object("record", "$.tier").alias("tier"), F.col("fault").isNotNull().alias("faulty"))


def level_files(spark: SparkSession, d: str) -> DataFrame:
    """Sections of the code as XML of levels and records by title, with an id that comes in two files, and the levels read again."""
    escape = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    u = table(spark, d, "usc_chunks").where("element_id is not null").groupBy("element_id").agg(F.min("heading").alias("heading")).withColumn("title", F.regexp_extract("element_id", "^/us/usc/(t[0-9]+)", 1))
    level = F.concat(F.lit('<LEVEL id="'), escape(F.col("element_id")), F.lit('"><RECORD><HEADING>'), escape(F.coalesce("heading", F.lit(""))), F.lit("</HEADING><PARA>one  two</PARA></RECORD></LEVEL>"))
    files = u.groupBy("title").agg(F.array_join(F.sort_array(F.collect_list(level)), "").alias("inside"))
    xml = F.concat(F.lit('<ROOT><LEVEL id="top"><RECORD><HEADING>Top</HEADING></RECORD>'), F.col("inside"), F.lit("</LEVEL></ROOT>"))
    return markup.level_units(files.select(F.concat("title", F.lit(".xml")).alias("path"), F.encode(xml, "utf-8").alias("content"))).select("id", "parent", "depth", "heading", "text")


def valid_cases(spark: SparkSession, d: str) -> DataFrame:
    good, lacks = sinks.valid_records(_cases(spark, d, "name", "docket_number", "decision_date"), ["name", "docket_number", "decision_date"])
    return good.agg(F.count(F.lit(1)).alias("n_valid")).join(lacks)  # one row each


QUERIES = {
    "caption_scalars": caption_scalars, "opinion_bylines": bylines, "opinion_sections": opinion_sections, "front_and_body": fronts, "pin_marks": pins, "unit_curies": unit_curies, "answer_keyword_rows": answer_rows,
    "outline_round_trip": outline, "volume_rule_report": rule_report, "zip_case_entries": zipped_cases, "json_file_records": json_files, "level_xml_units": level_files, "valid_case_records": valid_cases,
}


def _docket(text: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(regexp_extract({text}, '{p}', 1), '')" for p in D.DOCKETS) + ")"


_BY = r"^\s*([A-Z][A-Za-z''’\- ]*?),?\s+(?:Ch\.?\s*J|P\.?\s*J|J\.?\s*P|JJ?)\."
SQL = {
    "caption_scalars": f"""WITH c AS (SELECT *, trim(regexp_replace(regexp_replace(name, '\\([^)]*\\)', ' ', 'g'), '\\s+', ' ', 'g')) AS bare FROM {_c('name', 'name_abbreviation', 'docket_number')})
SELECT id, CASE WHEN regexp_matches(bare, '(?i)^(in the )?matter of ') THEN regexp_replace(bare, '(?i)^(in the )?matter of ', '') || ', Matter of' ELSE bare END AS matter, {_docket("('Index No. ' || docket_number)")} AS docket,
  coalesce(CASE WHEN trim(name_abbreviation) <> '' THEN name_abbreviation END, CASE WHEN trim(name) <> '' THEN name END, CASE WHEN trim(docket_number) <> '' THEN docket_number END) AS shown FROM c""",
    "opinion_bylines": f"""WITH o AS (SELECT id, text, string_split(text, chr(10))[1] AS f, lower(string_split(text, chr(10))[1]) AS g, try_cast(regexp_extract(text, '(?i)\\bvol(?:ume|\\.)?\\s*([0-9]+)', 1) AS INT) AS v FROM {_O}),
e AS (SELECT *, list_min(list_filter([{', '.join(f"CASE WHEN regexp_matches(text, '{p}') THEN strpos(text, regexp_extract(text, '({p})', 1)) END" for p in ENDS)}], lambda x: x IS NOT NULL)) AS m FROM o)
SELECT id, CASE WHEN regexp_matches(g, '\\bconcur') AND regexp_matches(g, '\\bdissent') THEN 'concurrence-dissent' WHEN regexp_matches(g, '\\bconcur') THEN 'concurrence' WHEN regexp_matches(g, '\\bdissent') THEN 'dissent'
  WHEN regexp_matches(g, '\\bmemorandum\\b') THEN 'memorandum' WHEN regexp_matches(g, '\\bper curiam\\b') THEN 'per-curiam' ELSE 'majority' END AS kind,
  CASE WHEN regexp_matches(f, '(?i)^\\s*per curiam') THEN 'Per Curiam' WHEN regexp_extract(f, '{_BY}', 1) <> '' THEN upper(regexp_extract(f, '{_BY}', 1)[1]) || lower(regexp_extract(f, '{_BY}', 1)[2:]) END AS author,
  v AS volume, CASE WHEN v IS NULL THEN NULL WHEN regexp_matches(text, '(?i)\\b(third|3d) series') THEN 3 WHEN regexp_matches(text, '(?i)\\b(second|2d) series') THEN 2 ELSE 1 END AS series, coalesce(m, 0) AS "end" FROM e""",
    "opinion_sections": f"""WITH l AS (SELECT id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM {_O}),
w AS (SELECT *, CAST(sum(CASE WHEN regexp_matches(t, '^\\s*(Judgment|Appeal|The motion|There is)\\b') THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY n) AS BIGINT) AS o FROM l),
g AS (SELECT id, o, string_agg(t, chr(10) ORDER BY n) AS text, lower(first(t ORDER BY n)) AS g FROM w WHERE o > 0 GROUP BY id, o)
SELECT id AS case_id, o - 1 AS opinion_index, CASE WHEN regexp_matches(g, '\\bconcur') AND regexp_matches(g, '\\bdissent') THEN 'concurrence-dissent' WHEN regexp_matches(g, '\\bconcur') THEN 'concurrence' WHEN regexp_matches(g, '\\bdissent') THEN 'dissent'
  WHEN regexp_matches(g, '\\bmemorandum\\b') THEN 'memorandum' WHEN regexp_matches(g, '\\bper curiam\\b') THEN 'per-curiam' ELSE 'majority' END AS kind, md5(text) AS digest FROM g""",
    "front_and_body": """SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[\\r\\n\\f]+'), lambda s: trim(s)), lambda s: s <> '' AND length(s) <= 250)[1] AS title,
  length(CASE WHEN strpos(text, chr(12)) > 0 THEN substr(text, strpos(text, chr(12)) + 1) ELSE text END) AS n_body FROM documents WHERE text IS NOT NULL""",
    "pin_marks": """SELECT DISTINCT id, array_to_string(list_filter(regexp_split_to_array(regexp_replace(pin_cites, '[\\[\\]().\\s]', '', 'g'), '[,;]'), lambda p: p <> ''), '|') AS pins FROM case_citations WHERE pin_cites IS NOT NULL""",
    "unit_curies": """WITH r AS (SELECT reporter_id, regexp_replace(lower(canonical), '[^a-z0-9]+', '-', 'g') || ':' || reporter_id AS curie, list_transform(coalesce(aliases, []), lambda a: regexp_replace(lower(a), '[^a-z0-9]+', '-', 'g') || ':' || reporter_id) AS o FROM reporters)
SELECT reporter_id, curie, array_to_string(list_sort(list_distinct(list_filter(o, lambda a: a <> curie))), ' ') AS others FROM r""",
    "answer_keyword_rows": """SELECT opinion_curie AS id, category, lower(trim(keyword_text)) AS text, max(relevance_score) AS relevance FROM opinion_keywords o JOIN (SELECT DISTINCT id, keyword_text FROM keywords) k ON k.id = o.keyword_id
WHERE opinion_curie IS NOT NULL AND category IN ('doctrine', 'field_of_law') AND relevance_score >= 0.5 AND trim(keyword_text) <> '' GROUP BY ALL""",
    "outline_round_trip": "SELECT DISTINCT trim(tier) AS category, trim(keyword_text[1]) AS subcategory, trim(keyword_text) AS item FROM keywords WHERE tier IS NOT NULL AND keyword_text IS NOT NULL",
    "volume_rule_report": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{n}' AS rule, count(*) FILTER (WHERE {e}) AS n FROM {_c('name', 'first_page', 'last_page', 'curie', 'docket_number', 'decision_date', 'court_id')}" for kind, rules in (("hard", HARD), ("soft", SOFT)) for n, e in rules.items()
    ),
    "zip_case_entries": f"SELECT id, name, docket_number, court_name FROM {_c('name', 'docket_number', 'court_name')} UNION ALL SELECT -1, 'fault', NULL, NULL",
    "json_file_records": "SELECT CASE id % 2 WHEN 0 THEN 'a.json' ELSE 'b.ndjson' END AS path, id, tier, false AS faulty FROM (SELECT DISTINCT id, keyword_text, tier FROM keywords) UNION ALL SELECT 'b.ndjson', NULL, NULL, true",
    "level_xml_units": """SELECT element_id AS id, 'top' AS parent, 1 AS depth, trim(coalesce(min(heading), '')) AS heading, 'one two' AS text FROM usc_chunks WHERE element_id IS NOT NULL GROUP BY 1 UNION ALL SELECT 'top', NULL, 0, 'Top', ''""",
    "valid_case_records": f"""SELECT count(*) FILTER (WHERE coalesce(trim(name), '') <> '' AND coalesce(trim(docket_number), '') <> '' AND coalesce(trim(decision_date), '') <> '') AS n_valid, count(*) FILTER (WHERE coalesce(trim(name), '') = '') AS lacks_name,
  count(*) FILTER (WHERE coalesce(trim(docket_number), '') = '') AS lacks_docket_number, count(*) FILTER (WHERE coalesce(trim(decision_date), '') = '') AS lacks_decision_date FROM {_c('name', 'docket_number', 'decision_date')}""",
}
