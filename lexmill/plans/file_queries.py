"""Queries that write files into the shared folder and read them again, with SQL over the tables they came from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as D
from ..sources import archives, markup, sinks
from ..sources.tables import table
from ..streaming import incremental
from .lineage import checkpoint_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def lines_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the code as records a line, read again by type; one line is malformed, one of an unknown type."""
    path = _folder(spark, "lines")
    u = table(spark, d, "usc_chunks").where("content_type is not null").select("id", F.col("content_type").alias("type"), "heading").distinct()
    bad = spark.createDataFrame([("{broken",), ('{"type": "other"}',)], "value string")
    u.select(F.to_json(F.struct("*")).alias("value")).unionByName(bad).write.text(path)
    found, skipped = archives.by_type(spark, path, {"heading": "id int, heading string", "body": "id int, heading string"})
    rows = [r.groupBy(F.lit(t).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.count("heading").alias("n_headings"), F.sum("id").alias("ids")) for t, r in found.items()]
    out = skipped.select(F.col("reason").alias("kind"), "n", F.lit(0).cast("long").alias("n_headings"), F.lit(0).cast("long").alias("ids"))
    for r in rows:
        out = out.unionByName(r)
    return out


def csv_updates(spark: SparkSession, d: str) -> DataFrame:
    """Resolved and open corrections as files of updates with a header, read again."""
    path = _folder(spark, "updates")
    c = table(spark, d, "citation_corrections").select("id", "file_volume", "confidence", F.col("expected_reporter").isNotNull().alias("resolved")).distinct()
    schema, out = "id long, file_volume int, confidence string", None
    for kind, rows in (("resolved", c.where("resolved")), ("open", c.where("not resolved"))):
        sinks.write_csv(rows.drop("resolved"), f"{path}/{kind}")
        back = archives.updates_csv(spark, f"{path}/{kind}", schema).withColumn("kind", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out


def partitioned_reload(spark: SparkSession, d: str) -> DataFrame:
    """Opinions by source, the staged ones written over their own sources only, and all read again."""
    path = _folder(spark, "reload")
    a = table(spark, d, "opinions").where("source_ref is not null and curie is not null").select("source_ref", "curie").distinct()
    b = table(spark, d, "stage_opinions").where("source_ref = 'ny_trial' or source_ref like '%trial%'").select("source_ref", "curie").distinct()
    sinks.write_partitioned(a, path, ["source_ref"])
    sinks.write_partitioned(b, path, ["source_ref"])
    return spark.read.parquet(path).groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"))


def incremental_runs(spark: SparkSession, d: str) -> DataFrame:
    """Citations that come in two deliveries; each run takes what is new, once."""
    base = _folder(spark, "runs")
    c = table(spark, d, "case_citations").select("id", "reporter").where("id is not null")
    for part in range(2):
        c.where(F.pmod(F.xxhash64("id"), F.lit(2)) == part).write.mode("append").parquet(f"{base}/in")
        incremental.run_new(spark, f"{base}/in", "id long, reporter string", lambda rows: rows.withColumn("reporter", F.upper("reporter")), f"{base}/out", f"{base}/state")
    return spark.read.schema("id long, reporter string").parquet(f"{base}/out").groupBy("reporter").agg(F.count(F.lit(1)).alias("n"))


def law_files(spark: SparkSession, d: str) -> DataFrame:
    """Sections of the code as law XML by title, headings and marked bodies, and their elements read again."""
    escape = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    u = table(spark, d, "usc_chunks").where("element_id is not null and trim(heading) <> ''").groupBy("element_id").agg(F.min("heading").alias("heading")).withColumn("title", F.regexp_extract("element_id", "^/us/usc/(t[0-9]+)", 1))
    section = F.concat(F.lit('<section identifier="'), escape(F.col("element_id")), F.lit('"><heading>'), escape(F.col("heading")), F.lit("</heading><content>(a)(1) Of "), escape(F.col("title")), F.lit("<footnote>no</footnote>.</content></section>"))
    files = u.groupBy("title").agg(F.array_join(F.sort_array(F.collect_list(section)), "").alias("x"))
    xml = F.concat(F.lit("<title>"), F.col("x"), F.col("x"), F.lit("</title>"))  # everything stands there twice
    return markup.law_units(files.select("title", F.encode(xml, "utf-8").alias("content")).withColumnRenamed("title", "path")).select("identifier", "type", "content_type", "content")


def segments(spark: SparkSession, d: str) -> DataFrame:
    """The pages of staged opinions as runs of one kind and author."""
    s = table(spark, d, "stage_opinions").where("page_breaks is not null and old_case_id is not null").select("old_case_id", "opinion_type", "author", F.explode(F.from_json("page_breaks", "array<struct<volume_page:int>>")).alias("b"))
    pages = s.where("b.volume_page is not null").groupBy(F.col("old_case_id").alias("case_id"), F.col("b.volume_page").alias("page")).agg(F.min(F.struct("opinion_type", "author")).alias("m"))
    return D.opinion_segments(pages.select("case_id", "page", F.coalesce("m.opinion_type", F.lit("none")).alias("kind"), "m.author")).select("case_id", "kind", "author", "first_page", "last_page")


QUERIES = {"lines_by_type": lines_by_type, "csv_updates": csv_updates, "partitioned_reload": partitioned_reload, "incremental_runs": incremental_runs, "law_xml_elements": law_files, "opinion_segments": segments}

SQL = {
    "lines_by_type": """SELECT content_type AS kind, count(*) AS n, count(heading) AS n_headings, CAST(sum(id) AS BIGINT) AS ids FROM (SELECT DISTINCT id, content_type, heading FROM usc_chunks WHERE content_type IN ('heading', 'body')) GROUP BY 1
UNION ALL SELECT 'malformed', 1, 0, 0 UNION ALL SELECT 'unknown type', 1, 0, 0""",
    "csv_updates": "SELECT DISTINCT id, file_volume, nullif(confidence, '') AS confidence, CASE WHEN expected_reporter IS NOT NULL THEN 'resolved' ELSE 'open' END AS kind FROM citation_corrections",
    "partitioned_reload": """WITH a AS (SELECT DISTINCT source_ref, curie FROM opinions WHERE source_ref IS NOT NULL AND curie IS NOT NULL), b AS (SELECT DISTINCT source_ref, curie FROM stage_opinions WHERE source_ref LIKE '%trial%')
SELECT source_ref, count(*) AS n FROM (SELECT * FROM b UNION ALL SELECT * FROM a WHERE source_ref NOT IN (SELECT source_ref FROM b)) GROUP BY 1""",
    "incremental_runs": "SELECT upper(reporter) AS reporter, count(*) AS n FROM case_citations WHERE id IS NOT NULL GROUP BY 1",
    "law_xml_elements": """WITH u AS (SELECT element_id, min(heading) AS h FROM usc_chunks WHERE element_id IS NOT NULL AND trim(heading) <> '' GROUP BY 1), d AS (SELECT * FROM u, (SELECT unnest(['', '#dup1']) AS s))
SELECT element_id || s AS identifier, 'section' AS type, 'heading' AS content_type, trim(h) AS content FROM d UNION ALL SELECT element_id || s, 'section', 'body', 'Of ' || regexp_extract(element_id, '^/us/usc/(t[0-9]+)', 1) || '.' FROM d""",
    "opinion_segments": """WITH s AS (SELECT old_case_id AS case_id, opinion_type, author, unnest(from_json(page_breaks, '[{"volume_page":"INTEGER"}]')).volume_page AS page FROM stage_opinions WHERE page_breaks IS NOT NULL AND old_case_id IS NOT NULL),
p AS (SELECT case_id, page, opinion_type, author FROM s WHERE page IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, page ORDER BY opinion_type NULLS FIRST, author NULLS FIRST) = 1),
k AS (SELECT case_id, page, coalesce(opinion_type, 'none') AS kind, nullif(author, '') AS author, coalesce(opinion_type, 'none') || chr(31) || coalesce(author, '') AS st FROM p),
n AS (SELECT *, CASE WHEN st IS DISTINCT FROM lag(st) OVER (PARTITION BY case_id ORDER BY page) THEN 1 ELSE 0 END AS fresh FROM k), r AS (SELECT *, sum(fresh) OVER (PARTITION BY case_id ORDER BY page) AS run FROM n)
SELECT case_id, kind, author, min(page) AS first_page, max(page) AS last_page FROM r GROUP BY case_id, run, kind, author""",
}
