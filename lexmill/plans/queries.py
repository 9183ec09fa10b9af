"""The queries of the core, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import orphans
from ..sources.tables import table
from . import analysis_queries, document_queries, file_queries, merge_queries, more_queries, resolution_queries, search_queries, text_queries


def _broken(spark: SparkSession, d: str) -> DataFrame:
    return orphans.all_broken_references(*(table(spark, d, t) for t in ("cases", "opinions", "case_citations", "citation_corrections", "deleted_records")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _broken(spark, d).select("table_name", "row_id", "ref_id", "reason").distinct()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(_broken(spark, d))


_P4 = """
WITH refs AS (
  SELECT 'opinions' AS table_name, CAST(id AS BIGINT) AS row_id, case_id AS ref_id, created_at, 'cases' AS parent FROM opinions
  UNION ALL SELECT 'case_citations', id, unnest(cited_case_ids), created_at, 'cases' FROM case_citations
  UNION ALL SELECT 'citation_corrections', id, citation_id, created_at, 'case_citations' FROM citation_corrections),
parents AS (
  SELECT 'cases' AS parent, id, min(created_at) AS born FROM cases WHERE id IS NOT NULL GROUP BY id
  UNION ALL SELECT 'case_citations', id, min(created_at) FROM case_citations WHERE id IS NOT NULL GROUP BY id),
broken AS (
  SELECT DISTINCT r.table_name, r.row_id, r.ref_id, r.created_at,
    CASE WHEN p.id IS NOT NULL THEN 'late'
         WHEN EXISTS (SELECT 1 FROM deleted_records d WHERE d.table_name = r.parent AND d.record_id = r.ref_id) THEN 'deleted' ELSE 'absent' END AS reason
  FROM refs r LEFT JOIN parents p ON p.parent = r.parent AND p.id = r.ref_id
  WHERE r.ref_id IS NOT NULL AND (p.id IS NULL OR p.born > r.created_at))
"""


FAMILIES = (search_queries, merge_queries, text_queries, analysis_queries, more_queries, resolution_queries, document_queries, file_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {"p4_found": p4_found, "p4_report": p4_report}
    for family in FAMILIES:
        out |= family.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out = {
        "p4_found": _P4 + "SELECT DISTINCT table_name, row_id, ref_id, reason FROM broken",
        "p4_report": _P4
        + "SELECT table_name, strftime(created_at, '%Y-%m') AS month, reason, count(*) AS n_refs, count(DISTINCT row_id) AS n_rows FROM broken GROUP BY 1, 2, 3",
    }
    for family in FAMILIES:
        out |= family.SQL
    return out
