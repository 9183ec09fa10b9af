import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from comparing import rows_of, sql_rows, views  # noqa: E402

from lexmill.llm import queries as llm  # noqa: E402

QUERIES, SQL = llm.queries(), llm.oracle_sql()
COLUMNS = {
    "p1_found": ["id_a", "id_b", "table_name"], "p2_found": ["doctrine_or_concept_keyword_id", "field_of_law_keyword_id"], "p3_found": ["reporter_id", "row_id", "table_name"],
    "p5_found": ["id_a", "id_b", "table_name"], "p6_found": ["old_id", "source_ref"], "p7_found": ["kind", "line_no", "opinion_id"], "p8_ids": ["doc_id", "ids"], "p9_found": ["doc_id", "item_id"],
    "p10_found": ["doc_id", "subject"],
}


@pytest.fixture(scope="module")
def con(sf):
    return views(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    cols, rows = rows_of(QUERIES[name](spark, sf))
    assert cols == COLUMNS.get(name, cols)
    assert len(rows) == len(set(rows))
    if name in SQL:
        assert (cols, rows) == sql_rows(con, SQL[name])


def test_nothing_else_imports_llm():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for at, _, files in os.walk(os.path.join(root, "lexmill")):
        for f in files:
            if f.endswith(".py") and os.sep + "llm" not in at:
                with open(os.path.join(at, f)) as h:
                    assert ".llm" not in h.read(), f
