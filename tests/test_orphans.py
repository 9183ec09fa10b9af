from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexmill.operators import orphans as O

REFS = "table_name string, row_id long, ref_id long, created_at timestamp_ntz"
PARENTS = "key long, created_at timestamp_ntz"
T = [datetime(2021, m, 1) for m in range(1, 7)]


def found(spark, refs, parents, removed):
    out = O.broken_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), spark.createDataFrame([(k,) for k in removed], "key long"))
    return {(r.table_name, r.row_id, r.ref_id, r.reason) for r in out.collect()}


def test_reasons(spark):
    refs = [("a", 1, 10, T[2]), ("a", 1, 10, T[2]), ("a", 2, 11, T[2]), ("a", 3, 12, T[2]), ("a", 4, 13, T[2]), ("a", 5, None, T[2]), ("a", 6, 13, None), ("a", 7, -5, None), ("a", 8, 14, T[0])]
    parents = [(10, T[0]), (10, T[5]), (13, T[4]), (13, T[3]), (None, T[0]), (14, None)]
    got = found(spark, refs, parents, [11, 11, 10, None])
    assert got == {("a", 2, 11, "deleted"), ("a", 3, 12, "absent"), ("a", 4, 13, "late"), ("a", 7, -5, "absent")}


def test_empty(spark):
    assert found(spark, [], [(1, T[0])], []) == set()
    assert found(spark, [("a", 1, 1, T[0])], [], []) == {("a", 1, 1, "absent")}


def test_hot_key(spark):
    refs = [("a", i, 7 if i % 3 == 0 else i, T[1]) for i in range(900)]
    got = found(spark, refs, [(i, T[0]) for i in range(900) if i not in (7, 8)], [])
    assert len(got) == 300 + 2 and all(r[2] in (7, 8) for r in got)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(-40, 40), max_size=30), asked=st.lists(st.integers(-50, 50), min_size=1, max_size=20), width=st.sampled_from([1, 3, 7, 1000]))
def test_runs_against_sets(spark, keys, asked, width):
    parents = spark.createDataFrame([(k,) for k in keys], "key long")
    refs = spark.createDataFrame([(k,) for k in asked], "key long")
    assert {r.key for r in O.orphan_keys(refs, parents, "key", width).collect()} == set(asked) - set(keys)
    runs = sorted((r["first"], r["last"]) for r in O.key_runs(parents, "key", width).collect())
    assert [k for a, b in runs for k in range(a, b + 1)] == sorted(set(keys))
