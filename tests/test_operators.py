from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import ids, matching, merge, search, temporal, voting


def test_dense_ids_equal_row_numbers(spark):
    rows = spark.range(500).select((F.col("id") * 37 % 500).alias("k")).repartition(7)
    got = {r.k: r.new_id for r in ids.dense_ids(rows, ["k"]).collect()}
    assert got == {k: k + 1 for k in range(500)}


@pytest.mark.parametrize(
    ("name", "slug"),
    [("Myers v. Schneiderman", "myers-v-schneiderman"), ("  A & B, Inc. ", "a-b-inc"), ("Müller", "m-ller"), ("", ""), (None, "")],
)
def test_slug(spark, name, slug):
    assert spark.createDataFrame([(name,)], "n string").select(T.slug(F.col("n"))).first()[0] == slug


def one(spark, expr, *values):
    cols = [f"c{i}" for i in range(len(values))]
    kinds = {str: "string", int: "int", bool: "boolean"}
    df = spark.createDataFrame([values], ", ".join(f"{c} {kinds[type(v)]}" for c, v in zip(cols, values)))
    return df.select(expr(*(F.col(c) for c in cols)).alias("x")).first().x


def test_identifiers(spark):
    assert one(spark, T.case_curie, "NY 3d", 30, 1, "Myers v Schneiderman") == "ny3d:30:1:myers-v-schneiderman"
    assert one(spark, T.case_curie, "X3d", 30, 1, "") == "x3d:30:1"
    assert one(spark, T.occurrence_suffix, "b", 1) == "b" and one(spark, T.occurrence_suffix, "b", 2) == "b:02" and one(spark, T.occurrence_suffix, "b", 12) == "b:12"
    assert one(spark, T.opinion_curie, "c", 0, "majority", "Lynch, J.") == "c#0-majority-lynch"
    assert one(spark, T.opinion_curie, "c", -1, "majority", "Lynch, J.") is None
    assert one(spark, lambda y, n, u: T.slip_curie("s", y, n, u), 2003, "017894", True) == "su:2003:17894"
    assert one(spark, lambda y, n, u: T.slip_cite("Op", y, n, u), 2003, "894", False) == "2003 Op 00894"


@pytest.mark.parametrize(
    ("address", "curie"),
    [
        ("T15C041_41-01", "rcny:15-41-01"), ("T06AppB_3", "rcny:6-AppB-3"), ("T7C019.1AppC", "rcny:7-AppC"), ("T24HC_1.01", "rcny:24-1.01"), ("T38-aC001_1-01", "rcny:38a-1-01"),
        ("T50C002-01", "rcny:50-002-01"), ("T6C019A", "rcny:c:6-019A"), ("T9AppQ", "rcny:c:9-AppQ"), ("T012", "rcny:t:12"), ("X", None),
    ],
)
def test_addresses(spark, address, curie):
    assert one(spark, T.address_curie, address) == curie


def test_dates_and_cites(spark):
    assert [one(spark, T.iso_date, x) for x in ("March 3, 1935", "12 May 2001", "1875-01", "1999-02-03", "soon")] == ["1935-03-03", "2001-05-12", "1875-01", "1999-02-03", None]
    p = one(spark, lambda c: T.volume_reporter_page(c, True), "12 Misc. 2d 345 (a)")
    assert (p.volume, p.reporter, p.page) == (12, "Misc. 2d", 345)
    assert one(spark, T.volume_reporter_page, "282A.D.651").reporter == "A.D."
    assert one(spark, T.natural_key, "9.1.2") == "000009.000001.000002"


def test_chunks(spark):
    assert one(spark, lambda t: T.word_chunks(t, 4, 2), "a b c d e f g") == ["a b c d", "c d e f", "e f g"]
    assert one(spark, lambda t: T.char_chunks(t, 4, 2), "abcdef") == ["abcd", "cdef"]
    assert one(spark, lambda t: T.char_chunks(t, 4, 2), "") is None
    assert one(spark, T.slice_or_null, "abcdef", 1, 3) == "bc" and one(spark, T.slice_or_null, "abc", 2, 9) is None


def test_trigram_similarity(spark):
    assert round(one(spark, lambda a, b: T.set_similarity(T.trigrams(a), T.trigrams(b)), "word", "two words"), 6) == 0.363636
    assert one(spark, lambda a, b: T.set_similarity(T.trigrams(a), T.trigrams(b)), "..", "--") == 0.0


def test_canonical_keywords(spark):
    rows = [("a", 1, "Tort Law", "x", 5), ("b", 1, "tort law", "y", 5), ("c", 9, "TORT LAW", "y", 1), ("a", 2, "other", None, None)]
    s = spark.createDataFrame(rows, "source_ref string, id int, keyword_text string, tier string, frequency int")
    got = {r.key: (r.winning_tier, r.canonical_text, r.total_frequency) for r in merge.canonical_keywords(s).collect()}
    assert got == {"tort law": ("y", "Tort Law", 11), "other": (None, "other", None)}
    assert [(r.losing_tier, r.losing_count, r.sources_losing) for r in merge.tier_conflicts(s).collect()] == [("x", 5, "a")]


def test_upserts(spark):
    kind = "k int, a string, s double, n int, j string"
    old = spark.createDataFrame([(1, "x", 0.9, 1, '{"p":"1","q":"2"}'), (2, "y", 0.1, 1, None)], kind)
    new = spark.createDataFrame([(1, None, 0.5, 1, '{"p":"3"}'), (3, "z", None, 1, None)], kind)
    got = {r.k: r for r in merge.upsert(old, new, ["k"], greatest=["s"], add=["n"], json=["j"]).collect()}
    assert (got[1].a, got[1].s, got[1].n, got[1].j) == ("x", 0.9, 2, '{"p":"3","q":"2"}')
    assert (got[2].n, got[3].a) == (1, "z")
    with pytest.raises(Exception, match="several updates"):
        merge.guarded_update(old, spark.createDataFrame([(1, "b"), (1, "c")], "k int, a string"), "k", "a").collect()
    fresh = merge.insert_new(spark.createDataFrame([(1, None)], "a int, b string"), spark.createDataFrame([(1, None), (2, None), (2, None)], "a int, b string"), ["a", "b"])
    assert [tuple(r) for r in fresh.collect()] == [(2, None)]


def test_temporal(spark):
    t = [datetime(2021, 1, d) for d in range(1, 10)]
    left = spark.createDataFrame([(1, t[2]), (1, t[4]), (2, t[0])], "k int, ts timestamp_ntz")
    right = spark.createDataFrame([(1, t[2], "a"), (1, t[3], "b"), (1, t[3], None)], "k int, ts timestamp_ntz, v string")
    assert sorted((r.k, r.last_v) for r in temporal.asof_backward(left, right, ["k"], "ts", "v").collect() if r.last_v) == [(1, "a"), (1, "b")]
    assert sorted(r.last_v for r in temporal.asof_backward(left, right, ["k"], "ts", "v", strict=True).collect() if r.last_v) == ["b"]
    rows = spark.createDataFrame([(1, i, s) for i, s in enumerate("aabba")] + [(2, 0, None), (2, 1, None)], "k int, i int, s string")
    assert sorted((r.k, r["first"], r["last"]) for r in temporal.runs(rows, ["k"], ["i"], "s").collect()) == [(1, 0, 1), (1, 2, 3), (1, 4, 4), (2, 0, 1)]
    assert spark.createDataFrame([([90, 0, 30, 50, 95],)], "o array<bigint>").select(temporal.spaced(F.col("o"), 40).alias("x")).first().x == [0, 50, 90]


def test_votes(spark):
    v = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("b", 3), ("b", 1), ("c", None), (None, 1)], "n string, o int")
    got = {tuple(r)[0]: tuple(r)[1] for r in voting.roster(v.withColumnRenamed("n", "who"), "who", "o").collect()}
    assert got == {"a": 1, "b": 3}
    cases = spark.createDataFrame([(1, 1, 2, 9), (2, 1, 1, 9), (3, None, 4, 9), (4, None, None, 9), (5, None, None, None)], "id int, a int, b int, p int")
    assert [(r.resolved, r.grade) for r in voting.resolution(cases, "a", "b", "p").orderBy("id").collect()] == [(9, "CONFLICT"), (1, "HIGH"), (4, "MED"), (9, "LOW"), (None, "NONE")]


def test_decisions(spark):
    found = "entry int, case_id int, n_cites int, name_score double, abbr_score double, best_score double, place int"
    rows = [
        (1, 5, 1, 0.9, 0.2, 0.9, 1), (1, 6, 1, 0.5, 0.2, 0.5, 2),  # a clear lead
        (2, 5, 1, 0.2, 0.1, 0.2, 1),  # too unlike
        (3, 5, 1, 0.6, 0.9, 0.9, 1), (3, 6, 3, 0.3, 0.9, 0.9, 2),  # tied, one richer
        (4, 5, 1, 0.6, 0.9, 0.9, 1), (4, 6, 1, 0.5, 0.9, 0.9, 2),  # tied, one's name is nearer
        (5, 9, 1, 0.5, 0.9, 0.9, 1), (5, 3, 1, 0.5, 0.9, 0.9, 2),  # alike in all
        (6, 5, 1, 0.6, 0.1, 0.6, 1), (6, 6, 1, 0.55, 0.2, 0.55, 2),  # neither tied nor clear
    ]
    entries = spark.createDataFrame([(i,) for i in range(1, 8)], "entry int")
    got = {r.entry: (r.case_id, r.reason) for r in matching.decide(entries, spark.createDataFrame(rows, found)).collect()}
    assert got == {
        1: (5, "decisive_margin"), 2: (None, "below_floor"), 3: (6, "richness"), 4: (5, "name_score"), 5: (3, "lowest_id"), 6: (None, "low_confidence"), 7: (None, "no_candidates"),
    }


def test_search_refuses_unknown_strategies(spark, sf):
    from lexmill.plans.search_queries import corpus

    with pytest.raises(ValueError):
        search.hybrid_search(corpus(spark, sf), ["a"], "none")


def test_spans(spark):
    from lexmill.operators import spans

    s = spark.createDataFrame([(1, 5, 10, 30), (1, 8, 12, 30), (1, 12, 13, 30), (1, 20, 25, 30), (2, 0, 30, 30)], "k int, start int, end int, n int")
    assert sorted((r.k, r.start, r.end) for r in spans.merged(s, ["k"]).collect()) == [(1, 5, 13), (1, 20, 25), (2, 0, 30)]
    assert sorted((r.k, r.start, r.end) for r in spans.complement(s, ["k"], "n").collect()) == [(1, 0, 5), (1, 13, 20), (1, 25, 30)]
    t = spark.createDataFrame([("abcdef", [2, 4, 9, 0])], "t string, o array<bigint>")
    assert t.select(spans.segments(F.col("t"), F.col("o")).alias("x")).first().x == ["ab", "cd", "ef"]
    m = spark.createDataFrame([([100, 3, 4, 40, 6, 1, 2],)], "m array<int>")
    assert m.select(spans.plausible_sequence(F.col("m")).alias("x")).first().x == [3, 4, 6, 1, 2]


def test_json_merge_keeps_kinds(spark):
    old = spark.createDataFrame([(1, '{"p": 2, "n": {"a": [1, 2]}, "s": "x\\"y"}'), (2, None), (3, "no json"), (4, '{"a": 1}')], "k int, j string")
    new = spark.createDataFrame([(1, '{"q": true, "p": null}'), (2, '{"f": 1.5}'), (3, '{"z": "1"}'), (5, "{}")], "k int, j string")
    got = {r.k: r.j for r in merge.upsert(old, new, ["k"], json=["j"]).collect()}
    assert got == {1: '{"n":{"a":[1,2]},"p":null,"q":true,"s":"x\\"y"}', 2: '{"f":1.5}', 3: '{"z":"1"}', 4: '{"a":1}', 5: "{}"}


def test_fold_of_many_rows(spark):
    rows = spark.createDataFrame([("a", 1, '{"x": 1, "y": "o"}', 0.2), ("a", 2, '{"y": [1]}', 0.9), ("a", 3, '{"x": null}', None), ("b", 4, None, 0.1), (None, 5, "{}", 0.3)], "k string, id int, j string, s double")
    got = {r.k: (r.s, r.frequency, r.j) for r in merge.folded(rows, ["k"], "id", "j", greatest=["s"]).collect()}
    assert got == {"a": (0.9, 3, '{"x":null,"y":[1]}'), "b": (0.1, 1, "{}"), None: (0.3, 1, "{}")}


def test_courts(spark):
    from lexmill.functions import text as T

    rows = [("Court of Appeals", "NY3d", "ny_supreme", None, "appeals"), ("Appellate Division, Second  Department", "AD3d", "ny_appellate", 2, "appellate-division"), ("Appellate Division", "AD3d", "ny_appellate", None, "appellate-division"),
            ("Appellate Term, First Department", "Misc 3d", "ny_trial", None, "appellate-term"), ("Surrogate's Court, Kings County", "Misc 3d", "ny_trial", None, "surrogate"), ("", None, None, None, "other"), (None, None, None, None, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "n string").select("n", T.court_of(F.col("n")).alias("c"), T.court_class(F.col("n")).alias("k"))
    assert [(r.n, r.c.reporter, r.c.source_ref, r.c.department, r.k) for r in df.collect()] == rows


def test_first_of_each_by_time(spark):
    from lexmill.streaming.incremental import once_each

    rows = spark.createDataFrame([("a", "2026-01-02", 1), ("a", "2026-01-01", 2), ("b", None, 3), ("b", None, 4), ("c", None, 5), ("c", "2026-01-05", 6), (None, "2026-01-01", 7)], "k string, ts string, v int")
    assert {(r.k, r.v) for r in once_each(rows, ["k"], "ts").collect()} == {("a", 2), ("b", 3), ("c", 6), (None, 7)}


def test_one_row_each_is_a_row_there_was(spark):
    from lexmill.operators.search import one_row_each

    rows = spark.createDataFrame([(1, "a", "z"), (1, "b", "y"), (2, None, "q"), (2, "c", None), (None, "x", "x")], "id int, p string, q string")
    assert {tuple(r) for r in one_row_each(rows, "id", "p", "q").collect()} == {(1, "a", "z"), (2, "c", None)}


def test_law_citations_at_their_places(spark):
    from lexmill.operators import citations as C

    text = "A" * 300 + " see 15 RCNY § 41-05 and § 41-06, again 15 RCNY § 41-05; 42 U.S.C. § 1983. DRL § 236 and CA Code § 12.5 apply, NYC Admin. Code § 24-603 too."
    df = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "nothing § 5", "x")], "id int, text string, curie string")
    rows = C.law_citations(df).collect()
    assert sorted(r.curie for r in rows) == sorted(["rcny:15-41-05", "rcny:15-41-06", "rcny:15-41-05", "usc:42-1983", "drl:236", "ca:12.5", "nyc-admin-code:24-603"])
    twice = [r.context for r in rows if r.curie == "rcny:15-41-05"]
    assert len(set(twice)) == 2 and all(c.startswith("…") for c in twice)
    ok = spark.createDataFrame([("a:b",), ("a:b:c",), (":x",), ("1a:b",), (None,)], "c string").select(C.valid_curie(F.col("c")).alias("v")).collect()
    assert [r.v for r in ok] == [True, False, False, False, False]


def test_audit_by_parent_equals_one_by_one(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (9, "z"), (None, "a")], "k int, c string")
    parent = spark.createDataFrame([(1, "a"), (2, None)], "id int, curie string")
    checks = [("k", child, "k", parent, "id"), ("c", child, "c", parent, "curie"), ("self", parent, "id", parent, "id")]
    assert {tuple(r) for r in merge.audit_by_parent(checks).collect()} == {tuple(r) for r in merge.orphan_audit(checks).collect()} == {("k", 1), ("c", 2), ("self", 0)}


def test_polls_and_batches(spark):
    from lexmill.operators import resolution as R

    delays = R.poll_delays(24 * 60)
    assert delays[0] == 5 and max(delays) == 60 and delays == sorted(delays) and 0 <= sum(delays) - 24 * 3600 < 60
    got = spark.createDataFrame([(0,), (500,), (501,), (5_000,), (5_001,), (10_001,), (None,)], "n long").select(R.batch_size(F.col("n")).alias("b")).collect()
    assert [r.b for r in got] == [0, 500, 101, 500, 500, 200, None]


def test_checkpoints_need_a_shared_folder(spark):
    from types import SimpleNamespace

    import pytest

    from lexmill.plans.lineage import checkpoint_dir

    none = SimpleNamespace(isDefined=lambda: False)
    cluster = SimpleNamespace(isLocal=lambda: False, getCheckpointDir=lambda: none)
    bare = SimpleNamespace(sparkContext=SimpleNamespace(_jsc=SimpleNamespace(sc=lambda: cluster), getConf=lambda: {}), conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError, match="checkpoint"):
        checkpoint_dir(bare)


def test_tree_depths(spark):
    rows = [(i, i - 1) for i in range(1, 40)] + [(100, None), (101, 100), (102, 999), (200, 201), (201, 200), (202, 201)]
    got = {r.id: r.depth for r in ids.tree_depths(spark.createDataFrame(rows, "id long, parent long"), 8).collect()}
    assert got == {i: i - 1 for i in range(1, 40)} | {100: 0, 101: 1, 102: 0, 200: None, 201: None, 202: None}
    assert ids.tree_depths(spark.createDataFrame([], "id long, parent long")).count() == 0
