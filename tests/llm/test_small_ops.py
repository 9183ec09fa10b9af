import random
from datetime import datetime

import pytest

from lexmill.llm import canonical as C
from lexmill.llm import cooccurrence as O
from lexmill.llm import leakage as L
from lexmill.llm import neighbours as V
from lexmill.llm import survivors as S
from lexmill.llm import tokens as K

REPORTERS = [
    (1, "Tam.", ["Tam", "Tamarack Reports"], "Tamarack Reports"), (2, "Tam.2d", ["Tam 2d"], "Tamarack Reports, Second Series"), (3, "Tam. App.", None, "Tamarack Appellate Reports"),
    (4, "Larch. L.J.", [], "Larchmere Law Journal Reports"), (5, None, None, None),
]


@pytest.mark.parametrize(
    ("value", "entry"),
    [
        ("see Tam.", 1), ("TAMARACK REP0RTS", 1), ("Taamrack", 1), ("tam-2D", 2), ("Tamarack Rpts Second Series", 2), ("cited as Tamarcak Reports 2nd", 2), ("Tamara. Appellate Rep.", 3), ("[Tam. App.", 3),
        ("Larch, L,J,", 4), ("Senate Journal", 0), ("Gazette, 1913", 0), ("??", 0), ("Tamarack Appellate Reports 3d", 0), ("x" * 5000, 0),
    ],
)
def test_reporters(spark, value, entry):
    ref = spark.createDataFrame(REPORTERS, "reporter_id int, canonical string, aliases array<string>, notes string")
    rows = spark.createDataFrame([("t", 1, value), ("t", 1, value), ("t", 2, None), ("t", 3, "  "), ("t", 4, "Tam."), ("t", 5, "Tam 2d")], "table_name string, row_id long, value string")
    assert {(r.row_id, r.reporter_id) for r in C.resolved_rows(rows, ref).collect()} == {(1, entry)}


def test_reporters_empty(spark):
    ref = spark.createDataFrame([], "reporter_id int, canonical string, aliases array<string>, notes string")
    rows = spark.createDataFrame([("t", 1, "Tam.")], "table_name string, row_id long, value string")
    assert [(r.row_id, r.reporter_id) for r in C.resolved_rows(rows, ref).collect()] == [(1, 0)]
    assert C.resolved_rows(rows.where("row_id > 1"), ref).count() == 0


def test_pairs_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"b{rng.randrange(40)}", rng.randrange(12)) for _ in range(400)] + [("b1", None), (None, 3), ("lonely", 99)]
    side = lambda i: None if i is None or i == 99 else i % 2
    df = spark.createDataFrame([(b, i, side(i), "x") for b, i in rows], "basket string, item int, side int, left string")
    baskets = {}
    for b, i in rows:
        if b is not None:
            baskets.setdefault(b, set()).add(i)
    n = len(baskets)
    for r in O.pair_scores(df).collect():
        both = sum(r.left in s and r.right in s for s in baskets.values())
        a, c = (sum(x in s for s in baskets.values()) for x in (r.left, r.right))
        assert (r.together, r.n_left, r.n_right, r.n) == (both, a, c, n) and abs(r.lift - both * n / (a * c)) < 1e-9
    assert O.pair_scores(df.limit(0)).count() == 0


ANCHOR = "source_ref string, old_id int, old_doctrine_keyword_id int, old_field_of_law_keyword_id int, description string, confidence_tier string, status string, last_reviewed_at timestamp_ntz, co_occurrence_count int, word string"
T1, T2 = datetime(2021, 1, 1), datetime(2022, 1, 1)


def groups(spark, rows):
    words = spark.createDataFrame([(1, "Some-Rule", "k"), (2, "some rule.", "k"), (3, "tax law", "k"), (4, None, "k")], "id int, keyword_text string, word string")
    return S.anchor_groups(spark.createDataFrame(rows, ANCHOR), words)


def test_survivors(spark):
    rows = [
        ("a", 1, 1, 3, "long description", "uncurated", "pending", T2, 1, ""), ("b", 1, 2, 3, None, " Expert_Reviewed", "DISMISSED", None, 1, ""), ("b", 1, 2, 3, None, " Expert_Reviewed", "DISMISSED", None, 1, ""),
        ("a", 2, 1, None, "n/a", "llm classified", "pending", T1, 1, ""), ("b", 2, 2, None, "x", "llm_classified", "Pending ", T1, 1, ""), ("c", 3, 1, None, "x", "llm_classified", "pending", None, 1, ""),
        ("a", 4, 4, 3, "alone", "uncurated", "pending", T1, 1, ""), ("a", 5, 77, 3, "unknown id", "uncurated", "pending", T1, 1, ""), ("a", 6, None, 3, None, None, None, None, None, None),
    ]
    assert {(r.source_ref, r.old_id) for r in S.survivors(groups(spark, rows)).collect()} == {("b", 1), ("b", 2)}
    assert S.survivors(groups(spark, [])).count() == 0
    assert S.fused(groups(spark, [])).count() == 0


def test_quality_model_trusts_the_better_source(spark):
    rng = random.Random(5)
    said = []
    for g in range(300):
        truth = rng.choice("pqrs")
        for source, right in (("good", 0.95), ("fair", 0.8), ("bad", 0.3)):
            v = truth if rng.random() < right else rng.choice([x for x in "pqrs" if x != truth])
            said.append((f"d{g}", "", "status", v, source, truth))
    df = spark.createDataFrame(said, "doctrine string, field string, attribute string, value string, source_ref string, truth string")
    truth = {r[0]: r[5] for r in said}
    best = {}
    for r in S.true_values(df.drop("truth")).collect():
        best.setdefault(r.doctrine, []).append((r.probability, r.value))
    hits = sum(max(v)[1] == truth[d] for d, v in best.items())
    assert hits >= 0.8 * len(truth)


def test_quality_model_against_brute_force(spark):
    """The same expectation-maximisation, fact by fact, in plain Python; multi-valued claims, many sources."""
    import math

    rng = random.Random(15)
    said = {}
    for g in range(60):
        for attribute in ("status", "tier"):
            truth = rng.choice("pqr")
            for source in rng.sample([f"s{i}" for i in range(12)], 5):
                said.setdefault((f"d{g}", attribute), {}).setdefault(source, set()).add(truth if rng.random() < 0.75 else rng.choice("pqr"))
                if rng.random() < 0.1:
                    said[f"d{g}", attribute][source].add("z")
    facts = {(g, a, v): {s: v in vs for s, vs in who.items()} for (g, a), who in said.items() for v in set().union(*who.values())}
    q = {(a, s): (0.7, 0.7) for (_, a, _), votes in facts.items() for s in votes}
    odds = lambda f, votes: sum(math.log(q[f[1], s][0] / (1 - q[f[1], s][1])) if aye else math.log((1 - q[f[1], s][0]) / q[f[1], s][1]) for s, aye in votes.items())
    for _ in range(30):
        p = {f: 1 / (1 + math.exp(-odds(f, votes))) for f, votes in facts.items()}
        new = {}
        for a, s in q:
            mine = [(p[f], votes[s]) for f, votes in facts.items() if f[1] == a and s in votes]
            t, n = sum(x for x, _ in mine), sum(1 - x for x, _ in mine)
            new[a, s] = min(0.99, (sum(x for x, aye in mine if aye) + 1) / (t + 2)), min(0.99, (sum(1 - x for x, aye in mine if not aye) + 1) / (n + 2))
        moved = max(abs(x - y) for k in q for x, y in zip(q[k], new[k], strict=True))
        q = new
        if moved < 1e-4:
            break
    want = {f: 1 / (1 + math.exp(-odds(f, votes))) for f, votes in facts.items()}
    rows = [(g, "", a, v, s) for (g, a), who in said.items() for s, vs in who.items() for v in vs]
    df = spark.createDataFrame(rows, "doctrine string, field string, attribute string, value string, source_ref string")
    got = {(r.doctrine, r.attribute, r.value): r.probability for r in S.true_values(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_tokens_equal_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{K.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["<|endoftext|> don't WE'LL  \n\n x", "a" * 3000, "日本語 ⚖️ naïve Straße", " \t\n ", "1234567890 ½", "été" * 200] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 900), 10])) for _ in range(300)) for _ in range(30)]
    rows = [(i, x, "clash") for i, x in enumerate(texts)] + [(900, None, ""), (901, "", "")]
    got = {r.doc_id: r.ids for r in K.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string, ids string")).collect()}
    assert got.pop(900) == [] and got.pop(901) == []
    assert got == {i: e.ids for i, e in enumerate(t.encode_batch(texts, add_special_tokens=False))}
    assert K.encode_corpus(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_leaks_against_brute_force(spark):
    rng = random.Random(6)
    words = [f"q{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(12)] + [(50, "too short"), (51, None)]
    docs = []
    for d in range(80):
        w = rng.choices([*words, "other", "das"], k=120)
        if d % 4 == 0:
            i = rng.randrange(12)
            n = rng.choice([9, 10, 14])
            at = rng.randrange(0, 30 - n)
            w[40 : 40 + n] = items[i][1].split()[at : at + n]
        docs.append((d, " ".join(w).replace("q1 ", "Q1,\n"), 1))
    docs += [(100, None, 1), (101, "", 1), (102, items[0][1], 1), (102, items[0][1], 1), (103, "filler " * 50_000 + items[1][1], 1)]
    want = set()
    for d, t, _ in docs:
        w = L.words_of(t)
        runs = {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
        want |= {(d, i) for i, x in items if x for v in [L.words_of(x)] if any(tuple(v[j : j + 10]) in runs for j in range(len(v) - 9))}
    df, it = spark.createDataFrame(docs, "doc_id long, text string, edits int"), spark.createDataFrame(items, "item_id int, text string")
    assert {(r.doc_id, r.item_id) for r in L.leaks(df, it, 0).collect()} == want
    assert {(r.doc_id, r.item_id) for r in L.leaks(df, it, 0, block=5).collect()} == want
    near = {(r.doc_id, r.item_id): r.edits for r in L.leaks(df, it, 1).collect()}
    assert {k for k, v in near.items() if v == 0} == want
    assert L.leaks(df.limit(0), it).count() == 0 and L.leaks(df, it.limit(0)).count() == 0


def test_near_windows_are_found():
    rng = random.Random(8)
    words = [f"q{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(60)]
    index, hits = L.ItemIndex(items), 0
    for i, text in items:
        w = text.split()[10:22]
        w[6] = "changed"
        import numpy as np

        codes = np.array([index.vocab.get(x, -1) for x in w])
        hits += i in index.found(codes, 1)[1]
    assert hits >= 0.8 * len(items)


def near_recall(kind):
    """The least share found over the places of one edit in a ten-word passage, with ``kind`` of edit."""
    import numpy as np

    rng = random.Random(8)
    words = [f"q{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(words, k=10))) for i in range(120)]
    index, least = L.ItemIndex(items), 1.0
    for at in range(1, 9):
        hits = 0
        for i, text in items:
            w = text.split()
            w[at : at + (kind != "inserted")] = [] if kind == "left out" else ["changed"]
            codes = np.array([-2, *(index.vocab.get(x, -1) for x in w), -2])
            hits += i in index.found(codes, 1)[1]
        least = min(least, hits / len(items))
    return least


def test_replaced_words_are_found():
    assert near_recall("replaced") >= 0.95


@pytest.mark.parametrize("kind", ["inserted", "left out"])
def test_inserted_and_omitted_words_are_found(kind):
    assert near_recall(kind) >= 0.95


@pytest.mark.parametrize("kinds", [("replaced", "replaced"), ("inserted", "left out"), ("inserted", "replaced"), ("left out", "left out")])
def test_two_edits_are_found(kinds):
    """Recall at two edits in a ten-word passage, at places drawn for each passage."""
    import numpy as np

    rng = random.Random(18)
    items = [(i, " ".join(rng.choices([f"q{i}" for i in range(2000)], k=10))) for i in range(150)]
    index, hits = L.ItemIndex(items, edits=2), 0
    for i, text in items:
        w = text.split()
        for at, kind in zip(sorted(rng.sample(range(1, 9), 2), reverse=True), kinds, strict=True):
            w[at : at + (kind != "inserted")] = [] if kind == "left out" else ["changed"]
        codes = np.array([-2, *(index.vocab.get(x, -1) for x in w), -2])
        hits += i in index.found(codes, 2)[1]
    assert hits >= 0.93 * len(items)


def test_repetitions_follow_the_target():
    assert L.repeats_for(0.95, 0) == 1 < L.repeats_for(0.8, 1) < L.repeats_for(0.95, 1) < L.repeats_for(0.95, 2)


def test_vectors(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 64)).astype(np.float32)
    x[650:] = x[:50] * 3 + 0.05 * rng.normal(size=(50, 64))
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)] + [(900, None, "c"), (901, [0.0] * 64, "c"), (902, [1.0] * 10, "c"), (903, [None] * 64, "c"), (5, x[5].tolist(), "c"), (910, x[7].tolist(), "c"), (911, x[7].tolist(), "c")]
    df = spark.createDataFrame(rows, "id int, embedding array<float>, class string")
    unit = V.unit(np.vstack([x, x[7], x[7]]))
    ids = [*range(700), 910, 911]
    cos = unit @ unit.T
    np.fill_diagonal(cos, -2)
    got = {}
    for r in V.nearest_vectors(df, k=5, shard=200).collect():
        got.setdefault(r.id, []).append(r.other)
    want = {ids[i]: [ids[j] for j in np.lexsort((ids, -np.round(cos[i], 6)))[:5]] for i in range(len(ids))}
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert sum(len(set(got[i]) & set(want[i])) for i in want) >= 0.9 * 5 * len(want)
    assert got[910][:2] == [7, 911] or set(got[910][:2]) == {7, 911}
    hot = spark.createDataFrame([(i, x[0].tolist() if i % 3 == 0 else x[i].tolist()) for i in range(300)], "id int, embedding array<float>")
    ties = {}
    for r in V.nearest_vectors(hot, k=5, shard=100).collect():
        ties.setdefault(r.id, []).append(r.other)
    assert sorted(ties[0]) == [3, 6, 9, 12, 15] and sorted(ties[99]) == [0, 3, 6, 9, 12] and all(len(v) == 5 for v in ties.values()) and len(ties) == 300
    some = {r.id for r in V.nearest_vectors(df, k=5, shard=200, asked=20).collect()}
    assert some == {i for i in ids if i % 20 == 0}
    assert V.nearest_vectors(df.limit(0)).count() == 0
    assert V.nearest_vectors(df.where("id = 3")).count() == 0


def test_all_shards_are_asked_however_many(spark, monkeypatch):
    """With a tree over the pivots as without one, every shard is asked."""
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=(1300, 64)).astype(np.float32)
    unit = V.unit(x).astype(np.float32)
    rows = np.arange(0, 1300, 20)
    monkeypatch.setattr(V, "TREE", 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, embedding array<float>")
    cos = unit @ unit.T
    np.fill_diagonal(cos, -2)
    got = {}
    for r in V.nearest_vectors(df, k=5, beam=40, degree=20, asked=20, shard=5).collect():  # 260 pivots
        got.setdefault(r.id, set()).add(r.other)
    assert sum(len(got[i] & set(np.argsort(-cos[i])[:5].tolist())) for i in rows.tolist()) >= 0.98 * 5 * len(rows)
    monkeypatch.undo()
    router = V.Router(unit[:600])
    assert router.children is not None
    home = router.homes(unit)
    monkeypatch.setattr(V, "MOST_SENT", 5000)
    parts = list(router.every(rows, home, True))
    assert len(parts) > 5 and {p for q, j in parts for p in zip(q.tolist(), j.tolist())} == {(i, j) for i in rows.tolist() for j in range(600)}
    assert sum(len(q) for q, _ in router.every(rows, home, False)) == 599 * len(rows)
    assert len(router.homes(unit[:0])) == 0
    mine, q, j = router.visits(unit, None, 2.0)
    assert len(q) == 599 * 1300 and (mine[q] != j).all()
