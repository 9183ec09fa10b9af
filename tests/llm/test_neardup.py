import itertools
import random
import re

import pytest

from lexmill.llm import neardup as N

WORDS = [f"w{i}" for i in range(400)]


def shingles(text, n):
    w = re.findall("[a-z0-9]+", text.lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def pairs(spark, rows, **options):
    members, links = N.similar_texts(spark.createDataFrame(rows, "id long, text string, class string, n int, keys int"), **options)
    return {(r.id_a, r.id_b) for r in N.member_pairs(members, links).collect()}


def test_codes_cover_their_radius():
    for differ in itertools.combinations(range(6), 2):
        assert any(not m[list(differ)].any() for m in N._MASKS)
    weights = N._name_masks() != 0
    rng = random.Random(1)
    for _ in range(300):
        assert (~weights[rng.sample(range(52), N.RADIUS)].any(0)).any()


def test_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(WORDS, k=80)) for _ in range(60)]
    for i in range(40):  # reworked: words replaced, sentences moved
        w = texts[i].split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        cut = rng.randrange(len(w))
        texts.append(" ".join(w[cut:] + w[:cut]))
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)]
    want = set()
    sets = [shingles(t, 3) for t in texts]
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b]):
            want.add((a, b))
    got = pairs(spark, rows, shingle=3, similarity=0.5, least_words=40)
    assert got <= want and len(got) >= 0.95 * len(want) > 20


def test_edge_cases(spark):
    long = " ".join(random.Random(2).choices(WORDS, k=60_000))
    same = " ".join(WORDS[:50])
    rows = [(1, None, None, None, None), (2, "", "", 0, 0), (3, "too short", "", 0, 0), (4, same, "", 0, 0), (4, same, "", 0, 0), (5, same.upper() + " !", "", 0, 0), (6, long, "", 0, 0), (7, long + " w1", "", 0, 0), (None, same, "", 0, 0)]
    assert pairs(spark, rows, shingle=3, similarity=0.5, least_words=40) == {(4, 5), (6, 7)}
    assert pairs(spark, [], shingle=3, similarity=0.5, least_words=40) == set()


def test_hot_copies_are_one_class(spark):
    same, other = " ".join(WORDS[:60]), " ".join(WORDS[100:160])
    rows = [(i, same if i % 3 == 0 else f"{other} x{i} y{i} z{i} " + " ".join(f"u{i}q{j}" for j in range(60)), "", 0, 0) for i in range(300)]
    members, links = N.similar_texts(spark.createDataFrame(rows, "id long, text string, class string, n int, keys int"), shingle=3, similarity=0.5, least_words=40)
    got = {r.id: (r.copies, r.links) for r in N.duplicate_classes(members, links).collect()}
    assert got[0] == (100, 0) and got[1][0] == 1 and len(got) == 300


@pytest.mark.parametrize(("hot", "own", "least"), [(140, 60, 0.95), (100, 100, 0.95)])
def test_hot_family_with_own_rest(spark, hot, own, least):
    """Pairs of a template and own endings; with fewer common shingles the endings are alike in part."""
    head = " ".join(f"t{i}" for i in range(hot + 2))
    rows = []
    for i in range(30):
        tail = " ".join(f"s{i // 2}y{j}" for j in range(50)) if hot == 100 else ""
        rows.append((i, f"{head} {tail} " + " ".join(f"o{i}x{j}" for j in range(own - (50 if tail else 0))), "", 0, 0))
    rest = [(1000 + i, " ".join(f"r{i}q{j}" for j in range(50)), "", 0, 0) for i in range(1000)]
    sets = [shingles(t, 3) for _, t, *_ in rows]
    want = {(a, b) for a, b in itertools.combinations(range(30), 2) if 2 * len(sets[a] & sets[b]) >= len(sets[a] | sets[b])}
    got = pairs(spark, rows + rest, shingle=3, similarity=0.5, least_words=40)
    assert got <= want and len(got) >= least * len(want) > 10


def test_pair_astride_the_limit(spark):
    """One text of just under three quarters of common shingles, the other just over it."""
    head = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(0, 40, 2):
        tail = [f"o{i}x{j}" for j in range(52)]
        rows += [(i, " ".join(head + tail), "", 0, 0), (i + 1, " ".join(head + tail[:46]), "", 0, 0)]
    rows = rows + [(1000 + i, " ".join(f"r{i}q{j}" for j in range(50)), "", 0, 0) for i in range(1000)]
    got = pairs(spark, rows, shingle=3, similarity=0.9, least_words=40)
    assert got == {(i, i + 1) for i in range(0, 40, 2)}


def test_common_shingles_are_exact(spark):
    """However the texts are parted, the same shingles are common, and all that are."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["a b c d", "e f g", f"x{i} y{i}"]) for _ in range(6)) + (" r s t" if i % 60 == 0 else " u v w" if i % 150 == 0 else "")) for i in range(6000)]
    every = [tuple(w[k : k + 3]) for _, t in rows for w in [t.split()] for k in range(len(w) - 2)]
    want = sum(n > 60 for n in __import__("collections").Counter(every).values())
    df = spark.createDataFrame(rows, "id long, text string")
    one, many = (N.common_shingles(df.repartition(k), 3) for k in (1, 13))
    assert len(one) == want > 10 and (one == many).all()


def test_an_id_with_two_texts(spark):
    a, b = " ".join(WORDS[:60]), " ".join(WORDS[200:260])
    rows = [(1, a, "", 0, 0), (1, b, "", 0, 0), (2, a + " z", "", 0, 0), (3, b + " z", "", 0, 0)]
    assert pairs(spark, rows, shingle=3, similarity=0.5, least_words=40) == {(1, 2), (1, 3)}


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("Ivo Tevveney v Dagsuzell", "DAGSUZELL AGAINST I. TEVVENEY", True), ("Bd. of Educ. of Tevlanjord v. Levrigard Ferry Co., Inc.", "Board of Education of Tevlanjord, Respondent, v Levrigard Ferry Company, Appellant", True),
        ("Estate of Emeric Plemiost v Town of Ardselrath", "Matter of Emeric Pelmiost, as Executor v Town of Ardselrath", True), ("Vardindell Insurance Company v Rostuorn", "Rostuorn v Vardidnell Insurance Company", True),
        ("Ivo Galdin v Karruung", "Petra Galdin v Karruung", False), ("Town of Kesvigill v Narvoling", "Village of Kesvigill v Narvoling", False), ("Mulhagard Foundry Company v Xarroth", "Mulhagard Textile Company v Xarroth", False),
        ("Alpharen v Betamoor", "Alpharen v Gammadell", False),
    ],
)
def test_names(spark, a, b, same):
    assert N.same_matter(N.parties(a), N.parties(b)) is same
    rows = spark.createDataFrame([(1, a, "x"), (2, b, "x"), (3, None, "x"), (4, "", "x"), (5, "no parties", "x"), (1, a, "x")], "id long, name string, class string")
    assert {tuple(r) for r in N.member_pairs(*N.similar_names(rows)).collect()} == ({(1, 2)} if same else set())


def test_no_names(spark):
    members, links = N.similar_names(spark.createDataFrame([], "id long, name string"))
    assert members.count() == 0 and links.count() == 0
