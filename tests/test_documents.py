import json

from pyspark.sql import functions as F

from lexmill.functions import payload as P
from lexmill.operators import documents as D
from lexmill.sources import markup


def test_outline(spark):
    t = spark.createDataFrame([(1, "## A\n- one\n### s\n- two\n## B\n- three\ntext"), (2, None), (3, "- early")], "id int, text string")
    assert [(r.id, r.category, r.subcategory, r["item"]) for r in D.outlined(t).orderBy("id", "n").collect()] == [(1, "A", None, "one"), (1, "A", "s", "two"), (1, "B", None, "three"), (3, None, None, "early")]


def test_segments(spark):
    rows = [(1, 1, "majority", "X"), (1, 2, "header", None), (1, 3, "majority", "X"), (1, 4, None, None), (1, 5, "dissent", None)]
    got = D.opinion_segments(spark.createDataFrame(rows, "case_id long, page int, kind string, author string")).orderBy("run").collect()
    assert [(r.kind, r.author, r.first_page, r.last_page) for r in got] == [("majority", "X", 1, 3), ("dissent", None, 5, 5)]


def test_notes(spark):
    rows = [
        (1, "mark", 0, 1, 1, "1", None), (1, "mark", 0, 2, 1, "2,3", None), (1, "mark", 1, 5, 1, "1", None), (1, "mark", 1, 6, 1, "9", None),
        (1, "note", None, 1, 9, "1", "n1"), (1, "note", None, 3, 9, "2", "n2"), (1, "note", None, 2, 9, "3", "n3"), (1, "note", None, 4, 9, "1", "again"),
    ]
    got = {(r.page, r.label): r.note for r in D.claimed_notes(spark.createDataFrame(rows, "case_id long, kind string, opinion int, page int, n int, label string, text string")).collect()}
    assert got == {(1, "1"): "n1", (2, "2"): "n2", (2, "3"): "n3", (5, "1"): "again", (6, "9"): None}


def test_header(spark):
    rows = [(1, i, t) for i, t in enumerate(["noise", "[30 X3d 1]", "A, Respondent,", "v", "B, Appellant.", "Decided May 1, 2001", "body"])]
    r = D.case_header(spark.createDataFrame(rows, "case_id long, n int, text string"), r"^\[", "^Decided").first()
    assert (r.cite, r.caption, r.date, r.end) == ("[30 X3d 1]", "A, Respondent, v B, Appellant.", "Decided May 1, 2001", 5)


def test_small_functions(spark):
    df = spark.createDataFrame([("Matter of A v B (Anonymous)", "VOLUME 30, Third Series", " ", "x")], "a string, b string, c string, d string")
    r = df.select(D.matter_name(F.col("a")).alias("m"), D.volume_of(F.col("b")).alias("v"), D.fallback(F.col("c"), F.col("d")).alias("f"), D.first_of(F.col("a"), ["v B", "A v", "zz"]).alias("p")).first()
    assert (r.m, r.v.volume, r.v.series, r.f, r.p) == ("A v B, Matter of", 30, 3, "x", 11)


def test_payloads(spark):
    good = 'Sure: {"h":[{"t":"x","n":1}],"d":[" a ","",null,"b"],"case":[{"keyword":" Tort ","relevance":0.9},{"keyword":"low","relevance":0.1}]}'
    df = spark.createDataFrame([(1, good), (2, "none {"), (3, None)], "id int, t string").withColumn("j", P.json_in(F.col("t")))
    rows = df.orderBy("id").select("j", P.clean_strings(F.col("j"), "d").alias("d"), P.renamed_items(F.col("j"), "h", {"t": ("title", "string"), "n": ("number", "int")}).alias("h")).collect()
    assert [r.j is None for r in rows] == [False, True, True] and rows[0].d == ["a", "b"] and rows[1].d == [] and (rows[0].h[0].title, rows[0].h[0].number) == ("x", 1)
    assert [tuple(r) for r in P.keyword_rows(df, "j", ["case", "other"]).collect()] == [(1, "case", "tort", 0.9)]
    rules = {"no_json": F.col("j").isNull(), "long": F.length("t") > 20}
    assert [r.f for r in df.orderBy("id").select(P.faults(rules).alias("f")).collect()] == [["long"], ["no_json"], ["no_json"]]
    assert {(r.kind, r.rule, r.n) for r in P.rule_report(df, {"no_json": rules["no_json"]}, {"long": rules["long"]}).collect()} == {("hard", "no_json", 2), ("soft", "long", 1)}


def test_law_tree(spark, tmp_path):
    tree = {"result": {"info": {"lawId": "PEN", "name": "Penal"}, "documents": {"documents": {"items": [{"locationId": "A1", "docType": "ARTICLE", "title": "One", "documents": {"items": [{"docType": "X", "documents": {"items": [{"locationId": "1.05", "docType": "SECTION", "text": "t"}]}}]}}]}}}}
    (tmp_path / "a.json").write_text(json.dumps(tree))
    (tmp_path / "b.json").write_text("{broken")
    got = [(r.id, r.parent, r.depth, r.type) for r in markup.law_json(spark, str(tmp_path)).orderBy("depth").collect()]
    assert got == [("law:pen:law", None, 0, "law"), ("law:pen:a1", "law:pen:law", 1, "article"), ("law:pen:1.05", "law:pen:a1", 2, "section")]


def test_finders(spark):
    df = spark.createDataFrame([("Title of it\nIndex No. 123/04 and Case No. 9\fThe body\nhere", ["Tax Law", "TAX"], " 12-A "), (None, None, "")], "t string, a array<string>, n string")
    r = df.select(D.docket_of(F.col("t")).alias("d"), D.front_and_body(F.col("t")).alias("f"), D.law_curies(F.lit("tax"), F.col("a"), "section", F.col("n")).alias("c")).collect()
    assert (r[0].d, r[0].f.title, r[0].f.body) == ("123/04", "Title of it", "The body\nhere")
    assert (r[0].c.primary, r[0].c.aliases) == ("tax:12-a", ["tax-law:12-a"]) and r[1].d is None and r[1].f is None and r[1].c is None
    c = spark.createDataFrame([("A v B, Respondent. C & D v E; Matter of X v Y.",)], "t string").select(D.captions(F.col("t")).alias("c")).first().c
    assert c == ["A v B, Respondent.", "C & D v E", "Matter of X v Y."]


def test_providers(spark):
    from lexmill.functions import providers

    rows = spark.createDataFrame([(1, "a b", None), (2, " ", None), (3, None, None), (4, "kept", [1.0])], "id int, t string, embedding array<float>")
    got = {r.id: r.embedding for r in providers.with_embeddings(rows, "t", providers.hashed_embedding(8), batch=1).collect()}
    assert len(got[1]) == 8 and got[2] is None and got[3] is None and got[4] == [1.0]
    assert [r.answer for r in providers.with_answers(rows, "t", lambda ts: [t.upper() for t in ts]).orderBy("id").collect()] == ["A B", None, None, "KEPT"]
    assert spark.createDataFrame([("ﬁ①",), (None,)], "t string").select(providers.unicode_folded(F.col("t")).alias("x")).collect()[0].x == "fi1"
