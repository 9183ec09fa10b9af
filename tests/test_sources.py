import json
import zipfile

from pyspark.sql import functions as F

from lexmill.operators import citations
from lexmill.plans.lineage import salted_join, sized
from lexmill.sources import archives, markup, pages, sinks
from lexmill.streaming import incremental

LAW = """<lawDoc xmlns="http://x"><title identifier="/us/usc/t1"><heading>General</heading>
<section identifier="/us/usc/t1/s1"><num>1</num><heading> Words </heading><content>(a)(1) In this Act<footnote>note</footnote> words mean.</content></section>
<section identifier="/us/usc/t1/s1"><heading>Words</heading></section><section identifier="/us/usc/t1/s2">(b) Plain text</section><section>no id</section></title></lawDoc>"""
MODERN = """<html><div class="case-info"><h1>A v B</h1><p>2003 NY Slip Op 17895(U)</p><p>Decided on May 2, 2003</p><p>Supreme Court</p></div><div class="parties">A, Respondent,<br>v<br>B</div><p>First.</p><p>Second &amp; last.</p><a href="x.ZIP">z</a></html>"""
LEGACY = """<table bgcolor="#FFFF80"><tr><td>A v B</td></tr><tr><td>2004 NY Slip Op 00012</td></tr><tr><td>Decided on June 1, 2004</td></tr><tr><td>City Court</td></tr></table><table bgcolor="#99cccc"><tr><td>A,<br>v<br>B</td></tr></table><p>Body.</p>"""


def test_law_xml(spark, tmp_path):
    (tmp_path / "t1.xml").write_text(LAW)
    (tmp_path / "bad.xml").write_text("<a>")
    got = [(r.identifier, r.content_type, r.content) for r in markup.law_xml(spark, str(tmp_path)).orderBy("n").collect()]
    assert got == [
        ("/us/usc/t1", "heading", "General"), ("/us/usc/t1/s1", "heading", "Words"), ("/us/usc/t1/s1", "body", "In this Act words mean."), ("/us/usc/t1/s1#dup1", "heading", "Words"), ("/us/usc/t1/s2", "body", "Plain text"),
    ]


def test_levels():
    xml = '<D><LEVEL id="a"><RECORD id="r"><HEADING>H</HEADING><PARA>One  two</PARA></RECORD><LEVEL id="b"><RECORD><PARA>x</PARA></RECORD></LEVEL><LEVEL id="a"/></LEVEL></D>'
    assert markup.levels_and_records(xml) == [("a", None, 0, "H", "One two"), ("b", "a", 1, "", "x")]


def test_slip_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text(MODERN)
    (tmp_path / "b.html").write_text(LEGACY)
    (tmp_path / "c.html").write_text("<p>nothing")
    a, b, c = markup.slip_html(spark, str(tmp_path)).orderBy("path").collect()
    assert (a.layout, a.title, a.caption, a.year, a.number, a.unreported, a.court, a.body) == ("modern", "A v B", "A, Respondent, v B", 2003, "17895", True, "Supreme Court", "First.\nSecond & last.")
    assert (b.layout, b.title, b.caption, b.year, b.number, b.unreported, b.court, b.body) == ("legacy", "A v B", "A, v B", 2004, "00012", False, "City Court", "Body.")
    assert c.layout is None and c.year is None
    assert markup.links(MODERN, ".zip") == ["x.ZIP"]
    assert [archives.format_of(x) for x in (b"%PDF-1", MODERN, LEGACY, "saved from url=(9)http://h/reporter/3dseries/x", "text")] == ["pdf", "html-modern", "html-legacy", "html-legacy", "unknown"]


def test_archives(spark, tmp_path):
    folder = tmp_path / "src1"
    folder.mkdir()
    with zipfile.ZipFile(folder / "12.zip", "w") as z:
        z.writestr("json/1.json", json.dumps({"id": 5, "name": "A v B", "court": {"name": "C"}, "casebody": {"data": {"opinions": [{"type": "majority", "text": "t"}]}}}))
        z.writestr("json/2.json", "{broken")
        z.writestr("html/1.html", "x")
    bodies = archives.zip_of_json(spark, str(tmp_path))
    assert {(r.source, r.volume, r.entry) for r in bodies.collect()} == {("src1", 12, "json/1.json"), ("src1", 12, "json/2.json")}
    (case,) = archives.case_fields(bodies).collect()
    assert (case.id, case.court_name, case.citations, len(case.opinions)) == (5, "C", [], 1)
    names = spark.createDataFrame([("p", "a/x.xml"), ("p", "b/x.xml"), ("p", "c/y")], "path string, entry string")
    assert sorted(r.name for r in archives.flat_names(names).collect()) == ["x.xml", "x_1.xml", "y"]


def test_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(' [{"a": 1}, {"a": 2}]')
    (tmp_path / "b.json").write_text('{"a": 3}\nnot json\n\n{"a": 4}')
    (tmp_path / "c.json").write_text("[{]")
    rows = archives.json_records(spark, str(tmp_path)).collect()
    assert sorted(json.loads(r.record)["a"] for r in rows if r.record) == [1, 2, 3, 4]
    assert sum(r.fault is not None for r in rows) == 2
    lines = tmp_path / "units"
    lines.mkdir()
    (lines / "u.ndjson").write_text('{"type":"unit","id":"x"}\n{"type":"alias","alias":"y"}\n{"type":"odd"}\n{nope\n')
    parts, skipped = archives.by_type(spark, str(lines), {"unit": "id string", "alias": "alias string"})
    assert [r.id for r in parts["unit"].collect()] == ["x"] and [r.alias for r in parts["alias"].collect()] == ["y"]
    assert {r.reason: r.n for r in skipped.collect()} == {"malformed": 1, "unknown type": 1}
    (tmp_path / "v.log").write_text("Title 1\nskip\nline 4 bad\nTitle 2\nline 9 bad\n")
    assert [(r.section, r.line) for r in archives.log_sections(spark, str(tmp_path / "v.log"), r"^Title (\d+)", "^line").orderBy("line_no").collect()] == [("1", "line 4 bad"), ("2", "line 9 bad")]


def test_pages(spark):
    w = [("v", 1, "B", 60.0, 70.0, 11.5, 20.0, 9.0), ("v", 1, "A", 10.0, 20.0, 10.0, 20.0, 9.0), ("v", 1, "C", 10.0, 20.0, 12.4, 20.0, 9.0), ("v", 1, None, 1.0, 1.0, None, 1.0, 1.0), ("v", 2, "Smith ..... 12, 14", 10.0, 50.0, 10.0, 12.0, 9.0), ("v", 2, "Jones .... 3", 210.0, 250.0, 10.0, 12.0, 9.0)]
    words = spark.createDataFrame(w, pages.WORD)
    assert [r.text for r in pages.visual_lines(words).where("page_index = 1").orderBy("line_no").collect()] == ["A B", "C"]
    assert sorted((r.name, r.page) for r in pages.table_of_cases(words, 200.0).collect()) == [("Jones", 3), ("Smith", 12), ("Smith", 14)]
    lines = pages.visual_lines(words)
    assert [(r.section, r.banner) for r in pages.sections(lines, {"cases": "^A", "index": "^Smith"}).orderBy("page_index").collect()] == [("cases", True), ("index", True)]
    assert [(r.case_no, r.first_page, r.last_page) for r in pages.case_ranges(lines, "^(C|Smith)").orderBy("case_no").collect()] == [(1, 1, 1), (2, 2, 2)]


def test_citations(spark):
    reporters = spark.createDataFrame([("N.Y.3d", "NY3D", ["NY3d"]), ("N.Y.", "NY", None)], "canonical string, norm string, aliases array<string>")
    texts = spark.createDataFrame([(1, "Foo v Bar, 12 N.Y.3d 45; 12 NY3d 45; 7 NY 9\n0 and 1 Other 2"), (2, None)], "id int, text string")
    assert sorted((r.norm, r.volume, r.page) for r in citations.case_citations(texts, reporters).collect()) == [("NY", 7, 9), ("NY3D", 12, 45)]
    laws = spark.createDataFrame([(1, "See 42 U.S.C. § 1983, 29 C.F.R. § 1910.95 and 34 RCNY § 4-08.")], "id int, text string")
    assert sorted(r.curie for r in citations.law_citations(laws).collect()) == ["cfr:29-1910.95", "rcny:34-4-08", "usc:42-1983"]
    p = spark.createDataFrame([("Concur—Smith, J.P., Roe and O'Neil, JJ.",), ("none",)], "t string").select(citations.panel(F.col("t")).alias("p"))
    assert [r.p for r in p.collect()] == [["Smith", "Roe", "O'Neil"], []]
    dep = spark.createDataFrame([("Kings", 2), ("New York", 1), ("Erie", 4)], "county string, department int")
    t = spark.createDataFrame([(1, "Supreme Court, Kings County"), (2, "the County of New York and Erie County"), (3, "elsewhere")], "id int, text string")
    assert {r.id: (r.department, r.conflict) for r in citations.counties(t, dep).collect()} == {1: (2, False), 2: (None, True)}


def test_sinks(spark, tmp_path):
    cases = spark.createDataFrame([(1, "A")], "id int, name string")
    cites = spark.createDataFrame([(1, "1 X 2", "official")], "case_id int, cite string, citation_type string")
    ops = spark.createDataFrame([(1, 1, "dissent", None, "b"), (1, 0, "majority", "J", "a")], "case_id int, opinion_index int, opinion_type string, author string, text string")
    doc = json.loads(sinks.case_documents(cases, cites, ops).first().document)
    assert [o["text"] for o in doc["opinions"]] == ["a", "b"] and doc["citations"][0]["cite"] == "1 X 2"
    parts = str(tmp_path / "parts")
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), parts, ["k"])
    sinks.write_partitioned(spark.createDataFrame([(2, "c")], "k int, v string"), parts, ["k"])
    assert {(r.k, r.v) for r in spark.read.parquet(parts).collect()} == {(1, "a"), (2, "c")}


def test_new_files_only(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    for i in range(2):
        spark.createDataFrame([(i, "x")], "id int, v string").write.mode("append").parquet(src)
        incremental.run_new(spark, src, "id int, v string", lambda rows: rows.withColumn("w", F.upper("v")), out, state)
    assert sorted((r.id, r.w) for r in spark.read.parquet(out).collect()) == [(0, "X"), (1, "X")]


def test_joins(spark):
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(60)], "k int, r int")
    small = spark.createDataFrame([(1, "a"), (3, "b")], "k int, v string")
    assert salted_join(big, small, ["k"], F.col("r")).count() == big.join(small, "k").count()
    assert "broadcast" in sized(small)._jdf.queryExecution().toString() and "broadcast" not in sized(big, 5)._jdf.queryExecution().analyzed().toString()


def test_panels_in_four_forms(spark):
    from lexmill.operators import citations

    rows = [
        ("Concur—Smith, J.P., Roe and O'Neil, JJ. Ordered that", ["O'Neil", "Roe", "Smith"]), ("The appeal is without merit.\nGarry, P.J., Egan Jr. and Lynch, JJ., concur.", ["Egan Jr.", "Garry", "Lynch"]),
        ("Jones, J., concurs with Brown, J., in a memorandum; Gray, J., dissents.", ["Brown", "Gray", "Jones"]), ("Present: The Court, of Appeals", []), ("", []), (None, None),
    ]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(citations.panel(F.col("t")).alias("p")).collect()
    assert [None if r.p is None else sorted(r.p) for r in got] == [w for _, w in rows]


def test_case_names(spark):
    from lexmill.operators import citations

    reporters = spark.createDataFrame([("Tam.", ["Tam"], "TAM")], "canonical string, aliases array<string>, norm string")
    texts = spark.createDataFrame([(1, "Later, Smith v. Jones, 5 Tam. 6; Rowe v Doe; 7 Tam 8. Then 9 Tam. 10, and again 5 Tam. 6.", "x"), (2, None, "x")], "id int, text string, raw string")
    assert sorted((r.volume, r.page, r.case_name) for r in citations.case_citations(texts, reporters).collect()) == [(5, 6, "Smith v. Jones"), (7, 8, "Rowe v Doe"), (9, 10, None)]
