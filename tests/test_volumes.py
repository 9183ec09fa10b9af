from pyspark.sql import functions as F

from lexmill.operators import volumes as V


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


def test_small_caps(spark):
    words = [("v", 1, 1, 10.0, 14.0, 11.0, "M"), ("v", 1, 1, 14.5, 30.0, 8.0, "YERS"), ("v", 1, 1, 35.0, 38.0, 11.0, "v"), ("v", 1, 1, 42.0, 46.0, 11.0, "R"), ("v", 1, 1, 46.2, 60.0, 8.0, "OE"), ("v", 1, 2, 10.0, 14.0, 8.0, "OE")]
    got = V.small_caps(spark.createDataFrame(words, "volume string, page_index int, line_no int, x0 double, x1 double, size double, text string"))
    assert [r.text for r in got.orderBy("line_no", "x0").collect()] == ["MYERS", "v", "ROE", "OE"]


def test_opinions(spark):
    lines = ["caption", "SMITH, J.", "We affirm.", "O'NEIL, J. (concurring in part and dissenting in part).", "I differ.", "Per Curiam.", None]
    got = V.opinions_of(spark.createDataFrame([(1, i, t) for i, t in enumerate(lines)], "case_id long, n int, text string")).orderBy("opinion_index").collect()
    assert [(r.kind, r.author) for r in got] == [("majority", "Smith"), ("concurrence-dissent", "O'neil"), ("per-curiam", "Per Curiam")]
    assert got[0].text == "SMITH, J.\nWe affirm."


def test_motions(spark):
    lines = ["A v B. (Reported below, 1 X 2)", "Motion for leave to appeal denied.", "C v D.", "Motion for reargument", "granted."]
    got = V.motion_entries(spark.createDataFrame([("v", 1, i, t) for i, t in enumerate(lines)], "volume string, page int, n int, text string")).orderBy("entry").collect()
    assert [(r.caption, r.below, r.disposition) for r in got] == [("A v B", "Reported below, 1 X 2", "Motion for leave to appeal denied."), ("C v D", None, "Motion for reargument granted.")]


def test_marks_and_references(spark):
    r = one(spark, "ab⟦fn:1⟧c⟦p:30⟧⟦fn:*⟧d", V.without_marks)
    assert r.text == "abcd" and [(m.offset, m.kind, m.label) for m in r.marks] == [(2, "fn", "1"), (3, "p", "30"), (3, "fn", "*")]
    assert one(spark, "plain", V.without_marks).marks == [] and one(spark, None, V.without_marks) is None
    assert one(spark, "[1, 2]. ", V.split_marker) == ["1", "2"]
    assert one(spark, "SmithvJones&Co.", V.spaced_name) == "Smith v Jones & Co."
    assert one(spark, "section 12(a)(1) of title 5", lambda c: V.section_paths(c, F.lit(9))) == ["/us/usc/t5/s12/a/1"]
    assert one(spark, "sections 1, 2a and 3 of this title", lambda c: V.section_paths(c, F.lit(9))) == ["/us/usc/t9/s1", "/us/usc/t9/s2a", "/us/usc/t9/s3"]
    n = one(spark, "Section enacted by Pub. L. 99–1. Amended by Pub. L. 100-2. See section 5 of title 3. This Act may be cited as the ‘Short Act’.", V.note_data)
    assert (n.enacted, n.amended, n.repealed, n.short_title, n.refs) == (["Pub. L. 99–1"], ["Pub. L. 100-2"], [], "Short Act", ["section 5 of title 3"])
