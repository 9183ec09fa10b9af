"""Walks over the lines and notes of documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import runs


def outlined(texts: DataFrame) -> DataFrame:
    """texts(id, text) -> (id, n, category, subcategory, item) of '## category', '### subcategory' and '- item' lines.

    A new category ends the subcategory before it.
    """
    lines = texts.select("id", F.posexplode(F.split("text", "\r?\n")).alias("n", "line")).withColumn("line", F.trim("line"))
    w = Window.partitionBy("id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    cat = F.when(F.col("line").rlike("^## "), F.trim(F.substring("line", 4, 1000)))
    lines = lines.withColumn("block", F.count(cat).over(w)).withColumn("category", F.last(cat, ignorenulls=True).over(w))
    v = Window.partitionBy("id", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    sub = F.when(F.col("line").rlike("^### "), F.trim(F.substring("line", 5, 1000)))
    lines = lines.withColumn("subcategory", F.last(sub, ignorenulls=True).over(v))
    return lines.where(F.col("line").rlike("^- ")).select("id", "n", "category", "subcategory", F.trim(F.substring("line", 3, 10000)).alias("item"))


def opinion_segments(pages: DataFrame) -> DataFrame:
    """pages(case_id, page, kind, author) -> runs of pages of one kind and author; pages without a kind join their neighbours."""
    known = pages.where("kind is not null and kind <> 'header'").withColumn("state", F.concat_ws("\x1f", "kind", F.coalesce("author", F.lit(""))))
    out = runs(known, ["case_id"], ["page"], "state")
    part = F.split("state", "\x1f")
    return out.select("case_id", "run", part[0].alias("kind"), F.when(part[1] != "", part[1]).alias("author"), F.col("first").alias("first_page"), F.col("last").alias("last_page"))


def _claims(pdf: pd.DataFrame) -> pd.DataFrame:
    notes = pdf[pdf["kind"] == "note"].sort_values(["page", "n"])
    marks = pdf[pdf["kind"] == "mark"].sort_values(["page", "n"])
    free = list(notes.itertuples())
    rows = []
    for m in marks.itertuples():
        for label in str(m.label).replace(" ", "").split(","):  # a composite mark claims one note for each part
            tests = (lambda x: x.page == m.page, lambda x: x.page == m.page + 1, lambda x: x.page == m.page - 1, lambda x: True)
            hit = next((x for t in tests for x in free if x.label == label and t(x)), None)
            if hit is not None:
                free = [x for x in free if x is not hit]
            rows.append((m.case_id, m.opinion, int(m.page), label, hit.text if hit is not None else None))
    return pd.DataFrame(rows, columns=["case_id", "opinion", "page", "label", "note"])


def claimed_notes(rows: DataFrame) -> DataFrame:
    """Footnotes by the marks that refer to them: on the mark's page, else the next, else the one before, else anywhere.

    rows(case_id, kind mark or note, opinion, page, n, label, text); a note is claimed once, marks are served in order.
    A case's notes are one bounded group.
    """
    cols = ["case_id", "kind", "opinion", "page", "n", "label", "text"]
    return rows.select(*cols).groupBy("case_id").applyInPandas(_claims, "case_id long, opinion int, page int, label string, note string")


def case_header(lines: DataFrame, cite: str, date: str) -> DataFrame:
    """lines(case_id, n, text) -> (case_id, cite, caption, date, end): the caption stands between the cite and date lines."""
    at = lambda p: F.min(F.when(F.col("text").rlike(p), F.col("n"))).over(Window.partitionBy("case_id"))
    rows = lines.withColumn("c", at(cite)).withColumn("d", at(date)).where("n <= d")
    between = F.when((F.col("n") > F.col("c")) & (F.col("n") < F.col("d")) & (F.trim("text") != ""), F.struct("n", F.trim("text").alias("t")))
    g = rows.groupBy("case_id").agg(
        F.max(F.when(F.col("n") == F.col("c"), F.col("text"))).alias("cite"), F.sort_array(F.collect_list(between)).alias("b"), F.max(F.when(F.col("n") == F.col("d"), F.col("text"))).alias("date"), F.max("d").alias("end")
    )
    return g.select("case_id", "cite", F.array_join(F.transform("b", lambda x: x.t), " ").alias("caption"), "date", "end")


def first_of(text: Column, patterns: list[str]) -> Column:
    """The place of the earliest match of any pattern, 0 for none."""
    places = [F.nullif(F.regexp_instr(text, F.lit(p)), F.lit(0)) for p in patterns]
    return F.coalesce(F.least(*places) if len(places) > 1 else places[0], F.lit(0))


def matter_name(name: Column) -> Column:
    """'Matter of X v Y' as 'X v Y, Matter of', without remarks in brackets."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(name, r"\([^)]*\)", " "), r"\s+", " "))
    return F.when(bare.rlike("(?i)^(in the )?matter of "), F.concat(F.regexp_replace(bare, "(?i)^(in the )?matter of ", ""), F.lit(", Matter of"))).otherwise(bare)


def volume_of(title: Column) -> Column:
    """struct(volume, series) from a title page: 'VOLUME 30' and '3d Series' in either order."""
    v = F.regexp_extract(title, r"(?i)\bvol(?:ume|\.)?\s*([0-9]+)", 1).try_cast("int")
    s = F.when(title.rlike(r"(?i)\b(third|3d) series"), 3).when(title.rlike(r"(?i)\b(second|2d) series"), 2).otherwise(1)
    return F.when(v.isNotNull(), F.struct(v.alias("volume"), s.alias("series")))


def fallback(*fields: Column) -> Column:
    """The first field that says something: null and blank ones do not."""
    return F.coalesce(*(F.when(F.trim(f) != "", f) for f in fields))


# fixed values: what introduces a docket number, in order of preference
DOCKETS = (r"(?i)\bindex no\.?\s*:?\s*([0-9][0-9A-Za-z/\-]*)", r"(?i)\b(?:appeal|case) no\.?\s*:?\s*([0-9][0-9A-Za-z/\-]*)", r"(?i)\bdocket no\.?\s*:?\s*([0-9][0-9A-Za-z/\-]*)", r"\b([0-9]{4}-[0-9]{3,6})\b")


def docket_of(text: Column) -> Column:
    """The docket number by the first pattern that fits, null if none does."""
    return F.coalesce(*(F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in DOCKETS))


def front_and_body(text: Column) -> Column:
    """struct(title, body) of a text with form feeds: the first line that is no longer than 250, and what follows the first feed."""
    lines = F.filter(F.transform(F.split(text, "[\r\n\f]+"), lambda s: F.trim(s)), lambda s: (s != "") & (F.length(s) <= 250))
    at = F.instr(text, "\f")
    return F.when(text.isNotNull(), F.struct(F.get(lines, 0).alias("title"), F.when(at > 0, F.substring(text, at + 1, F.length(text))).otherwise(text).alias("body")))


def law_curies(code: Column, aliases: Column, kind: str, number: Column) -> Column:
    """struct(primary, aliases) of a section's or article's identifiers under a law's code and its other names."""
    place = F.concat(F.lit("" if kind == "section" else f"{kind}-"), F.lower(F.trim(number)))
    made = lambda c: F.concat(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit(":"), place)
    primary = made(code)
    other = F.filter(F.array_distinct(F.transform(F.coalesce(aliases, F.array().cast("array<string>")), made)), lambda a: a != primary)
    return F.when(F.trim(number) != "", F.struct(primary.alias("primary"), other.alias("aliases")))


def captions(text: Column) -> Column:
    """The captions of a run of them: a new one begins where a sentence end is followed by a name with its own 'v'."""
    return F.filter(F.transform(F.split(text, r"(?<=[.;])\s+(?=[A-Z][^.;]{2,120}?\bv\.?\s)"), lambda c: F.trim(F.regexp_replace(c, r"[\s;]+$", ""))), lambda c: c.rlike(r"\bv\.?\s"))
