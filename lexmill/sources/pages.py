"""Page records of bound volumes: words with places and fonts, as a PDF reader gives them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = "volume string, page_index int, text string, x0 double, x1 double, top double, bottom double, size double"


def _lines_of(pdf: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    words = pdf.sort_values(["top", "x0"], kind="stable")
    line, anchor, numbers = -1, None, []
    for top in words["top"]:
        if anchor is None or abs(top - anchor) > tolerance:
            line, anchor = line + 1, top  # the line's first word is its anchor
        numbers.append(line)
    words = words.assign(line_no=numbers).sort_values(["line_no", "x0"], kind="stable")
    g = words.groupby("line_no")
    return pd.DataFrame(
        {
            "volume": pdf["volume"].iloc[0], "page_index": int(pdf["page_index"].iloc[0]), "line_no": list(g.groups), "text": g["text"].agg(" ".join).to_list(),
            "x0": g["x0"].min().to_list(), "x1": g["x1"].max().to_list(), "top": g["top"].min().to_list(), "size": g["size"].median().to_list(),
        }
    )


def visual_lines(words: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Words grouped to lines: a word whose top is further than ``tolerance`` from the line's first word begins a new one."""
    schema = "volume string, page_index int, line_no int, text string, x0 double, x1 double, top double, size double"
    rows = words.where("text is not null and top is not null").select(*[c.split()[0] for c in WORD.split(", ")])
    return rows.groupBy("volume", "page_index").applyInPandas(lambda pdf: _lines_of(pdf, tolerance), schema)


def sections(lines: DataFrame, marks: dict[str, str]) -> DataFrame:
    """(volume, page_index, section, banner): each page's section by the first line that matches a mark, else the one before."""
    hit = F.lit(None).cast("string")
    for name, pattern in marks.items():
        hit = F.when(F.col("text").rlike(pattern), F.lit(name)).otherwise(hit)
    pages = lines.groupBy("volume", "page_index").agg(F.min(F.when(hit.isNotNull(), F.struct("line_no", hit.alias("s")))).alias("m"))
    w = Window.partitionBy("volume").orderBy("page_index")
    rows = pages.withColumn("section", F.last(F.col("m.s"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select("volume", "page_index", "section", (F.col("section").isNotNull() & ~F.col("section").eqNullSafe(F.lag("section").over(w))).alias("banner"))


def table_of_cases(words: DataFrame, middle: float, tolerance: float = 2.0) -> DataFrame:
    """(volume, page_index, name, page) of a two-column table of cases; an entry may name several pages."""
    side = words.withColumn("volume", F.concat("volume", F.lit("\t"), F.when(F.col("x0") < middle, "0").otherwise("1")))
    rows = visual_lines(side, tolerance)
    entry = r"^(.*?)[ .…]+([0-9]+(?:\s*,\s*[0-9]+)*)$"
    hits = rows.where(F.col("text").rlike(entry)).select(F.split("volume", "\t")[0].alias("volume"), "page_index", F.trim(F.regexp_extract("text", entry, 1)).alias("name"), F.regexp_extract("text", entry, 2).alias("p"))
    return hits.select("volume", "page_index", "name", F.explode(F.split("p", r"\s*,\s*").cast("array<int>")).alias("page"))


def case_ranges(lines: DataFrame, start: str) -> DataFrame:
    """(volume, case_no, first_page, first_line, last_page): cases begin at lines like ``start`` and reach to the next."""
    w = Window.partitionBy("volume").orderBy("page_index", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("case_no", F.sum(F.col("text").rlike(start).cast("int")).over(w)).where("case_no > 0")
    return rows.groupBy("volume", "case_no").agg(F.min("page_index").alias("first_page"), F.min_by("line_no", F.struct("page_index", "line_no")).alias("first_line"), F.max("page_index").alias("last_page"), F.count(F.lit(1)).alias("n_lines"))
