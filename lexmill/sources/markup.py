"""Sources in XML and HTML, read with the standard library's parsers inside tasks."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import reachable

# fixed values: the levels of a law
LEVELS = ("title", "subtitle", "chapter", "subchapter", "part", "subpart", "section", "subsection", "paragraph", "subparagraph", "clause", "subclause", "item")
_MARKS = re.compile(r"^(?:\s*\([0-9A-Za-z]+\))+\s*")


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _text(e: ET.Element, without: tuple[str, ...] = ()) -> str:
    """The text inside an element, that of the named ones left out."""
    out = [e.text or ""]
    for child in e:
        if _name(child) not in without:
            out.append(_text(child, without))
        out.append(child.tail or "")
    return "".join(out)


def law_elements(xml: str) -> list[tuple[int, str, str, str, str]]:
    """(n, identifier, type, content_type, content) of the levels of a law in document order.

    A level has a heading row and one body row of its direct content; a level with neither and no level below gives its
    whole text. Footnotes and leading marks such as (a)(1) are left out.
    """
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    rows = []
    for e in root.iter():
        ident, kind = e.get("identifier"), _name(e)
        if kind not in LEVELS or not ident:
            continue
        heading = next((t for c in e if _name(c) == "heading" and (t := _text(c).strip())), None)
        parts = [t for c in e if _name(c) in ("content", "chapeau", "p") and (t := _text(c, ("footnote",)).strip())]
        if heading:
            rows.append((len(rows), ident, kind, "heading", heading))
        if parts:
            rows.append((len(rows), ident, kind, "body", _MARKS.sub("", "\n".join(parts))))
        below = any(_name(c) in LEVELS and c.get("identifier") for c in e)
        if not heading and not parts and not below and (t := _text(e).strip()):
            rows.append((len(rows), ident, kind, "body", _MARKS.sub("", t)))
    return rows


def _files(batches: Iterator[pd.DataFrame], read, columns: list[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(p, *r) for p, c in zip(pdf["path"], pdf["content"], strict=True) for r in read(bytes(c).decode("utf-8", "replace"))]
        yield pd.DataFrame(rows, columns=["path", *columns])


def law_xml(spark: SparkSession, path: str) -> DataFrame:
    """Elements of the laws in a folder; an identifier that came before in its file gets #dup1, #dup2 ..."""
    reachable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return law_units(files)


def law_units(files: DataFrame) -> DataFrame:
    """``law_xml`` of files(path, content)."""
    rows = files.select("path", "content").mapInPandas(lambda b: _files(b, law_elements, ["n", "identifier", "type", "content_type", "content"]), "path string, n int, identifier string, type string, content_type string, content string")
    k = F.row_number().over(Window.partitionBy("path", "identifier", "type", "content_type").orderBy("n")) - 1
    ident = F.when(F.col("k") == 0, F.col("identifier")).otherwise(F.concat("identifier", F.lit("#dup"), F.col("k").cast("string")))
    return rows.withColumn("k", k).select("path", "n", ident.alias("identifier"), "type", "content_type", "content")


def levels_and_records(xml: str, level: str = "LEVEL", record: str = "RECORD") -> list[tuple[str, str | None, int, str, str]]:
    """(id, parent, depth, heading, text) of nested levels that hold records; the first of an id wins."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    rows, seen = [], set()

    todo = [(root, None, 0)]  # no recursion: trees may be deep
    while todo:
        e, parent, depth = todo.pop()
        ident = e.get("id")
        if _name(e) == level and ident and ident not in seen:
            seen.add(ident)
            records = [r for r in e if _name(r) == record]
            heading = next((t for r in records for h in r.iter() if _name(h) == "HEADING" and (t := _text(h).strip())), "")
            paras = [t for r in records for p in r.iter() if _name(p) == "PARA" and (t := re.sub(r"\s+", " ", _text(p)).strip())]
            rows.append((ident, parent, depth, heading, "\n".join(paras)))
            parent, depth = ident, depth + 1
        todo += [(child, parent, depth) for child in reversed(e)]
    return rows


def level_xml(spark: SparkSession, path: str) -> DataFrame:
    reachable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path).select("path", "content")
    return level_units(files)


def level_units(files: DataFrame) -> DataFrame:
    """The levels of files(path, content); of an id that several files hold, that of the first by path."""
    rows = files.select("path", "content").mapInPandas(lambda b: _files(b, levels_and_records, ["id", "parent", "depth", "heading", "text"]), "path string, id string, parent string, depth int, heading string, text string")
    return rows.groupBy("id").agg(F.min_by(F.struct("path", "parent", "depth", "heading", "text"), "path").alias("u")).select("u.path", "id", "u.parent", "u.depth", "u.heading", "u.text")


# ---- HTML


class _Page(HTMLParser):
    """Texts of the elements that matter, with the marks of those around them."""

    VOID = {"br", "img", "meta", "link", "hr", "input"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.blocks: list[tuple[str, str, str]] = []  # tag, marks of its ancestors, text
        self.open: list[list] = []
        self.links: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "br":
            self.handle_data(" ")
        if tag == "a" and a.get("href"):
            self.links.append(a["href"])
        if tag in self.VOID:
            return
        mark = f"{tag}.{a.get('class', '')}.{(a.get('bgcolor') or '').lstrip('#').lower()}"
        self.stack.append((tag, mark))
        if tag in ("p", "h1", "h2", "tr", "td", "title", "div"):
            self.open.append([tag, " ".join(m for _, m in self.stack), ""])

    def handle_data(self, data):
        for b in self.open:
            b[2] += data

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        while self.stack:
            t, _ = self.stack.pop()
            if self.open and self.open[-1][0] == t and t in ("p", "h1", "h2", "tr", "td", "title", "div"):
                kind, marks, text = self.open.pop()
                self.blocks.append((kind, marks, re.sub(r"\s+", " ", text).strip()))
            if t == tag:
                break


_SLIP = re.compile(r"\b(\d{4})\s+[A-Z]{2}\s+Slip\s+Op\s+(\d+)(\(U\))?")


def slip_page(html: str) -> dict:
    """title, caption, year, number, unreported, date_line, court and body of a decision's page of either layout."""
    page = _Page()
    page.feed(html)
    page.close()
    out = dict.fromkeys(("layout", "title", "caption", "year", "number", "unreported", "date_line", "court", "body"))
    modern = any("div.case-info" in m for _, m, _ in page.blocks)
    yellow = [t for k, m, t in page.blocks if k == "tr" and ".ffff80" in m and t]
    if modern:
        lines = [t for k, m, t in page.blocks if k == "p" and "div.case-info" in m]
        out["layout"] = "modern"
        out["title"] = next((t for k, m, t in page.blocks if k == "h1" and "div.case-info" in m), None)
        out["caption"] = next((t for k, m, t in page.blocks if k == "div" and "div.parties" in m), None)
        out["body"] = "\n".join(t for k, m, t in page.blocks if k == "p" and "div.case-info" not in m and "div.parties" not in m and t)
    elif yellow:
        lines = yellow[1:]
        out["layout"], out["title"] = "legacy", yellow[0]
        out["caption"] = " ".join(t for k, m, t in page.blocks if k == "td" and ".99cccc" in m) or None
        out["body"] = "\n".join(t for k, m, t in page.blocks if k == "p" and ".ffff80" not in m and ".99cccc" not in m and t)
    else:
        return out
    for i, line in enumerate(lines):
        if m := _SLIP.search(line):
            rest = lines[i + 1 : i + 3] + [None, None]
            out |= {"year": int(m[1]), "number": m[2], "unreported": bool(m[3]), "date_line": rest[0], "court": rest[1]}
            break
    return out


PAGE = "path string, layout string, title string, caption string, year int, number string, unreported boolean, date_line string, court string, body string"


def slip_html(spark: SparkSession, path: str) -> DataFrame:
    reachable(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in PAGE.split(", ")][1:]
        for pdf in batches:
            rows = [(p, *(x[n] for n in names)) for p, c in zip(pdf["path"], pdf["content"], strict=True) for x in [slip_page(bytes(c).decode("utf-8", "replace"))]]
            out = pd.DataFrame(rows, columns=["path", *names])
            yield out.astype({"year": "Int32", "unreported": "boolean"})

    return files.mapInPandas(read, PAGE)


def links(html: str, end: str = "") -> list[str]:
    page = _Page()
    page.feed(html)
    return [x for x in page.links if x.lower().endswith(end)]


def law_tree(tree: dict | str, code: str = "law") -> list[tuple[str, str | None, int, str, str, str]]:
    """(id, parent, depth, type, label, text) of a law given as nested documents, a root for the whole law first.

    A node without a place of its own hands its children to its parent; repealed ones are kept.
    """
    import json

    if isinstance(tree, str):
        try:
            tree = json.loads(tree)
        except ValueError:
            return []
    law = (tree.get("result") or {}) if isinstance(tree, dict) else {}
    info = law.get("info") or {}
    key = f"{code}:{info.get('lawId', '')}".lower()
    rows = [(f"{key}:law", None, 0, "law", info.get("name") or info.get("lawId") or "", "")]

    def visit(node: dict | None, parent: str, depth: int) -> None:
        if not isinstance(node, dict):
            return
        place = node.get("locationId") or node.get("docId") or node.get("docLevelId")
        if place:
            ident = f"{key}:{place}".lower()
            rows.append((ident, parent, depth, str(node.get("docType") or "other").lower(), node.get("title") or "", node.get("text") or ""))
            parent, depth = ident, depth + 1
        for child in ((node.get("documents") or {}).get("items")) or []:
            visit(child, parent, depth)

    visit(law.get("documents"), f"{key}:law", 1)
    return rows


def law_json(spark: SparkSession, path: str) -> DataFrame:
    reachable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path", "content")
    return files.mapInPandas(lambda b: _files(b, law_tree, ["id", "parent", "depth", "type", "label", "text"]), "path string, id string, parent string, depth int, type string, label string, text string")


def siblings(elements: DataFrame) -> DataFrame:
    """law_xml rows with the identifiers before and after them in their file."""
    w = Window.partitionBy("path").orderBy("n")
    return elements.withColumn("previous", F.lag("identifier").over(w)).withColumn("next", F.lead("identifier").over(w))
