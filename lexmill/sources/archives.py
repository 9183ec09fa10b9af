"""Sources that are archives and files of records."""

from __future__ import annotations

import io
import json
import os
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import reachable

CASE = "id long, name string, name_abbreviation string, decision_date string, docket_number string, first_page string, last_page string, citations array<struct<type:string,cite:string>>, court struct<id:int,name:string>, jurisdiction struct<id:int,name_long:string>, casebody struct<data:struct<opinions:array<struct<type:string,author:string,text:string>>>>"


ENTRIES_AT_ONCE = 500


def _entries(batches: Iterator[pd.DataFrame], folder: str) -> Iterator[pd.DataFrame]:
    columns = ["path", "entry", "body", "fault"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            rows, fault = [], None
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in sorted(z.namelist()):
                        if name.startswith(folder) and name.endswith(".json"):
                            rows.append((path, name, z.read(name).decode("utf-8", "replace"), None))
                            if len(rows) == ENTRIES_AT_ONCE:
                                yield pd.DataFrame(rows, columns=columns)
                                rows = []
            except (zipfile.BadZipFile, OSError, EOFError, zlib.error) as e:
                fault = f"{type(e).__name__}: {e}"
            yield pd.DataFrame(rows + ([(path, None, None, fault)] if fault else []), columns=columns)


def archive_entries(files: DataFrame, folder: str = "json/") -> DataFrame:
    """files(path, content) -> (path, entry, body, fault) of the JSON entries under ``folder``; a bad archive is one fault.

    Entries go on in small frames, so that no more of an archive is unpacked at once.
    """
    return files.select("path", "content").mapInPandas(lambda b: _entries(b, folder), "path string, entry string, body string, fault string")


def zip_of_json(spark: SparkSession, path: str, folder: str = "json/") -> DataFrame:
    """(source, volume, entry, body) of the JSON entries under ``folder`` of each archive; a task reads whole archives."""
    reachable(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return archive_entries(files, folder).where("fault is null").select(F.regexp_extract("path", r"([^/]+)/[^/]+\.zip$", 1).alias("source"), F.regexp_extract("path", r"(\d+)\.zip$", 1).try_cast("int").alias("volume"), "entry", "body")


def case_fields(bodies: DataFrame, schema: str = CASE) -> DataFrame:
    """The fields of case documents, with empty arrays for missing ones; bodies that are no JSON are left out."""
    c = bodies.withColumn("c", F.from_json("body", schema)).where("c.id is not null")
    none = lambda kind: F.array().cast(kind)
    return c.select(
        "source", "volume", "c.id", "c.name", "c.name_abbreviation", "c.decision_date", "c.docket_number", "c.first_page", "c.last_page", F.col("c.court.name").alias("court_name"), F.col("c.jurisdiction.name_long").alias("jurisdiction"),
        F.coalesce("c.citations", none("array<struct<type:string,cite:string>>")).alias("citations"), F.coalesce("c.casebody.data.opinions", none("array<struct<type:string,author:string,text:string>>")).alias("opinions"),
    )


def flat_names(entries: DataFrame) -> DataFrame:
    """The base name of each entry; a name that came before gets _1, _2 ..."""
    base = F.regexp_extract("entry", r"([^/]+)$", 1)
    n = F.row_number().over(Window.partitionBy("path", "_b").orderBy("entry")) - 1
    rows = entries.withColumn("_b", base).withColumn("_n", n)
    stem, end = F.regexp_extract("_b", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("_b", r"^(.*?)(\.[^.]*)?$", 2)
    return rows.withColumn("name", F.when(F.col("_n") == 0, F.col("_b")).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), end))).drop("_b", "_n")


def _records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"], strict=True):
            text = bytes(content).decode("utf-8", "replace").lstrip("﻿ \t\r\n")
            if text[:1] == "[":
                try:
                    rows += [(path, i, json.dumps(x), None) for i, x in enumerate(json.loads(text))]
                except ValueError as e:
                    rows.append((path, 0, None, f"array: {e}"))
            else:
                for i, line in enumerate(text.splitlines()):
                    if line.strip():
                        try:
                            json.loads(line)
                            rows.append((path, i, line, None))
                        except ValueError as e:
                            rows.append((path, i, None, f"line: {e}"))
        yield pd.DataFrame(rows, columns=["path", "n", "record", "fault"])


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, n, record, fault) of files that are a JSON array or a record a line, told by their first character.

    A malformed line is one fault; a malformed array is one for the whole file.
    """
    reachable(spark)
    return file_records(spark.read.format("binaryFile").load(path))


def file_records(files: DataFrame) -> DataFrame:
    """``json_records`` of files(path, content)."""
    return files.select("path", "content").mapInPandas(_records, "path string, n long, record string, fault string")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, record, fault) of files with a record a line, which are read in parts, however large they are."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value")).where("trim(value) <> ''")
    good = F.try_parse_json("value").isNotNull()
    return lines.select("path", F.when(good, F.col("value")).alias("record"), F.when(~good, "line: malformed").alias("fault"))


def by_type(spark: SparkSession, path: str, schemas: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Records a line told apart by their ``type``, and what was skipped: (reason, n)."""
    lines = spark.read.text(path).where("trim(value) <> ''").withColumn("type", F.get_json_object("value", "$.type"))
    out = {t: lines.where(F.col("type") == t).select(F.from_json("value", s).alias("r")).select("r.*") for t, s in schemas.items()}
    known = F.coalesce(F.col("type").isin(*schemas), F.lit(False))
    bad = lines.where(~known).select(F.when(F.is_valid_utf8("value") & F.col("type").isNull() & F.try_parse_json("value").isNull(), "malformed").otherwise("unknown type").alias("reason"))
    return out, bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def updates_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file of updates with a header line."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def log_sections(spark: SparkSession, path: str, title: str, entry: str) -> DataFrame:
    """(path, line_no, section, line) of log lines like ``entry``, with the last ``title`` line's first group before them."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))
    head = F.when(F.col("line").rlike(title), F.regexp_extract("line", title, 1))
    w = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("section", F.last(head, ignorenulls=True).over(w)).where(F.col("line").rlike(entry))


def format_of(head: bytes | str, name: str = "") -> str:
    """pdf, html-modern, html-legacy or unknown, from the first bytes of a file."""
    raw = head.encode("utf-8", "replace") if isinstance(head, str) else head
    if raw[:4] == b"%PDF":
        return "pdf"
    text = raw[:16384].decode("utf-8", "replace")
    saved = text.partition("saved from url=(")[2].partition(")")[2][:300]
    if "/current/3dseries/" in saved:
        return "html-modern"
    if "/3dseries/" in saved:
        return "html-legacy"
    if 'class="case-info"' in text:
        return "html-modern"
    if any(f"bgcolor={q}#ffff80" in text.lower() for q in ('"', "")):
        return "html-legacy"
    return "pdf" if os.path.splitext(name)[1].lower() == ".pdf" else "unknown"
