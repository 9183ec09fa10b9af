"""Bound volumes: words, bylines, opinions, motion entries, marks in text and references to sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def small_caps(words: DataFrame, gap: float = 1.5, ratio: float = 0.85) -> DataFrame:
    """Words of a line whose large capital and small capitals were read apart are put together.

    words(volume, page_index, line_no, x0, x1, size, text): a word in capitals that is set at most ``ratio`` as large as
    the one before and stands within ``gap`` of it continues it.
    """
    w = Window.partitionBy("volume", "page_index", "line_no").orderBy("x0")
    caps = F.col("text").rlike(r"^[^a-z]*[A-Z][^a-z]*$")
    # a run of small capitals goes on at its own size
    first = F.lag("text").over(w).rlike(r"^[A-Z]$") & (F.col("size") <= F.lag("size").over(w) * ratio)
    near = F.col("x0") - F.lag("x1").over(w) <= gap
    joined = F.coalesce(caps & near & (first | ((F.col("size") == F.lag("size").over(w)) & F.lag("text").over(w).rlike("^[^a-z]+$"))), F.lit(False))
    rows = words.withColumn("_new", (~joined).cast("int")).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = rows.groupBy("volume", "page_index", "line_no", "_g").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("x0", "text"))).alias("p"))
    return g.select("volume", "page_index", "line_no", "x0", "x1", "size", F.array_join(F.transform("p", lambda x: x.text), "").alias("text"))


def opinion_kind(line: Column) -> Column:
    """concur, dissent, both or majority, from a byline or heading."""
    low = F.lower(line)
    c, d = low.rlike(r"\bconcur"), low.rlike(r"\bdissent")
    return F.when(c & d, "concurrence-dissent").when(c, "concurrence").when(d, "dissent").when(low.rlike(r"\bmemorandum\b"), "memorandum").when(low.rlike(r"\bper curiam\b"), "per-curiam").otherwise("majority")


def author_of(line: Column) -> Column:
    """The surname of a byline such as 'SMITH, J. (dissenting)' or 'Roe, Ch. J.'; Per Curiam as it is."""
    name = F.regexp_extract(line, r"^\s*([A-Z][A-Za-z'’\- ]*?),?\s+(?:Ch\.?\s*J|P\.?\s*J|J\.?\s*P|JJ?)\.", 1)
    return F.when(line.rlike(r"(?i)^\s*per curiam"), "Per Curiam").when(name != "", F.initcap(F.lower(name)))


BYLINE = r"^\s*(?:[A-Z][A-Za-z'’\- ]*?,?\s+(?:Ch\.?\s*J|P\.?\s*J|J\.?\s*P|JJ?)\.|(?i:per curiam|memorandum)\b)"


def opinions_of(lines: DataFrame, byline: str = BYLINE) -> DataFrame:
    """lines(case_id, n, text) -> (case_id, opinion_index, kind, author, text): an opinion begins at each byline.

    Lines before the first byline are no opinion's.
    """
    w = Window.partitionBy("case_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("o", F.sum(F.coalesce(F.col("text").rlike(byline), F.lit(False)).cast("int")).over(w)).where("o > 0")
    g = rows.groupBy("case_id", "o").agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("l"))
    head = F.col("l")[0]["text"]
    return g.select("case_id", (F.col("o") - 1).alias("opinion_index"), opinion_kind(head).alias("kind"), author_of(head).alias("author"), F.array_join(F.transform("l", lambda x: x.text), "\n").alias("text"))


DISPOSITION = r"(?i)\b(granted|denied|dismissed|withdrawn)\b[^.]*\.\s*$"


def motion_entries(lines: DataFrame, disposition: str = DISPOSITION) -> DataFrame:
    """lines(volume, page, n, text) of calendars -> (volume, entry, caption, below, disposition): an entry ends at its disposition."""
    w, keys = Window.partitionBy("volume").orderBy("page", "n"), ["volume"]
    ends = F.coalesce(F.lag(F.col("text").rlike(disposition)).over(w), F.lit(True)).cast("int")
    rows = lines.withColumn("e", ends).withColumn("entry", F.sum("e").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = rows.groupBy(*keys, "entry").agg(F.sort_array(F.collect_list(F.struct("page", "n", "text"))).alias("l"))
    text = F.array_join(F.transform("l", lambda x: F.trim(x.text)), " ")
    g = g.select(*keys, "entry", text.alias("t"))
    return g.select(
        *keys, "entry", F.trim(F.regexp_extract("t", r"^(.*?)(?:\.\s|\(|$)", 1)).alias("caption"), F.nullif(F.regexp_extract("t", r"\(([^)]*)\)", 1), F.lit("")).alias("below"),
        F.nullif(F.regexp_extract("t", r"(?i)((?:motion|application|appeal)[^.]*\b(?:granted|denied|dismissed|withdrawn)\b[^.]*\.)", 1), F.lit("")).alias("disposition"),
    )


MARK = r"⟦(fn|p):([^⟧]*)⟧"


def without_marks(text: Column, mark: str = MARK) -> Column:
    """struct(text, marks array<struct<offset, kind, label>>): the text without its marks, and where they stood in it."""
    pieces = F.split(text, mark)
    kinds, labels = (F.regexp_extract_all(text, F.lit(mark), F.lit(i)) for i in (1, 2))
    lengths = F.transform(pieces, lambda p: F.length(p))
    at = F.transform(kinds, lambda k, i: F.struct(F.aggregate(F.slice(lengths, 1, i + 1), F.lit(0), lambda a, x: a + x).alias("offset"), k.alias("kind"), F.get(labels, i).alias("label")))
    return F.when(text.isNotNull(), F.struct(F.array_join(pieces, "").alias("text"), at.alias("marks")))


def split_marker(marker: Column) -> Column:
    """The parts of a footnote mark: '1,2' and '[3]' and '* 4.' without brackets, dots and blanks."""
    parts = F.split(F.regexp_replace(marker, r"[\[\]().\s]", ""), "[,;]")
    return F.filter(parts, lambda p: p != "")


def spaced_name(name: Column) -> Column:
    """A squeezed caption with its spaces: 'SmithvJones&Co.' as 'Smith v Jones & Co.'."""
    n = F.regexp_replace(name, r"(?<=[a-z.])v\.?(?=[A-Z])", " v ")
    n = F.regexp_replace(n, r"\s*&\s*", " & ")
    n = F.regexp_replace(n, r"(?<=[a-z])(?=[A-Z])", " ")
    n = F.regexp_replace(n, r",(?=\S)", ", ")
    return F.trim(F.regexp_replace(n, r"\s+", " "))


def section_paths(ref: Column, title: Column) -> Column:
    """The paths of 'section 12(a)(1) of title 5' and 'sections 1, 2 and 3 of this title'; ``title`` is this one's number."""
    t = F.coalesce(F.nullif(F.regexp_extract(ref, r"(?i)of title ([0-9]+)", 1), F.lit("")), F.when(ref.rlike("(?i)of this title"), title.cast("string")))
    body = F.regexp_extract(ref, r"(?i)sections? (.*?)(?: of (?:this title|title [0-9]+)|$)", 1)
    items = F.filter(F.split(body, r"\s*(?:,|\band\b|\bor\b)\s*"), lambda s: s.rlike("^[0-9]"))
    path = lambda s: F.concat(F.lit("/us/usc/t"), t, F.lit("/s"), F.regexp_extract(s, "^([0-9A-Za-z-]+)", 1), F.array_join(F.transform(F.regexp_extract_all(s, F.lit(r"\(([0-9A-Za-z]+)\)"), F.lit(1)), lambda p: F.concat(F.lit("/"), p)), ""))
    return F.when(t.isNotNull(), F.transform(items, path))


def note_data(text: Column) -> Column:
    """struct(refs, enacted, amended, repealed, short_title) of a note's text."""
    law = lambda verb: F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?i){verb}[^.;]*?(Pub\. L\. [0-9]+[–-][0-9]+)"), F.lit(1)))
    return F.struct(
        F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)\b(sections? [0-9][^.;]*? of (?:this title|title [0-9]+))"), F.lit(1))).alias("refs"),
        law("enact").alias("enacted"), law("amend").alias("amended"), law("repeal").alias("repealed"),
        F.nullif(F.regexp_extract(text, r"(?i)may be cited as (?:the )?[‘’“”\"']+([^‘’“”\"']+)", 1), F.lit("")).alias("short_title"),
    )
