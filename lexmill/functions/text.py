"""Scalar functions over columns: identifiers, citations, dates, courts, headings, chunks and quality of text.

All are built-in expressions, so they stay in generated code; a null argument gives null unless said otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# fixed values: the words left out before embedding
STOP_WORDS = (
    "the", "and", "of", "to", "in", "a", "for", "is", "on", "that", "by", "with", "as", "at", "from", "or", "an", "be", "this", "which", "are", "it", "was", "not", "have", "has",
    "but", "their", "they", "will", "can", "if", "all", "any", "such", "may", "shall",
)


# ---- identifiers


def slug(name: Column) -> Column:
    """Lower case, everything but a-z and 0-9 as single hyphens, none at the ends; '' for null."""
    return F.coalesce(F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(""))


def reporter_token(reporter: Column) -> Column:
    """For comparing reporters: no spaces and dots, upper case."""
    return F.upper(F.regexp_replace(F.coalesce(reporter, F.lit("")), r"[\s.]+", ""))


def reporter_part(reporter: Column) -> Column:
    """The reporter's part of an identifier: lower case, no spaces."""
    return F.regexp_replace(F.lower(reporter), r"\s+", "")


def case_curie(reporter: Column, volume: Column, page: Column, name: Column) -> Column:
    """reporter:volume:page[:name], null if one of the first three is missing."""
    base = F.concat_ws(":", reporter_part(reporter), volume.cast("string"), page.cast("string"))
    full = F.when(slug(name) == "", base).otherwise(F.concat_ws(":", base, slug(name)))
    missing = reporter.isNull() | (reporter == "") | volume.isNull() | page.isNull()
    return F.when(~missing, full)


def occurrence_suffix(base: Column, n: Column) -> Column:
    """The n-th of a base, the first without a suffix: base, base:02, base:03 ..."""
    return F.when(n <= 1, base).otherwise(F.concat(base, F.lit(":"), F.when(n < 10, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))))


def opinion_curie(case: Column, index: Column, kind: Column, author: Column) -> Column:
    """case#index-type[-surname]."""
    surname = slug(F.split(author, ",")[0])
    head = F.concat(case, F.lit("#"), index.cast("string"), F.lit("-"), F.when(slug(kind) == "", "opinion").otherwise(slug(kind)))
    return F.when(index >= 0, F.when(surname == "", head).otherwise(F.concat_ws("-", head, surname)))


def slip_curie(prefix: str, year: Column, number: Column, unreported: Column) -> Column:
    """prefix[u]:year:number without leading zeros, null for a number that is none."""
    digits = F.when(number.rlike("^[0-9]+$"), F.regexp_replace(number, "^0+(?=.)", ""))
    return F.concat(F.lit(prefix), F.when(unreported, "u").otherwise(""), F.lit(":"), year.cast("string"), F.lit(":"), digits)


def slip_cite(name: str, year: Column, number: Column, unreported: Column) -> Column:
    """year name 00000[(U)]."""
    padded = F.when(F.length(number) >= 5, number).otherwise(F.lpad(number, 5, "0"))
    return F.concat(year.cast("string"), F.lit(f" {name} "), padded, F.when(unreported, "(U)").otherwise(""))


# ---- citations


def volume_reporter_page(cite: Column, greedy: bool = False) -> Column:
    """struct(volume, reporter, page, tail) of a cite, null if it isn't one.

    Tolerant: spaces between the parts may be missing, the reporter ends at the next number. Greedy: they may not, and the
    reporter reaches to the last number, so that a series stays with it.
    """
    pattern = r"^([0-9]+)\s+(.+)\s+([0-9]+)(.*)$" if greedy else r"^([0-9]+)\s*([A-Za-z0-9.\s]+?)\s*([0-9]+)(.*)$"
    part = lambda i: F.regexp_extract(cite, pattern, i)
    reporter = F.trim(F.regexp_replace(part(2), r"\s+", " "))
    return F.when(
        cite.rlike(pattern),
        F.struct(part(1).try_cast("int").alias("volume"), reporter.alias("reporter"), part(3).try_cast("int").alias("page"), part(4).alias("tail")),
    )


def rebuilt_cite(parsed: Column, reporter: Column) -> Column:
    """The cite with another reporter."""
    return F.trim(F.concat(parsed["volume"].cast("string"), F.lit(" "), reporter, F.lit(" "), parsed["page"].cast("string"), parsed["tail"]))


def dotted_series(cite: Column) -> Column:
    """Compact series spelt with a space: 'App2d' and 'App. 2d' alike become 'App.2d'."""
    return F.regexp_replace(F.regexp_replace(cite, r"\.\s+([23]d)", ".$1"), r"([A-Za-z])([23]d)\b", "$1.$2")


# ---- dates


def iso_date(text: Column) -> Column:
    """'March 3, 1935' and '3 March 1935' as 1935-03-03, ISO dates (also partial ones) as they are, else null."""
    t = F.lower(F.trim(text))
    name = "|".join(MONTHS)
    us, eu = rf"^({name}) ([0-9]{{1,2}}), ?([0-9]{{4}})$", rf"^([0-9]{{1,2}}) ({name}),? ([0-9]{{4}})$"
    number = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m, f"{i:02d}")])

    def of(pattern: str, m: int, d: int) -> Column:
        return F.concat_ws("-", F.regexp_extract(t, pattern, 3), F.try_element_at(number, F.regexp_extract(t, pattern, m)), F.lpad(F.regexp_extract(t, pattern, d), 2, "0"))

    return F.when(t.rlike(r"^[0-9]{4}(-[0-9]{2}){0,2}$"), t).when(t.rlike(us), of(us, 1, 2)).when(t.rlike(eu), of(eu, 2, 1))


# ---- courts


# fixed values: the reporter and the source of a court's decisions, by its level
COURT_LEVELS = {"appeals": ("NY3d", "ny_supreme"), "division": ("AD3d", "ny_appellate"), "trial": ("Misc 3d", "ny_trial")}


def court_of(name: Column) -> Column:
    """struct(reporter, source_ref, department) of a court's name; nulls for no name.

    A department is told of the Appellate Division only: the Appellate Term has departments too, but is a trial court here.
    """
    n = F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))
    level = F.when(n.contains("court of appeals"), "appeals").when(n.contains("appellate division"), "division").when(n != "", "trial")
    reporter, source = (F.try_element_at(F.create_map(*[F.lit(x) for k, v in COURT_LEVELS.items() for x in (k, v[i])]), level) for i in (0, 1))
    word = F.regexp_extract(n, r"\b(first|second|third|fourth)\b\s*department", 1)
    department = F.when(level == "division", F.nullif(F.array_position(F.array(*map(F.lit, ("first", "second", "third", "fourth"))), word), F.lit(0)).cast("int"))
    return F.struct(reporter.alias("reporter"), source.alias("source_ref"), department.alias("department"))


def court_class(name: Column) -> Column:
    """The kind of court that a name describes."""
    n = F.lower(name)
    return (
        F.when(n.rlike("court of appeals"), "appeals").when(n.rlike("app(ellate)?\\.? div"), "appellate-division").when(n.rlike("app(ellate)?\\.? term"), "appellate-term").when(n.rlike("sup(reme|\\.)"), "supreme").when(n.rlike("surr"), "surrogate")
        .when(n.rlike("fam"), "family").when(n.rlike("city"), "city").when(n.rlike("county|co\\."), "county").when(n.isNotNull(), "other")
    )


# ---- headings and addresses


def split_heading(heading: Column) -> Column:
    """struct(number, label) of '§ 2. The title'."""
    pattern = r"^\s*(?:§+|Section|Sec\.?)\s*([0-9A-Za-z.\-]*[0-9A-Za-z])\.?\s*(.*)$"
    return F.when(heading.rlike(pattern), F.struct(F.regexp_extract(heading, pattern, 1).alias("number"), F.regexp_replace(F.regexp_extract(heading, pattern, 2), r"[\s.;,]+$", "").alias("label")))


def natural_key(text: Column, width: int = 6) -> Column:
    """``text`` with each run of digits padded to ``width``, so that it sorts by number."""
    parts = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]") & (F.length(p) < width), F.lpad(p, width, "0")).otherwise(p)), "")


# fixed values: the shapes of a rule's address, and what each becomes: the kind's prefix, and the groups joined after the title
ADDRESSES = (
    (r"^T([0-9]+)C[A-Za-z0-9.]+_(.+)$", "", "{2}"),
    (r"^T([0-9]+)App([A-Z]+)[_-](.+)$", "", "App{2}-{3}"),
    (r"^T([0-9]+)C[A-Za-z0-9.]+App([A-Z]+)$", "", "App{2}"),
    (r"^T([0-9]+)HC_(.+)$", "", "{2}"),
    (r"^T([0-9]+)-([a-z])C[A-Za-z0-9.]+_(.+)$", "", "letter{2}-{3}"),
    (r"^T([0-9]+)C([A-Za-z0-9.]+)-(.+)$", "", "{2}-{3}"),
    (r"^T([0-9]+)C([A-Za-z0-9.]+)$", "c:", "{2}"),
    (r"^T([0-9]+)App([A-Z]+)$", "c:", "App{2}"),
    (r"^T([0-9]+)$", "t:", ""),
)


def address_curie(address: Column, code: str = "rcny") -> Column:
    """The identifier of an address in a code of rules, by the first shape that fits; null if none does."""
    import re

    out = F.lit(None).cast("string")
    for pattern, kind, form in reversed(ADDRESSES):
        group = lambda i, p=pattern: F.regexp_extract(address, p, i)
        title = F.regexp_replace(group(1), "^0+(?=.)", "")
        pieces = [F.lit(f"{code}:{kind}"), title]
        # a lettered title is one with its letter
        if form and not form.startswith("letter"):
            pieces.append(F.lit("-"))
        for literal, number in re.findall(r"([^{]*)(?:\{(\d)\})?", form.removeprefix("letter")):
            if literal:
                pieces.append(F.lit(literal))
            if number:
                pieces.append(group(int(number)))
        out = F.when(address.rlike(pattern), F.concat(*pieces)).otherwise(out)
    return out


def ancestors(path: Column) -> Column:
    """Every ancestor of '/us/usc/t1/s2/a' from the second level on, itself last."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(4), F.greatest(F.size(parts), F.lit(4))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def level_of(path: Column) -> Column:
    """The kind of element that a path's last segment stands for."""
    last = F.element_at(F.split(path, "/"), -1)
    return F.when(last.rlike("^t[0-9]+$"), "title").when(last.rlike("^ch[0-9]+$"), "chapter").when(last.rlike("^s[0-9]+"), "section").when(last.rlike("^[a-z]$"), "subsection").otherwise("part")


# ---- text


def without_stop_words(text: Column) -> Column:
    words = F.array(*map(F.lit, STOP_WORDS))
    return F.array_join(F.filter(F.split(text, r"\s+"), lambda w: ~F.array_contains(words, F.lower(w))), " ")


def _windows(n: Column, size: int, stride: int) -> Column:
    """Starts 0, stride, ... up to the first window that reaches the end."""
    return F.sequence(F.lit(0), F.greatest(F.ceil((n - size) / stride), F.lit(0)).cast("int") * stride, F.lit(stride))


def word_chunks(text: Column, size: int = 512, stride: int = 256) -> Column:
    """Overlapping windows of words; the last one reaches the end."""
    words = F.split(text, r"\s+")
    return F.transform(_windows(F.size(words), size, stride), lambda i: F.array_join(F.slice(words, i + 1, size), " "))


def char_chunks(text: Column, size: int = 512, stride: int = 256) -> Column:
    """Overlapping windows of characters; none for empty text."""
    return F.when(F.length(text) > 0, F.transform(_windows(F.length(text), size, stride), lambda i: F.substring(text, i + 1, F.lit(size))))


def normal_text(text: Column) -> Column:
    """Words broken at line ends joined, line ends and runs of white space as one space; '' for null."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"-\s*\n\s*", "")
    return F.trim(F.regexp_replace(t, r"[ \t\r\n\f]+", " "))


# fixed values: the words that tell legal text, and the bounds of the other signs
LEGAL_WORDS = r"\b(court|judge|opinion|ruling|case|law|legal|statute|defendant|plaintiff|appeal|motion|judgment)\b"


def quality_flags(text: Column) -> dict[str, Column]:
    """Eight signs of readable text; word borders are those of ASCII words."""
    n = F.length(text)
    words = F.filter(F.split(text, r"[ \t\r\n\f]+"), lambda w: F.length(w) > 2)
    count = F.size(words)
    density = count / F.greatest(n, F.lit(1)) * 1000
    mean = F.aggregate(words, F.lit(0), lambda a, w: a + F.length(w)) / F.greatest(count, F.lit(1))
    return {
        "legal": F.lower(text).rlike(LEGAL_WORDS.replace(r"\b(", "(?<![a-z0-9_])(").replace(r")\b", ")(?![a-z0-9_])")),
        "substantial": F.size(F.filter(F.split(text, "[.!?]+"), lambda s: F.length(F.trim(s)) > 20)) >= 5,
        "structured": F.size(F.filter(F.split(text, "\n"), lambda s: F.length(F.trim(s)) > 10)) >= 3,
        "dense": (density > 3) & (density < 8),
        "even": (mean > 3) & (mean < 12),
        "worded": F.length(F.regexp_replace(text, "[^0-9]", "")) <= n * 0.3,
        "whole": F.size(F.regexp_extract_all(text, F.lit(r"((?<![A-Za-z0-9_])[a-zA-Z]{1,2}(?![A-Za-z0-9_]))"), 1)) <= count * 0.4,
        "varied": ~text.rlike(r"([a-zA-Z])\1{4,}"),
    }


def is_substantial(text: Column, whole: Column, least: int = 100, share: float = 0.3) -> Column:
    """Whether a text is long enough by itself and against the whole, white space not counting."""
    n, all_ = (F.length(F.regexp_replace(c, r"[ \t\r\n\f]+", "")) for c in (text, whole))
    return (n >= least) & (n / F.greatest(all_, F.lit(1)) >= share)


def token_estimate(text: Column) -> Column:
    return F.ceil(F.length(text) / 4)


def slice_or_null(text: Column, start: Column, end: Column) -> Column:
    """text[start:end), null if the bounds are not within the text or not in order."""
    return F.when((start >= 0) & (end > start) & (end <= F.length(text)), F.substring(text, start + 1, end - start))


def trigrams(text: Column) -> Column:
    """The distinct three-letter pieces of the words of a text, two blanks before each word and one after."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    of = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, of)))


def set_similarity(a: Column, b: Column) -> Column:
    """Shared over all of two sets; 0 for two empty ones, null if one is null."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(F.array_union(a, b))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(every > 0, shared / every).otherwise(0.0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
