"""Queries of time, votes, matching, statistics and payloads, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import citations, matching, temporal, voting
from ..operators.ids import first_by
from ..sources.archives import format_of
from ..sources.sinks import case_documents, markdown, valid_records
from ..sources.tables import table
from ..streaming import incremental
from .text_queries import _C, _cases

def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")


def versions(spark: SparkSession, d: str) -> DataFrame:
    v = temporal.version_intervals(_events(spark, d), ["user_id"], "ts", "event_id")
    mid = table(spark, d, "events").agg((F.max("ts") - F.expr("INTERVAL 10 DAYS")).alias("mid"))
    rows = v.join(F.broadcast(mid))  # one row
    return temporal.version_at(rows, ["user_id"], F.col("mid"), "ts", "valid_to", "event_id").select("user_id", "event_id", "ts", "valid_to")


def latest(spark: SparkSession, d: str) -> DataFrame:
    return first_by(_events(spark, d), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "value")


def asof(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    buys = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return temporal.asof_backward(buys, e.where("event_type = 'error'"), ["user_id"], "ts", "value").select("event_id", "user_id", F.col("last_value").alias("last_error"))


def roster_spans(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).select(F.col("id").alias("case_id"), "court_id", "court_department", F.substring("decision_date", 1, 4).try_cast("int").alias("year"))
    spans = c.where("court_department is not null and year is not null").groupBy("court_id", "court_department").agg(F.min("year").alias("start"), F.max("year").alias("end"))
    spans = spans.withColumn("entry", F.row_number().over(Window.partitionBy("court_id").orderBy("court_department"))).withColumnRenamed("court_department", "found")
    asked = c.where("court_id is not null").select("case_id", "court_id", "year")
    return temporal.interval_lookup(asked, spans, "court_id", "year", "found").select("case_id", "found")


def islands(spark: SparkSession, d: str) -> DataFrame:
    return temporal.runs(_events(spark, d), ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "run", "event_type", "first", "last", "n")


def banners(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).withColumn("state", F.when(F.col("event_type").isin("signup", "error"), F.col("event_type")))
    return temporal.carried(e, ["user_id"], ["ts", "event_id"], "state").select("event_id", "carried", "banner")


def ranges(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).select("id", F.regexp_extract("file_name", "^(.*)\\.zip", 1).alias("volume"), F.col("first_page").try_cast("int").alias("start"), F.col("last_page").try_cast("int").alias("last"))
    c = c.where("start is not null and volume is not null")
    cap = c.groupBy("volume").agg(F.max(F.coalesce("last", "start")).alias("cap"))
    starts = c.groupBy("volume", "start").agg(F.count(F.lit(1)).alias("n"))
    return temporal.boundaries(starts.join(cap, "volume"), ["volume"], "start", "cap").select("volume", "start", "end", "n")


def positions(spark: SparkSession, d: str) -> DataFrame:
    """A file name by page and place on it: 0904-02."""
    c = _cases(spark, d).where("first_page is not null").select("id", "first_page", F.regexp_extract("file_name", "^(.*)\\.zip", 1).alias("volume"))
    n = F.row_number().over(Window.partitionBy("volume", "first_page").orderBy("id"))
    pad = lambda c, k: F.when(F.length(c) < k, F.lpad(c, k, "0")).otherwise(c)
    return c.select("id", F.concat(pad(F.col("first_page"), 4), F.lit("-"), pad(n.cast("string"), 2)).alias("name"))


def adjacent(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that say the same as the one before or after them in their element."""
    u = table(spark, d, "usc_chunks").select("id", "element_id", "chunk_index", "content_type", F.lower(F.trim(F.regexp_replace("original_text", r"\s+", " "))).alias("t"))
    w = Window.partitionBy("element_id", "content_type").orderBy("chunk_index", "id")
    same = F.coalesce((F.col("t") == F.lag("t").over(w)) | (F.col("t") == F.lead("t").over(w)), F.lit(False))
    return u.withColumn("same", same).where("same").select("id", "element_id", "content_type")


def seen_before(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "usc_chunks").select("id", "element_id", "content_type", "original_text")
    n = F.row_number().over(Window.partitionBy("element_id", "content_type", "original_text").orderBy("id"))
    return u.withColumn("n", n).select("id", F.when(F.col("n") == 1, F.col("element_id")).otherwise(F.concat("element_id", F.lit("#dup"), (F.col("n") - 1).cast("string"))).alias("unique_id"))


def pages_kept(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "stage_opinions").where("page_breaks is not null").select("curie", "page_breaks").distinct()
    marks = F.transform(F.from_json("page_breaks", "array<struct<offset:bigint>>"), lambda x: x.offset)
    return o.select("curie", F.size(temporal.spaced(F.filter(marks, lambda x: x.isNotNull()), 1200)).alias("n_kept"), F.size(marks).alias("n_all"))


def voters(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "opinions").where("author is not null").select("id", "case_id", F.lower(F.regexp_replace(F.split("author", ",")[0], "[^A-Za-z ]", "")).alias("surname")).distinct()
    c = _cases(spark, d).select(F.col("id").alias("case_id"), F.col("court_department").alias("department"))
    return o.join(c, "case_id").select("id", "case_id", "surname", "department")


def department_resolution(spark: SparkSession, d: str) -> DataFrame:
    v = voters(spark, d)
    vote = voting.panel_vote(v, "case_id", "surname", voting.roster(v, "surname", "department"), "department").select("case_id", F.col("department").alias("panel"))
    by_court = voting.roster(_cases(spark, d), "court_id", "court_department").where("n >= 3 and confidence >= 0.8").select("court_id", F.col("court_department").alias("court"))
    c = _cases(spark, d).select(F.col("id").alias("case_id"), "court_id", F.col("court_department").alias("prior")).join(vote, "case_id", "left").join(by_court, "court_id", "left")
    return voting.resolution(c, "court", "panel", "prior").select("case_id", "resolved", "resolved_by", "grade")


def _entries(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = _cases(spark, d).where("court_id is not null and decision_date is not null")
    cites = table(spark, d, "case_citations").groupBy(F.col("case_id").alias("id")).agg(F.countDistinct("id").alias("n_cites"))
    day = F.substring("decision_date", 1, 4).alias("day")
    cases = c.join(cites, "id", "left").select(F.col("id").alias("case_id"), "name", F.col("name_abbreviation").alias("abbreviation"), F.coalesce("n_cites", F.lit(0)).alias("n_cites"), "court_id", day)
    entries = c.select(F.col("id").alias("entry"), F.regexp_replace("name_abbreviation", "(?i) v ", " against ").alias("name"), "court_id", day)
    return entries, cases


def matched(spark: SparkSession, d: str) -> DataFrame:
    e, c = _entries(spark, d)
    return matching.candidates(e, c, ["court_id", "day"]).select("entry", "place", "case_id", F.round("best_score", 6).alias("best_score"))


def decided(spark: SparkSession, d: str) -> DataFrame:
    e, c = _entries(spark, d)
    return matching.decide(e, matching.candidates(e, c, ["court_id", "day"]))


def batch_stats(spark: SparkSession, d: str) -> DataFrame:
    """An order as a batch job, its lines as requests."""
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("failed"), F.count_if(F.col("l_linestatus") == "F").alias("done"), F.round(F.sum("l_extendedprice"), 2).alias("cost")
    )
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return j.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_jobs"), F.sum("n").alias("n_requests"), F.sum("failed").alias("n_failed"), F.round(F.sum("done") * 100.0 / F.sum("n"), 2).alias("done_pct"), F.round(F.sum("cost"), 0).alias("cost"))


def errors(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d).where("event_type = 'error'").withColumn("k", F.get_json_object("props", "$.k"))
    place = F.row_number().over(Window.partitionBy("k").orderBy("event_id"))
    first = e.withColumn("place", place).where("place <= 5").groupBy("k").agg(F.array_join(F.sort_array(F.collect_list("event_id")), ",").alias("first_ids"))
    return e.groupBy("k").agg(F.count(F.lit(1)).alias("n")).join(first, "k")


def tiers(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("relevance_score")
    tier = F.when(s.isNull(), "none").when(s >= 0.8, "high").when(s >= 0.5, "medium").otherwise("low")
    g = table(spark, d, "opinion_keywords").groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 1))


def recent(spark: SparkSession, d: str) -> DataFrame:
    e = _events(spark, d)
    last = e.agg(F.max("ts").alias("now"))
    return e.join(F.broadcast(last)).where(F.col("ts") >= F.col("now") - F.expr("INTERVAL 24 HOURS")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users"))  # one row


def skew(spark: SparkSession, d: str) -> DataFrame:
    """Courts whose cases are nearly all of one department."""
    g = _cases(spark, d).where("court_id is not null").groupBy("court_id", "court_department").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("court_id")
    rows = g.withColumn("n", F.sum("c").over(w)).withColumn("share", F.col("c") / F.col("n"))
    return rows.where("n >= 40 and share > 0.6").select("court_id", "court_department", "n", F.round("share", 6).alias("share"))


def queue(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "opinion_keywords").select(F.col("opinion_curie").alias("curie")).distinct()
    todo = table(spark, d, "opinions").where("not coalesce(is_valueless, false) and curie is not null").select("id", "curie").distinct().join(done, "curie", "left_anti")
    return todo.select("id", "curie")


def manifest(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each source's identifiers: of the digests of its parts, so that no source is gathered in one place."""
    o = table(spark, d, "opinions").where("curie is not null").select("source_ref", "curie").distinct().withColumn("part", F.substring(F.md5("curie"), 1, 3))
    parts = o.groupBy("source_ref", "part").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("curie")), "\n"), 256).alias("p"))
    whole = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "p"))), lambda x: x.p), "\n"), 256)
    return parts.groupBy("source_ref").agg(F.sum("n").alias("n"), whole.alias("digest"))


def plain_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The digest of each source's distinct identifiers in order, a line each; a source's identifiers are put in one string."""
    o = table(spark, d, "opinions").where("curie is not null").select("source_ref", "curie").distinct()
    return o.groupBy("source_ref").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("curie")), "\n"), 256).alias("digest"))


def freshness(spark: SparkSession, d: str) -> DataFrame:
    """Staged texts against those at hand: new, fresh or stale by digest."""
    a = table(spark, d, "stage_opinions").where("curie is not null").groupBy("curie").agg(F.min(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("a"))
    b = table(spark, d, "opinions").where("curie is not null").groupBy("curie").agg(F.min(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("b"))
    state = F.when(F.col("b").isNull(), "new").when(F.col("a") == F.col("b"), "fresh").otherwise("stale")
    return a.join(b, "curie", "left").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def payloads(spark: SparkSession, d: str) -> DataFrame:
    """Short model answers made from assignments: {"dc": [{"t": text, "r": score}], "nt": [...]}."""
    k = table(spark, d, "opinion_keywords").where("opinion_curie is not null").select("opinion_curie", "keyword_id", "relevance_score", "category").distinct()
    item = lambda c: F.array_sort(F.collect_list(F.when(F.col("category") == c, F.struct(F.col("keyword_id").alias("t"), F.col("relevance_score").alias("r")))))
    return k.groupBy("opinion_curie").agg(F.to_json(F.struct(item("doctrine").alias("dc"), item("field_of_law").alias("f"))).alias("payload"))


SHORT = "struct<dc:array<struct<t:int,r:double>>,f:array<struct<t:int,r:double>>>"


def expanded(spark: SparkSession, d: str) -> DataFrame:
    """The answers with long names, one row an item."""
    p = payloads(spark, d).withColumn("x", F.from_json("payload", SHORT))

    def named(short: str, name: str):
        return F.transform(f"x.{short}", lambda i: F.struct(F.lit(name).alias("category"), i.t.alias("keyword_id"), i.r.alias("relevance")))

    long = F.concat(named("dc", "doctrine"), named("f", "field_of_law"))
    return p.select("opinion_curie", F.explode(long).alias("i")).select("opinion_curie", "i.*")


def validated(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with each answer; an answer without fault has none."""
    x = payloads(spark, d).withColumn("x", F.from_json("payload", SHORT))
    items = F.concat("x.dc", "x.f")
    rules = {"no_doctrine": F.size("x.dc") == 0, "no_field": F.size("x.f") == 0, "score_missing": F.exists(items, lambda i: i.r.isNull()), "score_range": F.exists(items, lambda i: F.coalesce((i.r < 0) | (i.r > 1), F.lit(False)))}
    faults = F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in rules.items())), lambda f: f.isNotNull())
    return x.groupBy(F.array_join(faults, ",").alias("faults")).agg(F.count(F.lit(1)).alias("n"))


def cosine_top(spark: SparkSession, d: str) -> DataFrame:
    """The vectors most like the first one, by cosine."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    q = e.orderBy("vec_id").limit(1).select(F.col("embedding").alias("q"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)
    cos = dot("embedding", "q") / F.sqrt(dot("embedding", "embedding") * dot("q", "q"))
    return e.join(F.broadcast(q)).select("vec_id", "label", F.round(cos, 6).alias("cosine")).orderBy(F.desc("cosine"), "vec_id").limit(10)  # one row


def citation_stats(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "case_citations").select("id", "case_id", "category", F.explode_outer("cited_case_ids").alias("cited")).distinct()
    return c.groupBy(F.coalesce("category", F.lit("none")).alias("category")).agg(F.countDistinct("id").alias("n"), F.countDistinct("cited").alias("n_cited"), F.countDistinct("case_id").alias("n_citing"), F.count_if(F.col("cited").isNull()).alias("n_unresolved"))


def citing_counts(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "case_citations").select("case_id", F.explode("cited_case_ids").alias("cited")).where("cited is not null")
    return c.groupBy("cited").agg(F.countDistinct("case_id").alias("n_citing"))


def storage(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "source_keywords").where("keyword_text is not null")
    a = u.agg(F.lit("repeated").alias("way"), F.sum(F.length("keyword_text")).alias("chars"))
    b = u.select("keyword_text").distinct().agg(F.lit("normalised").alias("way"), F.sum(F.length("keyword_text")).alias("chars"))
    return a.unionByName(b)


def decades(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).select((F.floor(F.substring("decision_date", 1, 4).try_cast("int") / 10) * 10).alias("decade"))
    return c.groupBy("decade").agg(F.count(F.lit(1)).alias("n")).where("n >= 3")


def sample(spark: SparkSession, d: str) -> DataFrame:
    """A repeatable random sample of 20 opinions."""
    o = table(spark, d, "opinions").where("id is not null").select("id").distinct()
    return o.orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit("seed"))), "id").limit(20)


def pricing_summary(spark: SparkSession, d: str) -> DataFrame:
    """The aggregate of the public pricing summary query over the line items."""
    li = table(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz'1998-09-02 00:00:00'")
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(net), 0).alias("sum_net"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


def cited_places(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "opinions").where("text is not null").groupBy("id").agg(F.min("text").alias("text"))
    return citations.case_citations(o, table(spark, d, "reporters")).select("id", "norm", "volume", "page")


def cited_names(spark: SparkSession, d: str) -> DataFrame:
    """The named citations of all opinions and documents: a case's name before its place."""
    texts = None
    for name, key in (("opinions", "id"), ("documents", "doc_id")):
        t = table(spark, d, name).where("text is not null").groupBy(F.concat(F.lit(f"{name}:"), F.col(key).cast("string")).alias("id")).agg(F.min("text").alias("text"))
        texts = t if texts is None else texts.unionByName(t)
    return citations.case_citations(texts, table(spark, d, "reporters")).select("id", "norm", "volume", "page", "raw", "case_name")


LAW = "CASE id % 4 WHEN 0 THEN 'under ' || (id % 50) || ' U.S.C. § ' || id || ' and more' WHEN 1 THEN 'see 29 C.F.R. § 1910.' || id WHEN 2 THEN (id % 60) || ' RCNY § 4-0' || (id % 9) || ' applies' ELSE 'CA Code § ' || id END"


def laws(spark: SparkSession, d: str) -> DataFrame:
    c = _cases(spark, d).select("id", F.expr(LAW).alias("text"))
    return citations.law_citations(c).groupBy("kind", F.split("curie", ":")[0].alias("code")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("curie").alias("n_places"))


def stream_counts(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "events")
    live = spark.readStream.schema("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").option("pathGlobFilter", "events.parquet").parquet(d)
    return incremental.drained(spark, incremental.windowed_counts(live, "ts", ["event_type"], "6 hours"), "counts")


def documents_json(spark: SparkSession, d: str) -> DataFrame:
    cases = _cases(spark, d).select("id", "name", "curie")
    cites = table(spark, d, "case_citations").select("case_id", F.col("cited_case").alias("cite"), F.col("category").alias("citation_type")).where("cite is not null")
    o = table(spark, d, "opinions").select("case_id", "opinion_index", "opinion_type", "author", "text").distinct()
    doc = case_documents(cases, cites, o)
    kind = "struct<name:string,curie:string,citations:array<struct<cite:string,citation_type:string>>,opinions:array<struct<opinion_index:int,opinion_type:string,author:string,text:string>>>"
    x = doc.select("id", F.from_json("document", kind).alias("x"))
    cites = F.array_join(F.transform("x.citations", lambda c: F.concat(c.cite, F.lit("|"), F.coalesce(c.citation_type, F.lit("")))), ";")
    said = F.array_join(F.transform("x.opinions", lambda o: F.concat_ws("|", F.coalesce(o.opinion_index.cast("string"), F.lit("")), F.coalesce(o.opinion_type, F.lit("")), F.coalesce(o.author, F.lit("")), F.md5(F.coalesce(o.text, F.lit(""))))), ";")
    return x.select("id", "x.name", "x.curie", F.size("x.opinions").alias("n_opinions"), F.coalesce(cites, F.lit("")).alias("cites"), F.coalesce(said, F.lit("")).alias("opinions"))


def record_rules(spark: SparkSession, d: str) -> DataFrame:
    good, lacks = valid_records(table(spark, d, "usc_chunks"), ["element_id", "heading", "original_text"])
    return lacks.join(F.broadcast(good.agg(F.count(F.lit(1)).alias("n_valid"))))  # one row each


def rendered(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "usc_chunks").where("element_id is not null").select("id", "element_id", "content_type", F.coalesce("heading", F.lit("-")).alias("h"), "original_text").distinct()
    title = F.regexp_extract("element_id", "/(t[0-9]+)", 1)
    md = markdown(u.withColumn("t", title), "t", ["element_id", "id"], F.size(F.split("element_id", "/")) - 3, F.col("h"), F.when(F.col("content_type") == "body", F.col("original_text")))
    return md.select("t", F.length("text").alias("n"), F.md5("text").alias("digest"))


def formats(spark: SparkSession, d: str) -> DataFrame:
    """What the heads of files tell of their format."""
    c = _cases(spark, d).select("id", F.expr("CASE id % 4 WHEN 0 THEN '%PDF-1.7' WHEN 1 THEN '<div class=\"case-info\">' WHEN 2 THEN '<TABLE bgcolor=\"#FFFF80\">' ELSE 'text' END").alias("head"))
    kind = F.pandas_udf(lambda heads: heads.map(format_of), "string")
    return c.select(kind("head").alias("format")).groupBy("format").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "citation_extract": cited_places, "citation_case_names": cited_names, "statute_citation_stats": laws, "stream_window_counts": stream_counts, "case_json_documents": documents_json, "record_validity": record_rules, "markdown_sections": rendered, "format_detect": formats,
    "current_version_asof": versions, "latest_text_version": latest, "asof_last_banner": asof, "interval_roster_lookup": roster_spans, "range_islands": islands, "section_carry_forward": banners,
    "boundary_ranges": ranges, "page_position_name": positions, "adjacent_duplicates": adjacent, "duplicate_identifier_check": seen_before, "marker_spacing": pages_kept,
    "roster_majority_vote": lambda spark, d: voting.roster(voters(spark, d), "surname", "department").withColumn("confidence", F.round("confidence", 6)),
    "panel_vote_department": lambda spark, d: voting.panel_vote((v := voters(spark, d)), "case_id", "surname", voting.roster(v, "surname", "department"), "department"),
    "department_resolution": department_resolution, "trigram_topk_match": matched, "index_resolution_decide": decided, "batch_stats": batch_stats, "batch_error_breakdown": errors,
    "quality_tier_distribution": tiers, "recent_activity_24h": recent, "department_skew_tripwire": skew, "resume_queue_antijoin": queue, "compile_hash_manifest": manifest, "compile_plain_manifest": plain_manifest, "freshness_state": freshness,
    "payload_expand": expanded, "payload_validate": validated, "vector_topk_cosine": cosine_top, "citation_stats": citation_stats, "citing_case_counts": citing_counts, "storage_efficiency": storage,
    "decade_tally": decades, "repeatable_sample": sample, "pricing_summary": pricing_summary,
}

_V = f"""c AS ({_C}),
v AS (SELECT DISTINCT o.id, o.case_id, lower(regexp_replace(split_part(author, ',', 1), '[^A-Za-z ]', '', 'g')) AS surname, c.court_department AS department FROM opinions o JOIN c ON c.id = o.case_id WHERE author IS NOT NULL),
rc AS (SELECT surname, department, count(*) AS k FROM v WHERE department IS NOT NULL GROUP BY ALL),
r AS (SELECT surname, department, k, sum(k) OVER (PARTITION BY surname) AS n, row_number() OVER (PARTITION BY surname ORDER BY k DESC, department) AS rn FROM rc),
roster AS (SELECT surname, department, CAST(n AS BIGINT) AS n, k / n AS confidence FROM r WHERE rn = 1),
pc AS (SELECT case_id, r.department, count(*) AS k FROM (SELECT DISTINCT case_id, surname FROM v) p JOIN roster r USING (surname) WHERE n >= 3 AND confidence >= 0.8 GROUP BY ALL),
pr AS (SELECT *, sum(k) OVER (PARTITION BY case_id) AS used, row_number() OVER (PARTITION BY case_id ORDER BY k DESC, department) AS rn FROM pc),
panel AS (SELECT case_id, department, CAST(used AS BIGINT) AS used, k = used AS agree FROM pr WHERE rn = 1)"""
_TRI = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
_SIM = "coalesce(len(list_intersect({0}, {1})) / nullif(len(list_distinct(list_concat({0}, {1}))), 0), 0.0)"
_MATCH = f"""c AS (SELECT * FROM ({_C}) WHERE court_id IS NOT NULL AND decision_date IS NOT NULL),
k AS (SELECT case_id, count(DISTINCT id) AS n FROM case_citations GROUP BY case_id),
e AS (SELECT id AS entry, court_id, substr(decision_date, 1, 4) AS day, {_TRI.format("regexp_replace(name_abbreviation, '(?i) v ', ' against ', 'g')")} AS x FROM c),
t AS (SELECT c.id AS case_id, court_id, substr(decision_date, 1, 4) AS day, coalesce(k.n, 0) AS n_cites, {_TRI.format('name')} AS y, {_TRI.format('name_abbreviation')} AS z FROM c LEFT JOIN k ON k.case_id = c.id),
s AS (SELECT entry, case_id, n_cites, {_SIM.format('x', 'y')} AS name_score, {_SIM.format('x', 'z')} AS abbr_score FROM e JOIN t USING (court_id, day)),
b AS (SELECT *, greatest(name_score, abbr_score) AS best_score FROM s),
f AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY best_score DESC, name_score DESC, case_id) AS place FROM b QUALIFY place <= 10)"""
_PAY = """p AS (SELECT DISTINCT opinion_curie, keyword_id, relevance_score, category FROM opinion_keywords WHERE opinion_curie IS NOT NULL)"""

SQL = {
    "statute_citation_stats": f"""WITH c AS (SELECT id FROM ({_C})) SELECT CASE id % 4 WHEN 0 THEN 'statute' WHEN 3 THEN 'statute' ELSE 'rules' END AS kind, CASE id % 4 WHEN 0 THEN 'usc' WHEN 1 THEN 'cfr' WHEN 2 THEN 'rcny' ELSE 'ca' END AS code, count(*) AS n,
  count(DISTINCT CASE id % 4 WHEN 0 THEN (id % 50) || '-' || id WHEN 2 THEN (id % 60) || '-' || (id % 9) ELSE id::VARCHAR END) AS n_places FROM c GROUP BY 1, 2""",
    "citation_extract": r"""WITH f AS (SELECT DISTINCT f, norm FROM (SELECT unnest(list_distinct(list_concat([canonical], coalesce(aliases, [])))) AS f, norm FROM reporters)),
p AS (SELECT '\b([0-9]{1,4})\s+(' || string_agg(regexp_replace(replace(f, '.', '\.?'), '\s+', '\\s*', 'g'), '|' ORDER BY length(f) DESC, f) || ')\s+([0-9]{1,5})\b' AS p FROM f),
n AS (SELECT upper(regexp_replace(f, '[\s.]+', '', 'g')) AS token, min(norm) AS norm FROM f GROUP BY 1),
o AS (SELECT id, trim(regexp_replace(regexp_replace(min(text), '-\s*\n\s*', '', 'g'), '[ \t\r\n\f]+', ' ', 'g')) AS t FROM opinions WHERE text IS NOT NULL GROUP BY id),
r AS (SELECT id, unnest(regexp_extract_all(t, p)) AS raw FROM o, p),
g AS (SELECT id, regexp_extract(raw, '^([0-9]+)', 1)::INT AS volume, regexp_extract(raw, '([0-9]+)$', 1)::INT AS page, upper(regexp_replace(regexp_extract(raw, '^[0-9]+\s+(.*)\s+[0-9]+$', 1), '[\s.]+', '', 'g')) AS token FROM r)
SELECT DISTINCT id, n.norm, volume, page FROM g JOIN n USING (token) WHERE volume > 0 AND page > 0""",
    "citation_case_names": r"""WITH f AS (SELECT DISTINCT f, norm FROM (SELECT unnest(list_distinct(list_concat([canonical], coalesce(aliases, [])))) AS f, norm FROM reporters)),
p AS (SELECT '\b([0-9]{1,4})\s+(' || string_agg(regexp_replace(replace(f, '.', '\.?'), '\s+', '\\s*', 'g'), '|' ORDER BY length(f) DESC, f) || ')\s+([0-9]{1,5})\b' AS p FROM f),
n AS (SELECT upper(regexp_replace(f, '[\s.]+', '', 'g')) AS token, min(norm) AS norm FROM f GROUP BY 1),
s AS (SELECT 'opinions:' || id AS id, min(text) AS text FROM opinions WHERE text IS NOT NULL GROUP BY id UNION ALL SELECT 'documents:' || doc_id, min(text) FROM documents WHERE text IS NOT NULL GROUP BY doc_id),
o AS (SELECT id, trim(regexp_replace(regexp_replace(text, '-\s*\n\s*', '', 'g'), '[ \t\r\n\f]+', ' ', 'g')) AS t FROM s),
h AS (SELECT id, regexp_extract_all(t, p) AS h, string_split_regex(t, p) AS b FROM o, p),
r AS (SELECT id, unnest(h) AS raw, unnest(b[1:len(h)]) AS b, unnest(range(len(h))) AS i FROM h),
g AS (SELECT id, i, raw, nullif(trim(regexp_extract(b, '([A-Z][^,\n]{3,}? v\.? [^,\n]{2,}?)\s*[,;:]\s*$', 1)), '') AS case_name, regexp_extract(raw, '^([0-9]+)', 1)::INT AS volume, regexp_extract(raw, '([0-9]+)$', 1)::INT AS page,
  upper(regexp_replace(regexp_extract(raw, '^[0-9]+\s+(.*)\s+[0-9]+$', 1), '[\s.]+', '', 'g')) AS token FROM r)
SELECT id, n.norm, volume, page, raw, case_name FROM g JOIN n USING (token) WHERE volume > 0 AND page > 0 QUALIFY row_number() OVER (PARTITION BY id, n.norm, volume, page ORDER BY i) = 1""",
    "stream_window_counts": "SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "case_json_documents": f"""WITH c AS ({_C}), o AS (SELECT case_id, count(*) AS n, string_agg(coalesce(opinion_index::VARCHAR, '') || '|' || coalesce(opinion_type, '') || '|' || coalesce(author, '') || '|' || md5(coalesce(text, '')), ';'
    ORDER BY opinion_index NULLS FIRST, opinion_type NULLS FIRST, author NULLS FIRST, text NULLS FIRST) AS opinions FROM (SELECT DISTINCT case_id, opinion_index, opinion_type, author, text FROM opinions) GROUP BY 1),
k AS (SELECT case_id, string_agg(cite || '|' || coalesce(category, ''), ';' ORDER BY cite, category NULLS FIRST) AS cites FROM (SELECT DISTINCT case_id, cited_case AS cite, category FROM case_citations WHERE cited_case IS NOT NULL) GROUP BY 1)
SELECT c.id, name, curie, o.n AS n_opinions, coalesce(k.cites, '') AS cites, coalesce(o.opinions, '') AS opinions FROM c LEFT JOIN o ON o.case_id = c.id LEFT JOIN k ON k.case_id = c.id""",
    "record_validity": """SELECT count(*) FILTER (WHERE coalesce(trim(element_id), '') = '') AS lacks_element_id, count(*) FILTER (WHERE coalesce(trim(heading), '') = '') AS lacks_heading, count(*) FILTER (WHERE coalesce(trim(original_text), '') = '') AS lacks_original_text,
  count(*) FILTER (WHERE coalesce(trim(element_id), '') <> '' AND coalesce(trim(heading), '') <> '' AND coalesce(trim(original_text), '') <> '') AS n_valid FROM usc_chunks""",
    "markdown_sections": """WITH u AS (SELECT DISTINCT id, element_id, content_type, coalesce(heading, '-') AS h, original_text FROM usc_chunks WHERE element_id IS NOT NULL),
p AS (SELECT regexp_extract(element_id, '/(t[0-9]+)', 1) AS t, element_id, id, repeat('#', CAST(least(greatest(len(string_split(element_id, '/')) - 3, 1), 6) AS INT)) || ' ' || h || CASE WHEN content_type = 'body' AND coalesce(original_text, '') <> '' THEN chr(10) || chr(10) || original_text ELSE '' END AS piece FROM u),
m AS (SELECT t, string_agg(piece, chr(10) || chr(10) ORDER BY element_id, id) AS text FROM p GROUP BY t) SELECT t, length(text) AS n, md5(text) AS digest FROM m""",
    "format_detect": f"SELECT CASE id % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'html-modern' WHEN 2 THEN 'html-legacy' ELSE 'unknown' END AS format, count(*) AS n FROM ({_C}) GROUP BY 1",
    "current_version_asof": """WITH v AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events), m AS (SELECT max(ts) - INTERVAL 10 DAYS AS mid FROM events)
SELECT user_id, event_id, ts, valid_to FROM v, m WHERE ts <= mid AND (valid_to IS NULL OR valid_to > mid) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_text_version": "SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "asof_last_banner": """WITH u AS (SELECT event_id, user_id, ts, 1 AS side, NULL::DOUBLE AS v FROM events WHERE event_type = 'purchase' UNION ALL SELECT event_id, user_id, ts, 0, value FROM events WHERE event_type = 'error')
SELECT event_id, user_id, last_error FROM (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side ROWS UNBOUNDED PRECEDING) AS last_error FROM u) WHERE side = 1""",
    "interval_roster_lookup": f"""WITH c AS (SELECT id AS case_id, court_id, court_department AS dep, try_cast(substr(decision_date, 1, 4) AS INT) AS year FROM ({_C})),
s AS (SELECT court_id, dep, min(year) AS a, max(year) AS b FROM c WHERE dep IS NOT NULL AND year IS NOT NULL GROUP BY court_id, dep)
SELECT case_id, min(s.dep) AS found FROM c LEFT JOIN s ON s.court_id = c.court_id AND c.year BETWEEN a AND b WHERE c.court_id IS NOT NULL GROUP BY case_id""",
    "range_islands": """WITH e AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM e)
SELECT user_id, run, any_value(event_type) AS event_type, min(ts) AS first, max(ts) AS last, count(*) AS n FROM r GROUP BY user_id, run""",
    "section_carry_forward": """WITH e AS (SELECT *, last_value(CASE WHEN event_type IN ('signup', 'error') THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS carried FROM events)
SELECT event_id, carried, carried IS NOT NULL AND carried IS DISTINCT FROM lag(carried) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS banner FROM e""",
    "boundary_ranges": f"""WITH c AS (SELECT regexp_extract(file_name, '^(.*)\\.zip', 1) AS volume, try_cast(first_page AS INT) AS start, try_cast(last_page AS INT) AS last FROM ({_C})),
d AS (SELECT * FROM c WHERE start IS NOT NULL AND volume IS NOT NULL), m AS (SELECT volume, max(coalesce(last, start)) AS cap FROM d GROUP BY volume), s AS (SELECT volume, start, count(*) AS n FROM d GROUP BY ALL)
SELECT volume, start, greatest(least(coalesce(lead(start) OVER (PARTITION BY volume ORDER BY start) - 1, cap), cap), start) AS "end", n FROM s JOIN m USING (volume)""",
    "page_position_name": f"""WITH c AS (SELECT id, first_page AS p, row_number() OVER (PARTITION BY regexp_extract(file_name, '^(.*)\\.zip', 1), first_page ORDER BY id)::VARCHAR AS n FROM ({_C}) WHERE first_page IS NOT NULL)
SELECT id, CASE WHEN length(p) < 4 THEN lpad(p, 4, '0') ELSE p END || '-' || CASE WHEN length(n) < 2 THEN lpad(n, 2, '0') ELSE n END AS name FROM c""",
    "adjacent_duplicates": """WITH u AS (SELECT *, lower(trim(regexp_replace(original_text, '\\s+', ' ', 'g'))) AS t FROM usc_chunks),
l AS (SELECT *, lag(t) OVER w AS a, lead(t) OVER w AS b FROM u WINDOW w AS (PARTITION BY element_id, content_type ORDER BY chunk_index, id)) SELECT id, element_id, content_type FROM l WHERE t = a OR t = b""",
    "duplicate_identifier_check": """WITH u AS (SELECT id, element_id, row_number() OVER (PARTITION BY element_id, content_type, original_text ORDER BY id) AS n FROM usc_chunks)
SELECT id, CASE WHEN n = 1 THEN element_id ELSE element_id || '#dup' || (n - 1) END AS unique_id FROM u""",
    "roster_majority_vote": f"WITH {_V} SELECT surname, department, n, round(confidence, 6) AS confidence FROM roster",
    "panel_vote_department": f"WITH {_V} SELECT * FROM panel",
    "department_resolution": f"""WITH {_V},
kc AS (SELECT court_id, court_department AS dep, count(*) AS k FROM c WHERE court_id IS NOT NULL AND court_department IS NOT NULL GROUP BY ALL),
kr AS (SELECT *, sum(k) OVER (PARTITION BY court_id) AS n, row_number() OVER (PARTITION BY court_id ORDER BY k DESC, dep) AS rn FROM kc),
x AS (SELECT c.id AS case_id, c.court_department AS p, panel.department AS b, q.dep AS a FROM c LEFT JOIN panel ON panel.case_id = c.id LEFT JOIN (SELECT court_id, dep FROM kr WHERE rn = 1 AND n >= 3 AND k / n >= 0.8) q ON q.court_id = c.court_id)
SELECT case_id, CASE WHEN a <> b THEN p ELSE coalesce(a, b, p) END AS resolved,
  CASE WHEN a <> b THEN 'conflict' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'both' WHEN a IS NOT NULL THEN 'first' WHEN b IS NOT NULL THEN 'second' WHEN p IS NOT NULL THEN 'prior' ELSE 'none' END AS resolved_by,
  CASE WHEN a <> b THEN 'CONFLICT' WHEN a IS NOT NULL AND b IS NOT NULL THEN 'HIGH' WHEN a IS NOT NULL OR b IS NOT NULL THEN 'MED' WHEN p IS NOT NULL THEN 'LOW' ELSE 'NONE' END AS grade FROM x""",
    "trigram_topk_match": f"WITH {_MATCH} SELECT entry, place, case_id, round(best_score, 6) AS best_score FROM f",
    "index_resolution_decide": f"""WITH {_MATCH},
g AS (SELECT *, max(best_score) FILTER (WHERE place = 1) OVER w AS top, max(best_score) FILTER (WHERE place = 2) OVER w AS second, max(abbr_score) FILTER (WHERE place = 1) OVER w AS ta, max(name_score) FILTER (WHERE place = 1) OVER w AS tn,
  max(name_score) FILTER (WHERE place = 2) OVER w AS sn, max(case_id) FILTER (WHERE place = 1) OVER w AS ti FROM f WINDOW w AS (PARTITION BY entry)),
h AS (SELECT *, abs(best_score - top) <= 0.001 OR abs(abbr_score - ta) <= 0.001 AS tied FROM g),
o AS (SELECT entry, any_value(top) AS top, any_value(second) AS second, any_value(tn) AS tn, any_value(sn) AS sn, any_value(ti) AS ti, count(*) FILTER (WHERE tied) AS n, max(n_cites) FILTER (WHERE tied) AS hi, min(n_cites) FILTER (WHERE tied) AS lo,
  min(case_id) FILTER (WHERE tied) AS low, first(case_id ORDER BY n_cites DESC, case_id) FILTER (WHERE tied) AS rich FROM h GROUP BY entry),
q AS (SELECT e.entry, o.*, CASE WHEN top IS NULL THEN 'no_candidates' WHEN top < 0.25 THEN 'below_floor' WHEN top - coalesce(second, 0) >= 0.1 THEN 'decisive_margin' WHEN n = 1 THEN 'low_confidence' WHEN hi > lo THEN 'richness'
  WHEN tn - coalesce(sn, 0) >= 0.05 THEN 'name_score' ELSE 'lowest_id' END AS reason FROM e LEFT JOIN o ON o.entry = e.entry)
SELECT entry, CASE WHEN reason IN ('decisive_margin', 'name_score') THEN ti WHEN reason = 'richness' THEN rich WHEN reason = 'lowest_id' THEN low END AS case_id, reason FROM q""",
    "batch_stats": """WITH l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS failed, count(*) FILTER (WHERE l_linestatus = 'F') AS done, round(sum(l_extendedprice), 2) AS cost FROM lineitem GROUP BY 1)
SELECT o_orderstatus, count(*) AS n_jobs, CAST(sum(n) AS BIGINT) AS n_requests, CAST(sum(failed) AS BIGINT) AS n_failed, round(sum(done) * 100.0 / sum(n), 2) AS done_pct, round(sum(cost), 0) AS cost FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1""",
    "batch_error_breakdown": """SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, array_to_string(list(event_id ORDER BY event_id)[1:5], ',') AS first_ids FROM events WHERE event_type = 'error' GROUP BY 1""",
    "quality_tier_distribution": """WITH g AS (SELECT CASE WHEN relevance_score IS NULL THEN 'none' WHEN relevance_score >= 0.8 THEN 'high' WHEN relevance_score >= 0.5 THEN 'medium' ELSE 'low' END AS tier, count(*) AS n FROM opinion_keywords GROUP BY 1)
SELECT tier, n, round(n * 100.0 / sum(n) OVER (), 1) AS pct FROM g""",
    "recent_activity_24h": "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOURS GROUP BY 1",
    "department_skew_tripwire": f"""WITH g AS (SELECT court_id, court_department, count(*) AS c FROM ({_C}) WHERE court_id IS NOT NULL GROUP BY ALL), w AS (SELECT *, CAST(sum(c) OVER (PARTITION BY court_id) AS BIGINT) AS n FROM g)
SELECT court_id, court_department, n, round(c / n, 6) AS share FROM w WHERE n >= 40 AND c / n > 0.6""",
    "resume_queue_antijoin": "SELECT DISTINCT id, curie FROM opinions o WHERE NOT coalesce(is_valueless, false) AND curie IS NOT NULL AND NOT EXISTS (SELECT 1 FROM opinion_keywords k WHERE k.opinion_curie = o.curie)",
    "compile_plain_manifest": "SELECT source_ref, count(*) AS n, sha256(string_agg(curie, chr(10) ORDER BY curie)) AS digest FROM (SELECT DISTINCT source_ref, curie FROM opinions WHERE curie IS NOT NULL) GROUP BY 1",
    "compile_hash_manifest": """WITH p AS (SELECT source_ref, substr(md5(curie), 1, 3) AS part, count(*) AS n, sha256(string_agg(curie, chr(10) ORDER BY curie)) AS p FROM (SELECT DISTINCT source_ref, curie FROM opinions WHERE curie IS NOT NULL) GROUP BY 1, 2)
SELECT source_ref, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(p, chr(10) ORDER BY part)) AS digest FROM p GROUP BY 1""",
    "freshness_state": """WITH a AS (SELECT curie, min(sha256(coalesce(text, ''))) AS a FROM stage_opinions WHERE curie IS NOT NULL GROUP BY 1), b AS (SELECT curie, min(sha256(coalesce(text, ''))) AS b FROM opinions WHERE curie IS NOT NULL GROUP BY 1)
SELECT CASE WHEN b IS NULL THEN 'new' WHEN a = b THEN 'fresh' ELSE 'stale' END AS state, count(*) AS n FROM a LEFT JOIN b USING (curie) GROUP BY 1""",
    "payload_expand": f"WITH {_PAY} SELECT opinion_curie, category, keyword_id, relevance_score AS relevance FROM p WHERE category IN ('doctrine', 'field_of_law')",
    "payload_validate": f"""WITH {_PAY}, g AS (SELECT opinion_curie, count(*) FILTER (WHERE category = 'doctrine') AS a, count(*) FILTER (WHERE category = 'field_of_law') AS b,
  count(*) FILTER (WHERE category IN ('doctrine', 'field_of_law') AND relevance_score IS NULL) AS c, count(*) FILTER (WHERE category IN ('doctrine', 'field_of_law') AND (relevance_score < 0 OR relevance_score > 1)) AS e FROM p GROUP BY 1)
SELECT concat_ws(',', CASE WHEN a = 0 THEN 'no_doctrine' END, CASE WHEN b = 0 THEN 'no_field' END, CASE WHEN c > 0 THEN 'score_missing' END, CASE WHEN e > 0 THEN 'score_range' END) AS faults, count(*) AS n FROM g GROUP BY 1""",
    "vector_topk_cosine": """WITH q AS (SELECT list_transform(embedding, lambda v: v::DOUBLE) AS q FROM embeddings ORDER BY vec_id LIMIT 1)
SELECT vec_id, label, round(list_cosine_similarity(list_transform(embedding, lambda v: v::DOUBLE), q), 6) AS cosine FROM embeddings, q ORDER BY cosine DESC, vec_id LIMIT 10""",
    "citation_stats": """WITH c AS (SELECT DISTINCT id, case_id, category, cited FROM (SELECT id, case_id, category, unnest(CASE WHEN cited_case_ids IS NULL OR len(cited_case_ids) = 0 THEN [NULL] ELSE cited_case_ids END) AS cited FROM case_citations))
SELECT coalesce(category, 'none') AS category, count(DISTINCT id) AS n, count(DISTINCT cited) AS n_cited, count(DISTINCT case_id) AS n_citing, count(*) FILTER (WHERE cited IS NULL) AS n_unresolved FROM c GROUP BY 1""",
    "citing_case_counts": "SELECT cited, count(DISTINCT case_id) AS n_citing FROM (SELECT case_id, unnest(cited_case_ids) AS cited FROM case_citations) WHERE cited IS NOT NULL GROUP BY 1",
    "storage_efficiency": "SELECT 'repeated' AS way, CAST(sum(length(keyword_text)) AS BIGINT) AS chars FROM source_keywords UNION ALL SELECT 'normalised', CAST(sum(length(k)) AS BIGINT) FROM (SELECT DISTINCT keyword_text AS k FROM source_keywords)",
    "decade_tally": f"SELECT CAST(floor(try_cast(substr(decision_date, 1, 4) AS INT) / 10) * 10 AS BIGINT) AS decade, count(*) AS n FROM ({_C}) GROUP BY 1 HAVING count(*) >= 3",
    "repeatable_sample": "SELECT id FROM (SELECT DISTINCT id FROM opinions WHERE id IS NOT NULL) ORDER BY md5(id || 'seed'), id LIMIT 20",
    "pricing_summary": """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 0) AS sum_net, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""",
}
