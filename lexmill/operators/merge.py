"""Merging sources: canonical keywords, remaps, collapses and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ids import dense_ids, first_by

# fixed values: from the weakest to the strongest
TIER_RANK = ("uncurated", "llm_classified", "expert_reviewed")
STATUS_RANK = ("dismissed", "pending", "promoted")


def keyword_key(text: Column) -> Column:
    return F.lower(text)


def canonical_keywords(sources: DataFrame) -> DataFrame:
    """(key, canonical_text, winning_tier, total_frequency): one keyword for all spellings that differ in case only.

    The tier of the largest summed frequency wins, ties go to the first by name; so does the spelling, by its own frequency.
    """
    rows = sources.withColumn("key", keyword_key(F.col("keyword_text"))).where("key is not null")
    tiers = rows.groupBy("key", "tier").agg(F.sum("frequency").alias("f"))
    winner = first_by(tiers, ["key"], [F.desc_nulls_last("f"), F.asc_nulls_last("tier")]).select("key", F.col("tier").alias("winning_tier"))
    text = first_by(rows.select("key", "keyword_text", "frequency"), ["key"], [F.desc_nulls_last("frequency"), "keyword_text"])
    total = rows.groupBy("key").agg(F.sum("frequency").alias("total_frequency"))
    return winner.join(text.select("key", F.col("keyword_text").alias("canonical_text")), "key").join(total, "key")


def tier_conflicts(sources: DataFrame) -> DataFrame:
    """The losing tiers of keywords that were given several, with the sources that gave them."""
    rows = sources.withColumn("key", keyword_key(F.col("keyword_text")))
    per = rows.groupBy("key", "tier").agg(F.sum("frequency").alias("n"), F.array_join(F.sort_array(F.collect_set("source_ref")), ",").alias("sources"))
    win = canonical_keywords(sources).select("key", "winning_tier")
    a = per.join(win, "key").where("tier = winning_tier").select("key", "winning_tier", F.col("n").alias("winning_count"), F.col("sources").alias("sources_winning"))
    b = per.select("key", F.col("tier").alias("losing_tier"), F.col("n").alias("losing_count"), F.col("sources").alias("sources_losing"))
    return a.join(b, "key").where("losing_tier <> winning_tier")


def keyword_remap(sources: DataFrame) -> DataFrame:
    """(source_ref, old_id, new_id): where each source's keyword went."""
    ids = dense_ids(canonical_keywords(sources).select("key"), ["key"])
    rows = sources.select("source_ref", F.col("id").alias("old_id"), keyword_key(F.col("keyword_text")).alias("key")).distinct()
    return rows.join(ids, "key").select("source_ref", "old_id", "new_id")


def precedence(value: Column, order: tuple[str, ...]) -> Column:
    """The place of a value in ``order`` from 1, null if it has none."""
    rank = F.lit(None).cast("int")
    for i, name in enumerate(order, 1):
        rank = F.when(value == name, i).otherwise(rank)
    return rank


def of_precedence(rank: Column, order: tuple[str, ...]) -> Column:
    name = F.lit(None).cast("string")
    for i, n in enumerate(order, 1):
        name = F.when(rank == i, F.lit(n)).otherwise(name)
    return name


def collapsed_anchors(anchors: DataFrame, keywords: DataFrame) -> DataFrame:
    """Staged anchors on canonical keywords: counts summed, the highest tier and status, the longest description.

    Anchors whose doctrine has no keyword are left out; a null field stays null.
    """
    canon = canonical_keywords(keywords)
    to = keywords.select("id", keyword_key(F.col("keyword_text")).alias("key")).distinct().join(canon.select("key"), "key")
    rows = (
        anchors.distinct()
        .join(to.select(F.col("id").alias("old_doctrine_keyword_id"), F.col("key").alias("doctrine")), "old_doctrine_keyword_id")
        .join(to.select(F.col("id").alias("old_field_of_law_keyword_id"), F.col("key").alias("field")), "old_field_of_law_keyword_id", "left")
    )
    tier, status = precedence(F.col("confidence_tier"), TIER_RANK), precedence(F.col("status"), STATUS_RANK)
    longest = F.struct((-F.length("description")).alias("n"), "source_ref", "old_id", "description")
    out = rows.groupBy("doctrine", "field").agg(
        F.sum("co_occurrence_count").alias("total_count"), F.max(tier).alias("t"), F.max(status).alias("s"),
        F.min(F.when(F.col("description").isNotNull(), longest)).alias("d"), F.max("last_reviewed_at").alias("last_reviewed_at"),
    )
    return out.select("doctrine", "field", "total_count", of_precedence(F.col("t"), TIER_RANK).alias("confidence_tier"), of_precedence(F.col("s"), STATUS_RANK).alias("status"), F.col("d.description").alias("description"), "last_reviewed_at")


def active_assignments(assignments: DataFrame) -> DataFrame:
    """Active keyword assignments, one an opinion and keyword: the best score, then the oldest, then the lowest id."""
    rows = assignments.where("status = 'active'")
    return first_by(rows, ["opinion_curie", "keyword_id"], [F.desc_nulls_last("relevance_score"), F.asc_nulls_last("created_at"), "id"])


def remapped(rows: DataFrame, map_: DataFrame, ref: str, old: str, to: str, keep: bool = False) -> DataFrame:
    """``rows`` with ``old`` replaced by ``to`` through a remap on (source_ref, old_id); keep: unresolved ones as null."""
    m = map_.select(F.col("source_ref").alias(ref), F.col("old_id").alias(old), F.col("new_id").alias(to))
    return rows.join(m, [ref, old], "left" if keep else "inner")


def leg_counts(rows: DataFrame, legs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: the rows, and for each leg how many have a key that its parent lacks. legs: name -> (parent keys, column)."""
    for name, (parent, column) in legs.items():
        keys = parent.select(F.col(parent.columns[0]).alias(column)).where(F.col(column).isNotNull()).distinct().withColumn(f"_{name}", F.lit(True))
        rows = rows.join(keys, column, "left")
    counts = [F.count_if(F.col(column).isNotNull() & F.col(f"_{name}").isNull()).alias(f"unresolved_{name}") for name, (_, column) in legs.items()]
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *counts)


def orphan_audit(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(name, orphans) of each check (name, child, key, parent, key): rows whose non-null key the parent lacks."""
    out = None
    for name, child, key, parent, parent_key in checks:
        rows = child.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).join(parent.select(F.col(parent_key).alias("k")).distinct(), "k", "left_anti")
        row = rows.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("orphans"))
        out = row if out is None else out.unionByName(row)
    return out


def _object(json: Column) -> Column:
    """A JSON object as a map whose values keep their kinds; empty for null and for what is no object."""
    return F.coalesce(F.from_json(json, "map<string,variant>"), F.from_json(F.lit("{}"), "map<string,variant>"))


def merged_json(old: Column, new: Column) -> Column:
    """Two JSON objects as one: the new one's values win, name by name, also where they are null; names are sorted."""
    both = F.map_concat(F.map_filter(_object(old), lambda k, v: ~F.map_contains_key(_object(new), k)), _object(new))
    return F.to_json(F.map_from_arrays(F.array_sort(F.map_keys(both)), F.transform(F.array_sort(F.map_keys(both)), lambda k: both[k])))


def folded(rows: DataFrame, key: list[str], order: str, json: str, greatest: list[str] = ()) -> DataFrame:
    """All rows of a key as one, however many: ``greatest`` columns, the row count as ``frequency``, and the merged objects.

    Each name of an object keeps the value of the last row by ``order`` that has it. Names are folded apart, so partial
    results combine before they are moved, and no key's rows are gathered.
    """
    one = rows.groupBy(*key).agg(*(F.max(c).alias(c) for c in greatest), F.count(F.lit(1)).alias("frequency"))
    names = rows.select(*key, order, F.explode(F.transform_values(_object(F.col(json)), lambda k, v: F.to_json(v))).alias("name", "raw"))
    last = names.groupBy(*key, "name").agg(F.max_by("raw", order).alias("raw"))
    quoted = F.concat(F.lit('"'), F.regexp_replace("name", r'(["\\\\])', r"\\\\$1"), F.lit('":'), "raw")
    objects = last.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("name", quoted.alias("q")))), lambda x: x.q), ",").alias("_inside"))
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"j.{c}")) for c in key]
    joined = one.alias("o").join(objects.alias("j"), same, "left")
    return joined.select(*(f"o.{c}" for c in (*key, *greatest, "frequency")), F.concat(F.lit("{"), F.coalesce("j._inside", F.lit("")), F.lit("}")).alias(json))


def audit_by_parent(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(name, orphans) as ``orphan_audit`` gives, with one join for each parent: the keys of all its children meet it at once.

    Keys are counted before they are moved. checks: (name, child, key, parent, parent key), parents told apart by identity.
    """
    groups: dict[tuple[int, str], list] = {}
    for name, child, key, parent, parent_key in checks:
        groups.setdefault((id(parent), parent_key), [parent]).append((name, child, key))
    out = None
    for (_, parent_key), (parent, *children) in groups.items():
        keys = None
        for name, child, key in children:
            part = child.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name))
            keys = part if keys is None else keys.unionByName(part)
        lost = keys.join(parent.select(F.col(parent_key).cast("string").alias("k")).where("k is not null").distinct(), "k", "left_anti").groupBy("name").agg(F.sum("n").alias("n"))
        every = F.explode(F.array(*(F.lit(n) for n, _, _ in children))).alias("name")
        rows = parent.sparkSession.range(1).select(every).join(lost, "name", "left").select("name", F.coalesce("n", F.lit(0)).alias("orphans"))
        out = rows if out is None else out.unionByName(rows)
    return out


def upsert(old: DataFrame, new: DataFrame, key: list[str], greatest: list[str] = (), add: list[str] = (), json: list[str] = ()) -> DataFrame:
    """Old and new rows as one table, one row a key.

    New values win where they are not null; of ``greatest`` columns the larger one, ``add`` columns are summed, and the
    JSON objects of ``json`` columns are merged at the top level, the new one winning.
    """
    rest = [c for c in old.columns if c not in key]
    a = old.select(*key, *(F.col(c).alias(f"_o_{c}") for c in rest))
    b = new.select(*key, *(F.col(c).alias(f"_n_{c}") for c in rest))

    def one(c: str) -> Column:
        o, n = F.col(f"_o_{c}"), F.col(f"_n_{c}")
        if c in greatest:
            return F.greatest(o, n)
        if c in add:
            return F.coalesce(o, F.lit(0)) + F.coalesce(n, F.lit(0))
        if c in json:
            return merged_json(o, n)
        return F.coalesce(n, o)

    return a.join(b, key, "full").select(*key, *(one(c).alias(c) for c in rest))


def guarded_update(rows: DataFrame, updates: DataFrame, key: str, column: str, only_null: bool = True) -> DataFrame:
    """``rows`` with ``column`` taken from ``updates`` where it is null (or differs); an update given twice is refused."""
    one = updates.groupBy(key).agg(F.min(column).alias("_new"), F.count_distinct(column).alias("_n"))
    one = one.select(key, F.when(F.col("_n") > 1, F.raise_error("several updates for one key")).otherwise(F.col("_new")).alias("_new"))
    guard = F.col(column).isNull() if only_null else ~F.col(column).eqNullSafe(F.col("_new"))
    changed = F.coalesce(guard & F.col("_new").isNotNull(), F.lit(False))
    return rows.join(one, key, "left").withColumn("changed", changed).withColumn(column, F.when(changed, F.col("_new")).otherwise(F.col(column))).drop("_new")


def insert_new(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``new`` whose key ``old`` lacks, nulls being equal, one a key."""
    keyed = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")).alias(f"_k_{c}") for c in key]
    names = [f"_k_{c}" for c in key]
    fresh = new.select("*", *keyed).join(old.select(*keyed).distinct(), names, "left_anti")
    return first_by(fresh, names, [F.col(c) for c in new.columns]).drop(*names)


def replaced(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Delete and insert by key: the rows of ``old`` whose key ``new`` has are gone."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)
