"""Problem 1: near-duplicate records with small edits.

Method: covering locality-sensitive hashing. Symbols of a sketch get binary codes, a table is a nonzero vector v, and it
keeps the symbols whose code has an odd product with v. Over r + 1 code bits the masks cover: whichever r symbols differ,
some mask keeps none of them, so every pair within radius r collides in some table.

* Texts: the sketch is of min-hashes over word shingles, in parts of 6 symbols with radius 2 each. The masks are
  the words of a [6, 3, 3] code: whichever 2 of the 6 differ, one of 7 masks keeps neither, and each keeps 3 symbols or
  more, so that unlike texts seldom meet. A pair is missed there only if more than 2 of 6 symbols differ in every part.
  Shingles that come more than ``COMMON`` times a text, and ``LEAST_COMMON`` times at least, are boilerplate. Every text
  has ``PARTS`` parts over its other shingles, and ``CROSSED`` tables of two symbols of those and two of the boilerplate,
  for pairs that share more of one kind than of the other; a text of one kind only has all its symbols from that. Texts of
  which ``WHOLE`` or more are boilerplate also have ``WHOLE_PARTS`` parts over all their shingles, so that hot families
  meet by their true similarity. Candidates are verified if the symbols of all their shingles agree often enough: of
  pairs at the limit one in some 10,000 is lost there.
* Names: the sketch is of the letter counts of both parties' distinctive words, 52 symbols with radius 4: two slips.

Candidates are verified exactly, texts by the Jaccard similarity of their shingle sets, names by the edit distances of
their parties. Texts of the same words form a class before anything is paired, so copies are one row in every table; the
result of ``similar_texts`` is links between classes, and membership. No bucket, partner or candidate is capped.

Defined cases: null and empty texts and those of fewer than ``least_words`` words take no part, nor do valueless ones;
a name without two parties takes no part; repeated rows count once; texts are read whole, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import cut, let_go, salted_join, sized

PARTS = 4
CROSSED = 48
WHOLE_PARTS = 10
COMMON = 0.01
LEAST_COMMON = 20
WHOLE = 0.55
DEVIATIONS = 3.7
_CODE = np.array([[1, 0, 0, 0, 1, 1], [0, 1, 0, 1, 0, 1], [0, 0, 1, 1, 1, 0]])
_MASKS = np.array([(np.array([v & 1, v >> 1 & 1, v >> 2]) @ _CODE) % 2 for v in range(1, 8)], dtype=bool)


# ---- texts


class Shingler:
    """Hashes of the word n-grams of texts; the same in every process."""

    def __init__(self, n: int):
        self.n, self.known = n, {}
        self.find = re.compile(r"[a-z0-9]+").findall

    def codes(self, text: str | None) -> list[int]:
        import xxhash

        words, known = self.find(text.lower()) if text else [], self.known
        try:
            return [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w) >> 1
            codes = [known[w] for w in words]
            if len(known) > 2_000_000:
                known.clear()
            return codes

    def flat(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(shingles, owner): the n-grams of many texts in order, with repeats."""
        from itertools import chain

        size = np.array([len(x) for x in lists], dtype=np.int64)
        codes = np.fromiter(chain.from_iterable(lists), dtype=np.uint64, count=int(size.sum()))
        owner = np.repeat(np.arange(len(lists)), size)
        k = max(0, len(codes) - self.n + 1)
        h = np.zeros(k, dtype=np.uint64)
        for i in range(self.n):
            h = (h ^ codes[i : i + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        whole = owner[:k] == owner[self.n - 1 :] if k else np.zeros(0, dtype=bool)
        return h[whole], owner[:k][whole]


#: texts in which shingles are counted at once
BLOCK = 4096


def _frequent_batches(batches: Iterator, n: int, share: float) -> Iterator:
    """(shingle, occurrences) of what comes a quarter of ``share`` times a text in a block, and (0, number of texts)."""
    import pyarrow as pa

    def counted(lists: list[list[int]]):
        every, counts = np.unique(s.flat(lists)[0], return_counts=True)
        kept = counts >= share * len(lists) / 4
        columns = np.concatenate([[0], every[kept].view(np.int64)]), np.concatenate([[len(lists)], counts[kept]])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shingle", "n"])

    s, held = Shingler(n), []
    for batch in batches:
        held += [s.codes(t) for t in batch.column(0).to_pylist()]
        while len(held) >= BLOCK:
            yield counted(held[:BLOCK])
            held = held[BLOCK:]
    if held:
        yield counted(held)


def _exact_batches(batches: Iterator, n: int, asked: np.ndarray) -> Iterator:
    """(shingle, occurrences) of the asked shingles in this task."""
    import pyarrow as pa

    s, sums = Shingler(n), np.zeros(len(asked), dtype=np.int64)
    for batch in batches:
        flat, _ = s.flat([s.codes(t) for t in batch.column(0).to_pylist()])
        at = np.minimum(np.searchsorted(asked, flat), len(asked) - 1)
        sums += np.bincount(at[asked[at] == flat], minlength=len(asked))
    yield pa.RecordBatch.from_arrays([pa.array(asked.view(np.int64)), pa.array(sums)], names=["shingle", "n"])


def common_shingles(texts: DataFrame, n: int, share: float = COMMON) -> np.ndarray:
    """The shingles that come more than ``share`` times a text, sorted: counted exactly over all texts.

    Blocks report what is frequent in them, which misses at most a quarter of ``share``; what that leaves possible, some
    ten thousand shingles at most, is counted in full. So the result does not depend on how the texts are parted.
    """
    sums = cut(texts.select("text").mapInArrow(lambda b: _frequent_batches(b, n, share), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")))
    total = next((r.n for r in sums.where("shingle = 0").collect()), 0)
    least = max(LEAST_COMMON, share * total)
    asked = sums.where((F.col("shingle") != 0) & (F.col("n") > least - share * total / 4)).select("shingle").toPandas()["shingle"]
    asked = texts.sparkSession.sparkContext.broadcast(np.sort(asked.to_numpy(dtype=np.int64).view(np.uint64)))
    if not len(asked.value):
        return asked.value
    exact = texts.select("text").mapInArrow(lambda b: _exact_batches(b, n, asked.value), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return np.sort(exact.where(F.col("n") > least).select("shingle").toPandas()["shingle"].to_numpy(dtype=np.int64).view(np.uint64))


def _sketch_batches(batches: Iterator, n: int, least_words: int, common: np.ndarray, parts: int, seed: int = 11) -> Iterator:
    """(id, class, keys, mark) of the texts of ``least_words`` words or more: a key for each table, by its number.

    A copy of a text that came before in the task has its id and class only.
    """
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    k = _MASKS.shape[1] * WHOLE_PARTS
    mult = rng.integers(1, 2**32, size=k, dtype=np.uint32) | np.uint32(1)
    add = rng.integers(0, 2**32, size=k, dtype=np.uint32)
    s, met = Shingler(n), set()
    for batch in batches:
        lists = [s.codes(t) for t in batch.column(1).to_pylist()]
        kept = [i for i, x in enumerate(lists) if len(x) >= max(least_words, n)]
        if not kept:
            continue
        ids = np.array([batch.column(0)[i].as_py() for i in kept], dtype=np.int64)
        lists = [lists[i] for i in kept]
        classes = np.array([class_of(x) for x in lists], dtype=np.uint64).view(np.int64)
        first = np.zeros(len(ids), dtype=bool)
        first[np.unique(classes, return_index=True)[1]] = True
        first &= [c not in met for c in classes.tolist()]
        if len(met) > 1_000_000:  # then some copies have their keys again
            met.clear()
        met.update(classes[first].tolist())
        fresh = [x for x, f in zip(lists, first.tolist(), strict=True) if f]
        blocks = [_sketched(s, fresh[i : i + 512], common, parts, mult, add) for i in range(0, len(fresh), 512)]
        keys, marks = iter(x for b in blocks for x in b[0]), iter(x for b in blocks for x in b[1])
        none = np.zeros(0, dtype=np.int32)
        rows = [next(keys) if f else none for f in first.tolist()]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(classes), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows))), pa.array([next(marks) if f else None for f in first.tolist()], pa.binary())],
            names=["id", "class", "keys", "mark"],
        )


def _sketched(s: Shingler, lists: list[list[int]], common: np.ndarray, parts: int, mult: np.ndarray, add: np.ndarray) -> tuple[list[np.ndarray], list[bytes]]:
    """The keys and the mark of each text."""
    flat, owner = s.flat(lists)
    hot = common[np.minimum(np.searchsorted(common, flat), len(common) - 1)] == flat if len(common) else np.zeros(len(flat), dtype=bool)
    every, held = np.bincount(owner, minlength=len(lists)), np.bincount(owner[hot], minlength=len(lists))
    narrow = (flat >> np.uint64(32)).astype(np.uint32)
    rare, shared = (_mins(narrow[x], owner[x], len(lists), mult, add) for x in (~hot, hot))
    whole = np.minimum(rare, shared)
    rare, shared = np.where((held < every)[:, None], rare, whole), np.where((held > 0)[:, None], shared, whole)
    rare, shared, whole = (_mixed(x.astype(np.uint64)) for x in (rare, shared, whole))
    own = np.concatenate([_masked(rare, parts), _crossed(rare, shared)], axis=1)
    both = _masked(whole, WHOLE_PARTS)
    keys = [np.concatenate([a, b]) if h else a for a, b, h in zip(own, both, (held >= WHOLE * every).tolist(), strict=True)]
    return keys, [x.tobytes() for x in whole.astype(np.uint8)]


def _mins(flat: np.ndarray, owner: np.ndarray, n: int, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The least hash of each text's shingles under each function; the greatest number where it has none."""
    mins = np.full((n, len(mult)), np.iinfo(np.uint32).max, dtype=np.uint32)
    if len(flat):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        h, low = np.empty_like(flat), np.empty_like(flat)
        for j in range(len(mult)):
            np.multiply(flat, mult[j], out=h)
            h += add[j]
            np.right_shift(h, 15, out=low)
            h ^= low
            mins[owner[starts], j] = np.minimum.reduceat(h, starts)
    return mins


def _mixed(hashes: np.ndarray) -> np.ndarray:
    out = hashes * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _masked(symbols: np.ndarray, parts: int) -> np.ndarray:
    """The key of each table: the symbols that its mask keeps."""
    k = _MASKS.shape[1]
    out = np.zeros((len(symbols), parts * len(_MASKS)), dtype=np.uint64)
    for t in range(parts * len(_MASKS)):
        p, m = divmod(t, len(_MASKS))
        for j in np.flatnonzero(_MASKS[m]):
            out[:, t] = _mixed(out[:, t] ^ symbols[:, p * k + j])
    return out.astype(np.uint32).view(np.int32)


def _crossed(rare: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """``CROSSED`` tables of two rare symbols and two common ones, no two tables with the same four."""
    k = rare.shape[1]
    order = np.concatenate([np.arange(k), np.arange(k).reshape(6, -1).T.reshape(-1)]).reshape(-1, 2)[:CROSSED]
    beside = np.concatenate([np.arange(k).reshape(-1, 2), (np.arange(k) + k // 2).reshape(-1, 2) % k])[:CROSSED]
    out = _mixed(rare[:, order[:, 0]] ^ (rare[:, order[:, 1]] * np.uint64(0x9E3779B97F4A7C15)))
    for j in range(2):
        out = _mixed(out ^ shared[:, beside[:, j]])
    return out.astype(np.uint32).view(np.int32)


#: key rows that a task takes
KEYS_A_TASK = 400_000


def meeting(rows: DataFrame, keys: Column, n_keys: int, tables: int = 2**15) -> DataFrame:
    """rows(class, keys), one a class -> (class_a, class_b): the classes that share a table's key, class_a < class_b, each pair once.

    Keys are in the order of the ``tables``, again and again. A key is of 32 bits within its table, so of n classes some
    n / 2^32 meet one by chance in each table.
    """
    numbered = rows.select("class", F.posexplode(keys).alias("table", "k"))
    key = F.shiftleft(F.pmod("table", F.lit(tables)).cast("long"), 32) + F.pmod(F.col("k").cast("long"), F.lit(2**32))
    met = numbered.select("class", key.alias("key")).repartition(max(4, -(-n_keys // KEYS_A_TASK)), "key")
    pairs = met.withColumnRenamed("class", "class_a").join(met.withColumnRenamed("class", "class_b"), "key").where("class_a < class_b")
    return pairs.select("class_a", "class_b").distinct()


def one_a_class(rows: DataFrame) -> DataFrame:
    """rows(class, keys ...) with keys for the first of a class in each task -> one row with keys for each class.

    Only the classes met in several tasks are moved, so a class of very many copies costs as many rows as there are tasks.
    """
    rows = rows.where(F.size("keys") > 0).select("class", "keys")
    several = cut(rows.groupBy("class").count().where("count > 1").select("class"))
    if several.isEmpty():
        return rows
    several = sized(several)
    return rows.join(several, "class", "left_anti").unionByName(rows.join(several, "class", "left_semi").groupBy("class").agg(F.first("keys").alias("keys")))


def class_of(codes: list[int]) -> int:
    """The class of the texts of these words."""
    import xxhash

    return xxhash.xxh3_64_intdigest(np.array(codes, dtype=np.uint64).tobytes())


def _set_batches(batches: Iterator, n: int) -> Iterator:
    """(text) -> (class, shingles) for exact verification."""
    import pyarrow as pa

    s = Shingler(n)
    for batch in batches:
        lists = [s.codes(t) for t in batch.column(0).to_pylist()]
        sets = [np.unique(s.flat([x])[0]).view(np.int64) for x in lists]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        values = np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)
        classes = np.array([class_of(x) for x in lists], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(classes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))], names=["class", "shingles"])


def similar_texts(
    texts: DataFrame, shingle: int = 5, similarity: float = 0.8, least_words: int = 0, parts: int = PARTS, share: float = COMMON
) -> tuple[DataFrame, DataFrame]:
    """texts(id, text) -> members (class, id) and links (class_a, class_b, similarity).

    A class is the texts of the same words. A link joins two classes whose shingle sets are alike to ``similarity``.
    """
    spark = texts.sparkSession
    texts = texts.select(F.col("id").cast("long").alias("id"), "text").where("id is not null and text is not null")
    common = spark.sparkContext.broadcast(common_shingles(texts, shingle, share))
    sketches = cut(texts.mapInArrow(lambda b: _sketch_batches(b, shingle, least_words, common.value, parts), "id long, class long, keys array<int>, mark binary"))
    members = sketches.select("class", "id").distinct()
    # one row a class in every table: copies are dropped in their task, and again where the keys have come together
    pairs = meeting(one_a_class(sketches), F.col("keys"), sketches.agg(F.sum(F.size("keys"))).first()[0] or 0)
    pairs = cut(_alike(pairs, sketches.groupBy("class").agg(F.max("mark").alias("mark")), len(_MASKS[0]) * WHOLE_PARTS, similarity))
    let_go(spark)  # of the keys, the bulk of what was moved
    asked = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class")).distinct().join(sketches.groupBy("class").agg(F.min("id").alias("id")), "class")
    # an id may have come with several texts: the class is that of the text itself
    held = texts.join(sized(asked.select("id")), "id").select("text")
    sets = held.mapInArrow(lambda b: _set_batches(b, shingle), "class long, shingles array<long>").groupBy("class").agg(F.first("shingles").alias("shingles"))
    both = pairs.join(sets.select(F.col("class").alias("class_a"), F.col("shingles").alias("a")), "class_a").join(
        sets.select(F.col("class").alias("class_b"), F.col("shingles").alias("b")), "class_b"
    )
    shared = F.size(F.array_intersect("a", "b"))
    every = F.size("a") + F.size("b") - shared
    links = both.select("class_a", "class_b", (shared / every).alias("similarity")).where(F.col("similarity") >= similarity)
    return members, links


def _agreeing(batches: Iterator, least: float) -> Iterator:
    """The pairs of (class_a, class_b, mark_a, mark_b) whose marks agree in ``least`` places or more."""
    import pyarrow as pa

    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
        ok = pa.array((a == b).sum(1) >= least) if batch.num_rows else pa.array([], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(ok) for i in (0, 1)], names=["class_a", "class_b"])


def _alike(pairs: DataFrame, marks: DataFrame, k: int, similarity: float) -> DataFrame:
    """The pairs whose ``k`` symbols of all shingles agree as those of a pair of ``similarity`` do, less ``DEVIATIONS``."""
    least = k * similarity - DEVIATIONS * (k * similarity * (1 - similarity)) ** 0.5
    for x in "ab":
        pairs = pairs.join(marks.select(F.col("class").alias(f"class_{x}"), F.col("mark").alias(f"mark_{x}")), f"class_{x}")
    return pairs.select("class_a", "class_b", "mark_a", "mark_b").mapInArrow(lambda b: _agreeing(b, least), "class_a long, class_b long")


def member_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: the pairs within a class and those of linked classes."""
    linked = links.select("class_a", "class_b")
    a, b = (members.select(F.col("class").alias(f"class_{x}"), F.col("id").alias(x)) for x in "ab")
    across = linked.join(a, "class_a").join(b, "class_b").select("a", "b")
    many = members.groupBy("class").count().where("count > 1").select("class")
    several = members.join(many, "class", "left_semi")
    # a class of many copies is split: each of its parts meets all of them
    within = salted_join(several.select("class", F.col("id").alias("a")), several.select("class", F.col("id").alias("b")), ["class"], F.col("a")).where("a < b").select("a", "b")
    return across.unionByName(within).where("a <> b").select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def duplicate_classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class, copies, links): each text's class, the texts in it, and the other classes that are like it."""
    ends = links.select(F.explode(F.array("class_a", "class_b")).alias("class")).groupBy("class").agg(F.count(F.lit(1)).alias("links"))
    copies = members.groupBy("class").agg(F.count(F.lit(1)).alias("copies"))
    return members.join(copies, "class").join(ends, "class", "left").select("id", "class", "copies", F.coalesce("links", F.lit(0)).alias("links"))


# ---- names

#: words of a party's name that do not tell it apart
ROLES = frozenset("as executor exr executrix administrator admr trustee guardian respondent respondents appellant appellants plaintiff defendant petitioner et al ano ors and another action the in re matter estate of ex rel".split())
FIRMS = frozenset("company co inc corp corporation ltd llc incorporated limited assn association sons works".split())
PLACES = {"town": "town", "village": "village", "vil": "village", "city": "city", "county": "county", "board": "board", "bd": "board"}
_VERSUS = re.compile(r"\s+(?:vs?|versus|against|agt)\.?\s+", re.I)


def parties(name: str | None) -> list[tuple[str, str, str, str]] | None:
    """Both parties as (distinctive word, kind, given name, trade), or None if the name doesn't give two."""
    if not name:
        return None
    sides = _VERSUS.split(re.sub(r"\([^)]*\)", " ", name).strip())
    if len(sides) != 2:
        return None
    out = []
    for side in sides:
        raw = re.findall(r"[^\W\d_]+", side.lower())
        place = next((PLACES[w] for w in raw if w in PLACES), "")
        firm = any(w in FIRMS for w in raw)
        words = [w for w in raw if w not in ROLES and w not in FIRMS and w not in PLACES and w not in ("education", "educ")]
        if not words:
            return None
        if place:
            out.append((words[-1], place, "", ""))
        elif firm or len(words) > 2:
            out.append((words[0], "firm", "", " ".join(words[1:2])))
        elif len(words) == 2 and len(words[1]) > 1:
            out.append((words[1], "person", words[0], ""))
        else:
            out.append((words[0], "", "", ""))
    return out


def slips(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours as one edit, or most + 1 if it is more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, last[j - 2] + 1)
            row.append(d)
    return min(row[-1], most + 1)


def same_party(a: tuple, b: tuple) -> bool:
    """Whether kind, given name and trade can be of one party; what one leaves out does not count."""
    if a[1] and b[1] and a[1] != b[1]:
        return False
    if a[2] and b[2]:
        short, long = sorted((a[2], b[2]), key=len)
        if not (long.startswith(short) if len(short) == 1 else slips(short, long, 2) <= 2):
            return False
    return not (a[3] and b[3]) or slips(a[3], b[3], 2) <= 2 or a[3].startswith(b[3]) or b[3].startswith(a[3])


def same_matter(a: list[tuple], b: list[tuple]) -> bool:
    """Whether both parties are the same, in either order, with at most two slips in the distinctive words."""
    for x, y in ((b[0], b[1]), (b[1], b[0])):
        if slips(a[0][0], x[0], 2) + slips(a[1][0], y[0], 2) <= 2 and same_party(a[0], x) and same_party(a[1], y):
            return True
    return False


RADIUS = 4


def _name_masks(seed: int = 5) -> np.ndarray:
    """(52 letters, tables) weights: table v keeps the letters whose code has an odd product with v."""
    rng = np.random.default_rng(seed)
    bits = RADIUS + 1
    code = rng.permutation(np.resize(np.arange(1, 2**bits), 52))
    kept = np.array([[bin(c & v).count("1") & 1 for v in range(1, 2**bits)] for c in code], dtype=bool)
    return np.where(kept, rng.integers(1, 2**63, size=kept.shape, dtype=np.uint64) | np.uint64(1), np.uint64(0))


def _name_batches(batches: Iterator) -> Iterator:
    """(class, a, b), the distinctive words of both parties -> (class, keys): both orders, one key a table."""
    import pyarrow as pa

    weights = _name_masks()
    for batch in batches:
        classes, sides = batch.column(0), [batch.column(j).to_pylist() for j in (1, 2)]
        v = np.zeros((2, len(classes), 52), dtype=np.uint64)
        for i, words in enumerate(zip(*sides, strict=True)):
            for side, word in enumerate(words):
                for ch in word:
                    v[0, i, 26 * side + ord(ch) % 26] += np.uint64(1)
        v[1] = np.roll(v[0], 26, axis=1)
        keys = (_mixed(v @ weights) >> np.uint64(16)).astype(np.uint32).view(np.int32).transpose(1, 0, 2).reshape(len(classes), -1)
        offsets = np.arange(len(classes) + 1) * keys.shape[1]
        yield pa.RecordBatch.from_arrays([classes, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys.reshape(-1)))], names=["class", "keys"])


def _party_batches(batches: Iterator) -> Iterator:
    """(class, name) -> (class, name, a, b) of the names that give two parties."""
    import pyarrow as pa

    for batch in batches:
        rows = [(c, n, *(x[0] for x in two)) for c, n in zip(*(x.to_pylist() for x in batch.columns), strict=True) if (two := parties(n)) is not None]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.string()))], names=["class", "name", "a", "b"])


def _same_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        keep = [same_matter(parties(a), parties(b)) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
        yield batch.filter(pa.array(keep, pa.bool_()))


def similar_names(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """names(id, name) -> members (class, id) and links (class_a, class_b) between classes of the same spelling."""
    said = F.trim(F.regexp_replace(F.lower("name"), r"[\s.,]+", " "))
    rows = names.where("id is not null and name is not null").select(F.col("id").cast("long").alias("id"), said.alias("name"))
    rows = rows.select(F.xxhash64("name").alias("class"), "id", "name")
    spelt = cut(rows.select("class", "name").distinct().mapInArrow(_party_batches, "class long, name string, a string, b string"))
    keyed = spelt.select("class", "a", "b").mapInArrow(_name_batches, "class long, keys array<int>")
    tables = 2 ** (RADIUS + 1) - 1
    # both orders meet in the same table
    pairs = meeting(keyed, F.col("keys"), 2 * tables * spelt.count(), tables)
    both = pairs.join(spelt.select(*(F.col(c).alias(f"{c}_a") for c in spelt.columns)), "class_a").join(
        spelt.select(*(F.col(c).alias(f"{c}_b") for c in spelt.columns)), "class_b"
    )
    # a swap of neighbours is two plain edits, so nothing is lost here
    near, crossed = (F.levenshtein("a_a", x) + F.levenshtein("b_a", y) <= 4 for x, y in (("a_b", "b_b"), ("b_b", "a_b")))
    links = both.where(near | crossed).select("class_a", "class_b", "name_a", "name_b").mapInArrow(_same_batches, "class_a long, class_b long, name_a string, name_b string")
    # a name that gives no two parties is in no class
    members = rows.select("class", "id").join(spelt.select("class"), "class", "left_semi").distinct()
    return members, links.select("class_a", "class_b")
