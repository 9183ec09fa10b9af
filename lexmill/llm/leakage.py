"""Problem 9: evaluation texts leaking into training text.

Method: CGK random-walk embedding. A window of words is walked by random bits that depend on the step and the word, which
maps edit distance to Hamming distance; repeated bit-sampling LSH over the embeddings of item-sized windows proposes
pairs of a corpus window, of as many words more or fewer as there may be edits, and an item window; each is then verified
by exact edit distance in words.

The items are a stated query set: they go to the tasks in blocks of ``block`` items, whatever their number, and are held
against every window of every document. No document moves. A window is embedded only if so many of its words occur in
some item that the allowed edits could make up for the rest, which loses no pair. Windows that are alike have the same
embedding under the same bits, so they are found with certainty. The number of repetitions is that which finds a window
with its edits at the worst places with probability ``TARGET`` or more (``repeats_for``): each repetition draws bits and
samples of its own, so their misses are independent.

Defined cases: null and empty texts and items hold no passage; items and texts shorter than ``window`` words cannot leak;
a repeated document counts once; very long texts are read in full.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
TARGET = 0.95
SAMPLED = 6
#: of the walk, for each word of a window
STEPS = 2
#: windows held against the items at once
STARTS = 20_000
SCHEMA = "doc_id long, item_id int, edits int, n_windows int"


def words_of(text: str | None) -> list[str]:
    """Runs of a-z and digits in the lower-cased text."""
    return re.findall(r"[a-z0-9]+", text.lower()) if text else []


def edit_distance(a, b) -> int:
    """Levenshtein distance of two sequences."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _walked(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The embedding of a row of words in each trial: words are numbers from 0, the last one of ``bits`` stands for the end."""
    trials, steps, symbols = bits.shape
    at, out, rows = np.zeros(trials, dtype=np.int64), np.zeros((trials, steps), dtype=np.int64), np.arange(trials)
    padded = np.r_[words, symbols - 1]
    for j in range(steps):
        out[:, j] = padded[np.minimum(at, len(words))]
        at += bits[rows, j, out[:, j]]
    return out


@functools.cache
def repeats_for(target: float, edits: int, window: int = WINDOW, sampled: int = SAMPLED, trials: int = 1500, places: int = 24) -> int:
    """The repetitions that find a window with ``edits`` words replaced, inserted or left out with probability ``target``.

    Each kind of edit is tried at its places, all of them for one edit and ``places`` drawn for more; the worst counts.
    """
    if not edits:
        return 1
    rng = np.random.default_rng(19)
    steps, worst = STEPS * window, 1.0
    for kind in ("replaced", "inserted", "left out"):
        spots = [(i,) for i in range(window)] if edits == 1 else [tuple(sorted(rng.choice(window, edits, replace=False).tolist())) for _ in range(places)]
        for spot in spots:
            words = list(range(window))
            for n, i in enumerate(reversed(spot)):
                words[i : i + (kind != "inserted")] = [] if kind == "left out" else [window + n]
            bits = rng.integers(0, 2, size=(trials, steps, window + edits + 1), dtype=np.int8)
            same = _walked(np.arange(window), bits) == _walked(np.array(words), bits)
            chosen = np.argsort(rng.random((trials, steps)), axis=1)[:, :sampled]
            worst = min(worst, np.take_along_axis(same, chosen, 1).all(1).mean())
    return int(np.ceil(np.log(1 - target) / np.log(1 - worst)))


class ItemIndex:
    """The windows of a block of items under ``repeats`` bit samples of their embeddings."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW, repeats: int | None = None, sampled: int = SAMPLED, seed: int = 7, target: float = TARGET, edits: int = 1):
        repeats = repeats or repeats_for(target, edits, window, sampled)
        self.window, self.vocab = window, {}
        codes, owners = [], []
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            for i in range(len(ids) - window + 1):
                codes.append(ids[i : i + window])
                owners.append(item_id)
        self.codes, self.owners = np.array(codes, dtype=np.int32).reshape(-1, window), np.array(owners, dtype=np.int64)
        rng = np.random.default_rng(seed)
        # one more symbol each for words outside the items and for the end of the window
        # bits of its own for each repetition: where one walk parts two windows for good, the others needn't
        self.bits = rng.integers(0, 2, size=(repeats, STEPS * window, len(self.vocab) + 2), dtype=np.int8)
        self.samples = [np.sort(rng.choice(STEPS * window, size=sampled, replace=False)) for _ in range(repeats)]
        self.mix = rng.integers(1, 2**63, size=(repeats, sampled), dtype=np.int64) | 1
        flat = self.codes.reshape(-1)
        keys = [self.keys(flat, np.arange(len(self.codes)) * window, r) for r in range(repeats)]
        self.order = [np.argsort(k, kind="stable") for k in keys]
        self.sorted = [k[o] for k, o in zip(keys, self.order, strict=True)]

    def keys(self, words: np.ndarray, starts: np.ndarray, repeat: int, length: int | None = None) -> np.ndarray:
        """The bucket of each window of ``length`` of the ``words`` in a repetition."""
        end, at, outside = len(self.vocab) + 1, np.zeros(len(starts), dtype=np.int64), len(self.vocab)
        length, sample = length or self.window, self.samples[repeat].tolist()
        h, k = np.zeros(len(starts), dtype=np.int64), 0
        for j in range(sample[-1] + 1):
            sym = words[np.minimum(starts + at, len(words) - 1)] if len(words) else at
            sym = np.where(at >= length, end, np.where(sym < 0, outside, sym))
            if j == sample[k]:
                h = (h ^ (sym.astype(np.int64) + 1)) * self.mix[repeat, k]
                h ^= h >> 29
                k += 1
            at += self.bits[repeat, j][sym]
        return h

    def found(self, words: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, item, edits) of the windows of ``words`` (-1: in no item, -2: between documents) near an item's.

        The windows are of ``edits`` words fewer to ``edits`` more; a start counts once for an item's window.
        """
        none = np.zeros(0, dtype=np.int64)
        if not len(self.codes):
            return none, none, none
        places, costs = [none], [none]
        misses = np.concatenate([[0], np.cumsum(np.where(words == -2, self.window + edits + 1, words < 0))])
        for length in range(max(1, self.window - edits), self.window + edits + 1):
            if len(words) < length:
                break
            whole = np.flatnonzero(misses[length:] - misses[:-length] <= edits)
            for starts in np.split(whole, range(STARTS, len(whole), STARTS)):
                # windows that are alike meet in any repetition
                pairs = [self._met(self.keys(words, starts, r, length), r) for r in range(len(self.samples) if edits else 1)]
                pairs = np.unique(np.concatenate(pairs))
                mine, theirs = starts[pairs // len(self.codes)], pairs % len(self.codes)
                cost = self._cost(words[mine[:, None] + np.arange(length)], self.codes[theirs], edits)
                places.append((mine * len(self.codes) + theirs)[cost <= edits])
                costs.append(cost[cost <= edits])
        place, at = np.unique(np.concatenate(places), return_inverse=True)
        least = np.full(len(place), edits + 1)
        np.minimum.at(least, at, np.concatenate(costs))
        return place // len(self.codes), self.owners[place % len(self.codes)], least

    def _met(self, keys: np.ndarray, repeat: int) -> np.ndarray:
        """The pairs of a key's place and an item's window that share a bucket, as one number."""
        order, held = self.order[repeat], self.sorted[repeat]
        lo, hi = np.searchsorted(held, keys, "left"), np.searchsorted(held, keys, "right")
        many = hi - lo
        theirs = order[np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]
        return np.repeat(np.arange(len(keys)), many) * len(self.codes) + theirs

    @staticmethod
    def _cost(spans: np.ndarray, codes: np.ndarray, edits: int) -> np.ndarray:
        """The edit distance of each two rows up to ``edits``, or more than that."""
        n = min(spans.shape[1], codes.shape[1])
        head = (np.cumprod(spans[:, :n] == codes[:, :n], axis=1)).sum(1)
        tail = (np.cumprod(spans[:, ::-1][:, :n] == codes[:, ::-1][:, :n], axis=1)).sum(1)
        apart = max(spans.shape[1], codes.shape[1]) - n
        cost = np.full(len(spans), edits + 1)
        if apart == 0:
            cost[head == n] = 0
        if edits:
            # one edit leaves all the words but one before and after it
            cost[(cost > 1) & (head + tail >= n - (apart == 0)) & (apart <= 1)] = 1
        if edits > 1:
            for i in np.flatnonzero(cost > 1):
                cost[i] = edit_distance(spans[i].tolist(), codes[i].tolist())
        return cost


def leak_batches(batches: Iterator, index: ItemIndex, edits: int) -> Iterator:
    """Arrow batches (doc_id, text) -> rows of SCHEMA."""
    import pyarrow as pa

    get, split = index.vocab.get, re.compile(r"[a-z0-9]+").findall
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        codes, ends = [], []
        for text in batch.column(1).to_pylist():
            if text:
                codes.extend([get(w, -1) for w in split(text.lower())])
            codes.append(-2)
            ends.append(len(codes))
        start, item, cost = index.found(np.array(codes, dtype=np.int64), edits)
        doc = np.searchsorted(np.array(ends), start, "right")
        pair, at = np.unique(np.stack([doc, item]), axis=1, return_inverse=True)
        at = at.reshape(-1)
        least = np.full(pair.shape[1], edits + 1)
        np.minimum.at(least, at, cost)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[pair[0]], pa.int64()), pa.array(pair[1], pa.int32()), pa.array(least, pa.int32()), pa.array(np.bincount(at, minlength=pair.shape[1]), pa.int32())],
            names=["doc_id", "item_id", "edits", "n_windows"],
        )


def leaks(documents: DataFrame, items: DataFrame, edits: int = 1, window: int = WINDOW, block: int = 20_000, target: float = TARGET) -> DataFrame:
    """(doc_id, item_id, edits, n_windows): the documents that hold ``window`` words of an item with at most ``edits`` edits.

    edits is the least distance of any of the pair's windows, n_windows the number of window pairs found, by where they begin.
    """
    spark = documents.sparkSession
    held = items.select("item_id", "text").where("text is not null").distinct()
    n = held.count()
    blocks = max(1, -(-n // block))
    found = None
    for b in range(blocks):
        part = held.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else held
        index = spark.sparkContext.broadcast(ItemIndex(sorted(map(tuple, part.collect())), window, target=target, edits=edits))
        rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches, index=index: leak_batches(batches, index.value, edits), SCHEMA)
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("doc_id", "item_id").agg(F.min("edits").alias("edits"), F.max("n_windows").alias("n_windows"))
