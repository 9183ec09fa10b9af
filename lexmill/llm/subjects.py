"""Problem 10: the subject areas of each document.

Method: classifier chains over term, source and structure features. Each chain decides the subjects in the order of
their share of the document, each by a classifier of its own; a decision sees those before it, which they are and how often
the subjects occur together. The chain's probabilities are calibrated on held-out documents, and beam search finds the
likeliest combination of one or two labels.

Terms: words and pairs of neighbouring words get log-odds for each subject, learned from the labelled documents by a few
rounds of expectation-maximisation over their sentences, since a label names the document and not the sentence. A
sentence goes to its likeliest subject, and the shares of the sentences and words of each subject are the features of the
chain, with the number of sentences, the source's family, the document's kind and its language. Which families, kinds and
languages there are, and what words tell the languages, is learned from the labelled documents too.

The classifiers of the chain's links are drawn to one that is fitted on all links, the more so the fewer the cases.

The model is fitted on a sample of the labelled documents: in the order of the hash of doc_id, at most ``MOST_LABELLED`` and
as many as have ``MOST_CHARS`` characters together, whole texts each; everything else covers all documents. The model goes
to the tasks as one broadcast, and the sample bounds it: a term of it stands in two of the sample's documents or more.

Defined cases: null, empty and blank texts have no subject; any other text has one or two; labels of unknown documents,
null labels and repeated labels are ignored; without labels nothing can be learned, and no subject is given.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_LABELLED = 6_000
#: of the sample together
MOST_CHARS = 40_000_000
#: a family, kind or language has this share of the labelled documents; the others are one
LEVEL = 0.01
#: the commonest words, among which those are that tell a language
COMMON = 400
MARKS = 8
#: how strongly a link's classifier is drawn to that of all links
TIED = 20.0
BEAM = 8
MOST_LABELS = 2
SCHEMA = "doc_id long, subject string, share double, probability double"

_BROKEN = re.compile(r"(?<=\w)[-­‐¬]\r?\n(?=\w)")
_TOKEN = re.compile(r"[^\W_]+|[.;:?!](?=\s)|\n\n")
END = -2
ENDS = dict.fromkeys((".", ";", ":", "?", "!", "\n\n"), END)


def tokens_of(text: str) -> list[str]:
    """The words of a text in lower case, with its sentence ends among them. Words broken at line ends are mended."""
    text = text.lower()
    if any(h + "\n" in text or h + "\r" in text for h in "-­‐¬"):
        text = _BROKEN.sub("", text)
    return _TOKEN.findall(text)


class Sentences:
    """Word numbers of many texts in one array, cut into sentences and documents."""

    def __init__(self, texts: list[str], numbers: dict[str, int]):
        """Words without a number get -1."""
        get = numbers.get
        flat: list[int] = []
        ends = []
        for text in texts:
            flat += [get(t, -1) for t in tokens_of(text)]
            flat.append(END)
            ends.append(len(flat))
        ids = np.array(flat, dtype=np.int64)
        over = ids == END
        self.doc = np.searchsorted(np.array(ends), np.arange(len(ids)), "right")
        self.sentence = np.cumsum(over) - over
        self.owner = self.doc[over]  # the document of each sentence
        self.words = np.bincount(self.sentence[~over], minlength=len(self.owner))
        self.ids, self.n_docs = ids, len(texts)

    def pairs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, keys) of the pairs of neighbouring known words."""
        a, b = self.ids[:-1], self.ids[1:]
        at = np.flatnonzero((a >= 0) & (b >= 0))
        return at, a[at] * size + b[at]


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
    """Weights of a logistic classifier drawn to those of ``prior``."""
    w = prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + strength * (w - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class SubjectModel:
    """Term log-odds by subject, and the chain that decides from the shares."""

    def __init__(self, names: list[str]):
        self.names, self.index = names, {s: i for i, s in enumerate(names)}
        self.vocab: dict[str, int] = {}
        self.pair_keys = np.zeros(0, dtype=np.int64)
        self.weights = np.zeros((0, len(names)), dtype=np.float32)  # of the words, then of the pairs
        self.chain, self.joint, self.heat = np.zeros((0, 0)), np.zeros((len(names), len(names))), 1.0  # a row of the chain for each subject's link
        self.levels: tuple = ((), (), ())
        self.memo: dict = {}
        self.clear = 2.0  # what a sentence's terms must add up to

    # terms
    def languages(self, of_doc: np.ndarray, of_word: np.ndarray, n_docs: int, df: np.ndarray, given: list[str]) -> np.ndarray:
        """The language of each labelled text, by its common words; what is given may be wrong or missing."""
        names = self.levels[2]
        if len(names) < 2:
            return np.zeros(n_docs, dtype=int)
        common = np.argsort(-df, kind="stable")[:COMMON]
        place = np.full(len(df), -1)
        place[common] = np.arange(len(common))
        ok = place[of_word] >= 0
        held = np.zeros((n_docs, len(common)))
        held[of_doc[ok], place[of_word[ok]]] = 1
        at = np.array([names.index(x) if x in names else -1 for x in given])
        usual = Counter(x for x in at.tolist() if x >= 0).most_common(1)[0][0]
        for _ in range(2):  # learned from what is given, then from what was found
            rate = np.stack([(held[at == t].sum(0) + 0.5) / ((at == t).sum() + 1) for t in range(len(names))])
            share = np.zeros((n_docs, len(names)))
            for t in range(len(names)):
                # words of this language and of no other
                lead = rate[t] - np.delete(rate, t, axis=0).max(0)
                marks = np.argsort(-lead, kind="stable")[:MARKS]
                marks = marks[lead[marks] > 0.2]
                share[:, t] = held[:, marks].mean(1) if len(marks) else 0
            at = np.where(share.any(1), share.argmax(1), np.where(at < 0, usual, at))
        return at

    def gather(self, texts: list[str], labels: list[set[int]], metas: list[tuple]) -> None:
        """Number the words and pairs of the labelled texts, and find which stand in which sentence."""
        self.levels = tuple(tuple(v for v, n in sorted(Counter(m[j] for m in metas).items()) if n >= LEVEL * len(metas)) for j in range(3))
        often = max(sum(s in chosen for chosen in labels) for s in range(len(self.names))) / len(texts)
        # what stands in a quarter of a language's documents belongs to no subject, unless the subjects are few
        most = min(0.9, max(0.25, 2 * often))
        every: dict[str, int] = {}
        for text in texts:
            for t in tokens_of(text):
                if t not in ENDS:
                    every.setdefault(t, len(every))
        size = len(every)
        held = Sentences(texts, every | ENDS)
        at, keys = held.pairs(size)
        self.pair_keys, pair = np.unique(keys, return_inverse=True)
        word = np.flatnonzero(held.ids >= 0)
        term = np.concatenate([held.ids[word], size + pair.reshape(-1)])
        where = held.sentence[np.concatenate([word, at])]
        n_terms = size + len(self.pair_keys)
        once = np.unique(where * n_terms + term)
        term, where = once % n_terms, once // n_terms
        doc = held.owner[where]
        in_docs = np.unique(doc * n_terms + term)
        of_doc, of_term = in_docs // n_terms, in_docs % n_terms
        df = np.bincount(of_term, minlength=n_terms)
        words = of_term < size
        tongue = self.languages(of_doc[words], of_term[words], held.n_docs, df[:size], [m[2] for m in metas])
        self.n_tongues = max(1, len(self.levels[2]))
        keep = df >= 2
        for t in range(self.n_tongues):
            n = int((tongue == t).sum())
            keep &= np.bincount(of_term[tongue[of_doc] == t], minlength=n_terms) <= max(3, most * n)
        kept = np.flatnonzero(keep)
        place = np.full(n_terms, -1)
        place[kept] = np.arange(len(kept))
        ok = place[term] >= 0
        self._held, self._term, self._where, self._tongue = held, place[term[ok]], where[ok], tongue[held.owner]
        self._kept, self._size, self._every = kept, size, every

    def learn_terms(self, labels: list[set[int]], used: np.ndarray, rounds: int = 5) -> None:
        """Log-odds of each term by subject from the documents marked in ``used``."""
        k, held = len(self.names), self._held
        inside = used[held.owner]
        n_rows = len(held.owner)
        may = np.full((n_rows, k + 1), np.log(0.02))  # a sentence may stray from its document's labels
        allowed = np.zeros((held.n_docs, k), dtype=bool)
        for d, chosen in enumerate(labels):
            allowed[d, list(chosen)] = True
        may[:, :k][allowed[held.owner]] = 0
        may[:, k] = np.log(0.1)  # or be of no subject
        post = np.exp(may)
        post /= post.sum(1, keepdims=True)
        take = inside[self._where]
        term, where = self._term[take], self._where[take]
        lang, n_kept = self._tongue, len(self._kept)
        n = np.bincount(term, minlength=n_kept)[:, None]
        for _ in range(rounds):
            base = np.stack([(post[inside & (lang == t)].sum(0) + 1) / ((inside & (lang == t)).sum() + k + 1) for t in range(self.n_tongues)])
            counts, due = np.zeros((n_kept, k)), np.zeros((n_kept, k))
            for s in range(k):
                counts[:, s] = np.bincount(term, weights=post[where, s], minlength=n_kept)
                due[:, s] = np.bincount(term, weights=base[lang[where], s], minlength=n_kept)
            rate = due / np.maximum(n, 1)
            # how much likelier the subject is, given the term, than in the term's language; rare terms are drawn to 1
            weights = np.clip(np.log((counts + rate + 1e-9) / (due + rate + 1e-9)), -1.5, 5)
            # the most that a term can say for the commonest subject; with few subjects it is little
            can = -np.log(min(0.9, (post[inside].sum(0)[:k] + 1).max() / (inside.sum() + k + 1)))
            self.clear = min(2.0, 0.9 * can)
            self._weights = (weights * ((weights.max(1, keepdims=True) > min(0.8, 0.4 * can)) & (n >= 2))).astype(np.float32)
            full = np.concatenate([self._sums(n_rows, where, self._weights, term), np.full((n_rows, 1), 1.0)], 1) + may
            full -= full.max(1, keepdims=True)
            post = np.exp(full)
            post /= post.sum(1, keepdims=True)

    def settle(self) -> None:
        """Keep the terms that tell, for labelling, and let the labelled texts go."""
        told = self._kept[self._weights.any(1)]
        words, pairs = told[told < self._size], told[told >= self._size] - self._size
        keys = self.pair_keys[pairs]
        needed = np.unique(np.concatenate([words, keys // self._size, keys % self._size]))
        renumber = np.full(self._size, -1)
        renumber[needed] = np.arange(len(needed))
        self.vocab = {t: int(renumber[i]) for t, i in self._every.items() if i >= 0 and renumber[i] >= 0} | ENDS
        row = dict(zip(told.tolist(), np.flatnonzero(self._weights.any(1)).tolist(), strict=True))
        self.n_words = len(needed)
        by_word = np.zeros((len(needed), len(self.names)), dtype=np.float32)
        for i in words:
            by_word[renumber[i]] = self._weights[row[int(i)]]
        fresh = renumber[keys // self._size] * len(needed) + renumber[keys % self._size]
        order = np.argsort(fresh)
        self.pair_keys = fresh[order]
        by_pair = self._weights[[row[int(i) + self._size] for i in pairs[order]]] if len(pairs) else by_word[:0]
        self.weights = np.concatenate([by_word, by_pair])
        for name in ("_held", "_term", "_where", "_tongue", "_kept", "_size", "_every", "_weights"):
            delattr(self, name)

    def _sums(self, n_rows: int, where: np.ndarray, weights: np.ndarray, term: np.ndarray) -> np.ndarray:
        some = weights.any(1)[term]
        where, term = where[some], term[some]
        return np.stack([np.bincount(where, weights=weights[term, s], minlength=n_rows) for s in range(len(self.names))], 1)

    def shares(self, held: Sentences, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each document: the share of each subject (by words, by sentences), and its sentences with a subject."""
        best, clear = score.argmax(1), score.max(1) >= self.clear
        out = np.zeros((held.n_docs, 2, len(self.names)))
        np.add.at(out, (held.owner[clear], 0, best[clear]), held.words[clear])
        np.add.at(out, (held.owner[clear], 1, best[clear]), 1)
        told = np.bincount(held.owner[clear], minlength=held.n_docs)
        whole = np.zeros((held.n_docs, len(self.names)))
        np.add.at(whole, held.owner, score)
        vague = np.flatnonzero((told == 0) & whole.any(1))  # nothing clear: the whole text by all its terms
        out[vague, :, whole[vague].argmax(1)] = 1
        total = out.sum(2, keepdims=True)
        return np.divide(out, total, out=np.zeros_like(out), where=total > 0), told

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``shares`` of new texts."""
        held = Sentences(texts, self.vocab)
        at, keys = held.pairs(self.n_words)
        place = np.minimum(np.searchsorted(self.pair_keys, keys), max(0, len(self.pair_keys) - 1))
        hit = self.pair_keys[place] == keys if len(self.pair_keys) else np.zeros(len(keys), dtype=bool)
        word = np.flatnonzero(held.ids >= 0)
        term = np.concatenate([held.ids[word], self.n_words + place[hit]])
        where = held.sentence[np.concatenate([word, at[hit]])]
        return self.shares(held, self._sums(len(held.owner), where, self.weights, term))

    # the chain
    def features(self, share: np.ndarray, told: int, subject: int, chosen: tuple[int, ...], meta: tuple) -> list[float]:
        by_words, by_sents = share[0, subject], share[1, subject]
        mean = (by_words + by_sents) / 2
        top = max((share[0] + share[1]).max() / 2, 1e-9)
        together = max((self.joint[c, subject] for c in chosen), default=0.0)
        few = 1.0 / (1 + told)
        f = [1.0, mean, by_words - by_sents, *(max(0.0, mean - c) for c in (0.05, 0.1, 0.15, 0.2, 0.25, 0.35)), mean / top, float(mean >= top - 1e-9), float(mean > 0), few, few * mean, mean * told / 10]
        f += [float(len(chosen)), together, *(float(value == x) for value, names in zip(meta, self.levels, strict=True) for x in names)]
        return f + [float(i in chosen) for i in range(len(self.names))] + [float(subject == i) for i in range(len(self.names))]

    def learn_chain(self, rows: list[tuple[np.ndarray, int, tuple, set[int]]], held: list) -> None:
        k = len(self.names)
        n = np.zeros((k, k))
        one = np.zeros(k)
        for *_, labels in rows:
            for a in labels:
                one[a] += 1
                for b in labels - {a}:
                    n[a, b] += 1
        total = max(1, len(rows))
        self.joint = np.log((n + 0.5) * total / (np.outer(one, one) + 0.5 * total))
        self.joint = np.clip(self.joint, -2, 2)
        def links(some: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            x, y, of = [], [], []
            for share, told, meta, labels in some:
                chosen: tuple[int, ...] = ()
                for s in self.order(share):
                    x.append(self.features(share, told, s, chosen, meta))
                    y.append(float(s in labels))
                    of.append(s)
                    if s in labels:
                        chosen += (s,)
            return np.array(x), np.array(y), np.array(of)

        x, y, of = links(rows)
        shared = _logistic(x, y, np.zeros(x.shape[1]), 1.0)
        self.chain = np.stack([_logistic(x[of == s], y[of == s], shared, TIED) if (of == s).any() else shared for s in range(k)])
        # one temperature, that of the least loss on documents not fitted on
        if held:
            x, t, of = links(held)
            z = np.einsum("nf,nf->n", x, self.chain[of])
            loss = {h: float(np.mean(np.logaddexp(0, np.where(t > 0, -z, z) / h))) for h in np.linspace(0.5, 3, 26)}
            self.heat = min(loss, key=loss.get)

    def order(self, share: np.ndarray) -> list[int]:
        """The subjects of the chain: those with any share, the largest first; at least the first three."""
        s = share.sum(0)
        ranked = sorted(range(len(self.names)), key=lambda i: (-s[i], i))
        return [i for n, i in enumerate(ranked) if s[i] > 0 or n < 3]

    def decode(self, share: np.ndarray, told: int, meta: tuple) -> tuple[tuple[int, ...], float]:
        """The likeliest combination of 1 to MOST_LABELS subjects, by beam search along the chain."""
        beams = [(0.0, ())]
        for s in self.order(share):
            grown = []
            for score, chosen in beams:
                z = float(np.dot(self.chain[s], self.features(share, told, s, chosen, meta))) / self.heat
                grown.append((score - np.logaddexp(0, z), chosen))
                if len(chosen) < MOST_LABELS:
                    grown.append((score - np.logaddexp(0, -z), (*chosen, s)))
            grown.sort(key=lambda g: (-g[0], g[1]))
            beams = grown[:BEAM]
        some = [b for b in beams if b[1]] or [(0.0, (self.order(share)[0],))]
        return some[0][1], float(np.exp(min(0.0, some[0][0])))

    def labels(self, texts: list[str | None], metas: list[tuple], block: int = 2000) -> list[list[tuple[str, float, float]]]:
        """(subject, share, probability) of each text, none for texts without words."""
        out: list[list] = [[] for _ in texts]
        if not self.names or not len(self.chain):
            return out
        every = [i for i, t in enumerate(texts) if t is not None and t.strip()]
        for b in range(0, len(every), block):
            at = every[b : b + block]
            shares, told = self.read([texts[i] for i in at])
            for i, share, n in zip(at, shares, told.tolist(), strict=True):
                key = (share.tobytes(), n, metas[i])
                if key not in self.memo:
                    if len(self.memo) > 100_000:
                        self.memo.clear()
                    self.memo[key] = self.decode(share, n, metas[i])
                chosen, p = self.memo[key]
                out[i] = [(self.names[s], float(share[0, s]), p) for s in chosen]
        return out


def meta_of(source: str | None, kind: str | None, lang: str | None) -> tuple:
    return ((source or "").split("-")[0].lower(), (kind or "").lower(), (lang or "en").lower()[:2])


def fit(rows: list[tuple], names: list[str]) -> SubjectModel:
    """A model from (doc_id, text, source, doc_type, lang, subjects) of labelled documents."""
    model = SubjectModel(names)
    texts, metas, labels = [], [], []
    for _, text, source, kind, lang, subjects in sorted(rows, key=lambda r: r[0]):
        chosen = {model.index[s] for s in subjects if s in model.index}
        if chosen and text and text.strip():
            texts.append(text)
            metas.append(meta_of(source, kind, lang))
            labels.append(chosen)
    if not texts:
        return model
    model.gather(texts, labels, metas)
    # the chain learns from shares by terms learned on other documents, else it trusts them too much
    folds, at, held = 3, np.arange(len(texts)), model._held
    share, told = np.zeros((len(texts), 2, len(names))), np.zeros(len(texts), dtype=int)
    for f in range(folds):
        model.learn_terms(labels, at % folds != f)
        s, n = model.shares(held, model._sums(len(held.owner), model._where, model._weights, model._term))
        share[at % folds == f], told[at % folds == f] = s[at % folds == f], n[at % folds == f]
    seen = [(share[i], int(told[i]), metas[i], labels[i]) for i in at]
    model.learn_chain([r for i, r in enumerate(seen) if i % 5], [r for i, r in enumerate(seen) if i % 5 == 0])
    model.learn_terms(labels, np.ones(len(texts), dtype=bool))
    model.settle()
    return model


def label_batches(batches: Iterator, model: SubjectModel) -> Iterator:
    """Arrow batches (doc_id, text, source, doc_type, lang) -> rows of SCHEMA."""
    import pyarrow as pa

    for batch in batches:
        out: tuple[list, list, list, list] = ([], [], [], [])
        ids, texts, *rest = (c.to_pylist() for c in batch.columns)
        for doc_id, found in zip(ids, model.labels(texts, [meta_of(*m) for m in zip(*rest, strict=True)]), strict=True):
            for subject, share, p in found:
                for column, value in zip(out, (doc_id, subject, share, p), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.string(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "subject", "share", "probability"])


def labelled(documents: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, most_chars: int = MOST_CHARS) -> list[tuple]:
    """The sample of labelled documents: by hash of doc_id, at most ``most``, while their texts have ``most_chars`` together; one at least."""
    by_doc = labels.where("doc_id is not null and subject is not null").groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("subjects"))
    texts = documents.where("doc_id is not null and text is not null")
    sizes = texts.select("doc_id", F.length("text").alias("n")).join(by_doc.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.max("n").alias("n"))
    chosen, total = [], 0
    for r in sizes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect():
        total += r.n
        if chosen and total > most_chars:
            break
        chosen.append((r.doc_id,))
    if not chosen:
        return []
    ids = F.broadcast(documents.sparkSession.createDataFrame(chosen, "doc_id long"))  # at most ``most`` ids
    rows = texts.select("doc_id", "text", "source", "doc_type", "lang").join(ids, "doc_id").join(by_doc, "doc_id").dropDuplicates(["doc_id"]).collect()
    return [(r.doc_id, r.text, r.source, r.doc_type, r.lang, r.subjects) for r in rows]


def subject_areas(documents: DataFrame, labels: DataFrame, subjects: DataFrame, most_labelled: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, subject, share, probability): one or two subjects of each document with any text."""
    names = sorted(r.subject for r in subjects.select("subject").where("subject is not null").distinct().collect())
    spark = documents.sparkSession
    model = spark.sparkContext.broadcast(fit(labelled(documents, labels, most_labelled), names))
    rows = documents.select(F.col("doc_id").cast("long"), "text", "source", "doc_type", "lang")
    return rows.mapInArrow(lambda batches: label_batches(batches, model.value), SCHEMA)
