"""Problem 5: the most similar vectors for every vector.

Method: a robust-pruned directed graph in each shard. Points enter in batches; a greedy beam search over the graph so far
proposes neighbours, relaxed distance pruning keeps diverse edges, and edges are added back. Queries are answered by beam
search in each shard they are sent to.

Shards: vectors go to the nearest of the pivots, a sample of one vector in ``shard`` (``MOST_PIVOTS`` at most) chosen by
hash of the id, which a tree of two levels finds; a pivot with many is spread over several shards by hash. Every vector
is indexed. A query visits the ``visits`` shards whose borders it stands nearest to, however many there are, so the work
grows as the input does. A pair is found if either end visits the other's shard, since both are told. ``reach`` leaves
out visits over borders too far for a pair of the cosine asked for: x near q can lie beyond the border of pivots i and j
only if q . (p_i - p_j) / |p_i - p_j| is at most the sine of the angle between them, and in d dimensions that part of their
distance is about the sine over the root of d. Without ``visits`` and ``reach``, all shards are asked, however many; the
tree then finds homes only, and the vectors are sent in pieces, so a task never holds their pairs with all the pivots.

A task has one shard's points and at most some ``MOST_VISITORS`` times as many visitors: a shard that more visit is built
several times, each for a part of them. Vectors that are equal in all numbers are one point of the graph, dropped where
they are read and again in the shard, and their ids are put back at the end. No vector is stored or sent but to its shards.

Defined cases: null, all-zero and not finite vectors and those of another dimension take no part; repeated rows count
once; ties in cosine go to the smaller id; fewer than k others give fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.lineage import cut, sized

SHARD = 2500
MOST_PIVOTS = 131_072
#: of as many pivots or more, the nearest are found by a tree
TREE = 512
MOST_VISITORS = 8
#: cosines of vectors and pivots held at once, where all pivots are looked at
MOST_CELLS = 500_000
#: visitors sent at once, where all shards are asked
MOST_SENT = 50_000
DEGREE = 14
BEAM = 20
ALPHA = 1.2
ENTRIES = 64


class Graph:
    """A directed graph over unit vectors, built and searched many points at a time."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, batch: int = 512, seed: int = 3):
        self.x, self.degree, self.beam, self.alpha = np.ascontiguousarray(x, dtype=np.float32), degree, beam, alpha
        n = len(x)
        # row n stands for no neighbour
        self.edges = np.full((n + 1, degree), n, dtype=np.int32)
        self.padded = np.vstack([self.x, np.zeros((1, x.shape[1]), dtype=np.float32)])
        order = np.random.default_rng(seed).permutation(n)
        done = min(n, 256)
        first = order[:done]
        self.entries = first[:ENTRIES]
        if n > 1:
            self._link(first, self._nearest(first, first))
        while done < n:
            new = order[done : done + min(batch, done)]
            found, _ = self.search(self.x[new], self.beam)
            self._link(new, np.concatenate([found, self._nearest(new, new)], axis=1))
            done += len(new)

    def _nearest(self, of: np.ndarray, among: np.ndarray) -> np.ndarray:
        """The nearest points of one batch to each other."""
        sims = self.x[of] @ self.x[among].T
        sims[of[:, None] == among[None, :]] = -2
        k = min(self.degree, len(among) - 1)
        return among[np.argpartition(-sims, k - 1, axis=1)[:, :k]] if k > 0 else np.full((len(of), 1), len(self.x))

    def _prune(self, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Robust pruning: the nearest candidate stays, those that are ``alpha`` times nearer to it than to the point go."""
        n = len(self.x)
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = n
        candidates[candidates == of[:, None]] = n
        v = self.padded[candidates]
        near = 1 - np.einsum("bcd,bd->bc", v, self.padded[of])
        near[candidates == n] = np.inf
        far = 1 - v @ v.transpose(0, 2, 1)
        alive, rows = candidates < n, np.arange(len(of))
        out = np.full((len(of), self.degree), n, dtype=np.int32)
        for r in range(self.degree):
            if not alive.any():
                break
            pick = np.where(alive, near, np.inf).argmin(1)
            some = alive[rows, pick]
            out[some, r] = candidates[rows[some], pick[some]]
            alive &= (self.alpha * far[rows, pick] > near) & some[:, None]
            alive[rows, pick] = False
        return out

    def _link(self, new: np.ndarray, candidates: np.ndarray) -> None:
        """Edges of new points, and edges back to them."""
        n = len(self.x)
        kept = self._prune(new, candidates.astype(np.int64))
        old = self.edges[new]
        self.edges[new] = kept if (old == n).all() else self._prune(new, np.concatenate([kept, old], axis=1).astype(np.int64))
        source, target = np.repeat(new, self.degree), self.edges[new].reshape(-1)
        real = target < n
        order = np.argsort(target[real], kind="stable")
        source, target = source[real][order], target[real][order]
        if not len(target):
            return
        hit, start, count = np.unique(target, return_index=True, return_counts=True)
        width = min(int(count.max()), 2 * self.degree)
        place = np.arange(len(target)) - np.repeat(start, count)
        back = np.full((len(hit), width), n, dtype=np.int64)
        ok = place < width
        back[np.repeat(np.arange(len(hit)), count)[ok], place[ok]] = source[ok]
        have = self.edges[hit].astype(np.int64)
        # room first; only full rows are pruned
        free = (have == n).sum(1)
        fits = (back < n).sum(1) <= free
        both = np.concatenate([have, back], axis=1)
        if fits.any():
            row = np.sort(both[fits], axis=1)
            self.edges[hit[fits]] = row[:, : self.degree]
        if (~fits).any():
            self.edges[hit[~fits]] = self._prune(hit[~fits], both[~fits])

    def search(self, queries: np.ndarray, beam: int, start: np.ndarray | None = None, expand: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """(points, cosines) of the beam after a greedy search, best first; start: a known point near each query."""
        n, b = len(self.x), len(queries)
        queries = np.ascontiguousarray(queries, dtype=np.float32)
        seen = np.zeros((b, n + 1), dtype=bool)
        seen[:, n] = True
        rows = np.arange(b)[:, None]
        first = queries @ self.padded[self.entries].T
        k = min(4, first.shape[1])
        ids = self.entries[np.argpartition(-first, k - 1, axis=1)[:, :k]]
        if start is not None:
            ids = np.concatenate([ids, start[:, None]], axis=1)
            ids[:, :-1][ids[:, :-1] == start[:, None]] = n
        sims = np.einsum("bkd,bd->bk", self.padded[ids], queries)
        sims[ids == n] = -2
        seen[rows, ids] = True
        pad = max(0, beam - ids.shape[1])
        ids = np.concatenate([ids, np.full((b, pad), n)], axis=1)
        sims = np.concatenate([sims, np.full((b, pad), -2, dtype=np.float32)], axis=1)
        opened = ids == n
        active = np.arange(b)
        for _ in range(4 * beam):
            waiting = np.where(opened[active], -3, sims[active])
            pick = np.argpartition(-waiting, expand - 1, axis=1)[:, :expand]
            real = np.take_along_axis(waiting, pick, 1) > -2.5
            some = real.any(1)
            active, pick, real = active[some], pick[some], real[some]
            if not len(active):
                break
            a = active[:, None]
            from_ = np.where(real, ids[a, pick], n)
            opened[a, pick] = True
            near = self.edges[from_].reshape(len(active), -1).astype(np.int64)
            fresh = ~seen[a, near]
            near = np.where(fresh, near, n)
            seen[a, near] = True
            s = np.einsum("bkd,bd->bk", self.padded[near], queries[active])
            s[near == n] = -2
            if expand > 1:  # one point may be a neighbour of two that were opened together
                order = np.argsort(near, axis=1)
                sorted_ = np.take_along_axis(near, order, 1)
                twice = np.zeros_like(fresh)
                np.put_along_axis(twice, order[:, 1:], (sorted_[:, 1:] == sorted_[:, :-1]), 1)
                s[twice] = -2
                near[twice] = n
            every_s = np.concatenate([sims[active], s], axis=1)
            every_i = np.concatenate([ids[active], near], axis=1)
            every_o = np.concatenate([opened[active], near == n], axis=1)
            top = np.argpartition(-every_s, beam - 1, axis=1)[:, :beam]
            sims[active], ids[active], opened[active] = (np.take_along_axis(z, top, 1) for z in (every_s, every_i, every_o))
        best = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)


def unit(rows: np.ndarray) -> np.ndarray:
    x = rows.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _unpack(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float32).reshape(-1, dim)


#: a search for cosines of ``least`` or more goes on in full only where a narrow one came as near to it
NARROW = 6
NEARING = 0.3


def _searched(g: Graph, queries: np.ndarray, beam: int, start: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(place of the query, point) of the beam after a search of each query."""
    rows = np.arange(len(queries))
    if least > -1 and beam > NARROW:
        at, sims = g.search(queries, NARROW, start)
        sims = np.where((at == start[:, None]) if start is not None else False, -2, sims)
        rows = np.flatnonzero(sims.max(1) >= least - NEARING)
        queries, start = queries[rows], None if start is None else start[rows]
    if not len(rows):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at, _ = g.search(queries, beam, start)
    real = at < len(g.x)
    return np.repeat(rows, at.shape[1])[real.reshape(-1)], at[real]


Points = tuple[np.ndarray, np.ndarray, np.ndarray]


def answer_shard(points: Points, visitors: Points, k: int, beam: int, degree: int = DEGREE, block: int = 2048, residents: bool = True, least: float = -2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, point id, cosine): up to k points of a shard for its own points and for the queries sent to it.

    points and visitors are (ids, digests, vectors); a query is no neighbour of a point of its own digest.
    """
    ids, digests, x = points
    g = Graph(x, degree, max(beam, 12))
    out = ([], [], [])
    own = tuple(c if residents else c[:0] for c in points)
    for (qs, marks, v), here in ((own, True), (visitors, False)):
        for b in range(0, len(qs), block):
            start = np.arange(b, min(b + block, len(qs))) if here else None
            q, p = _searched(g, v[b : b + block], max(beam, k + 1), start, least)
            q = q + b
            other = digests[p] != marks[q]
            q, p = q[other], p[other]
            cosine = np.einsum("nd,nd->n", v[q].astype(np.float64), x[p].astype(np.float64))
            order = np.lexsort((ids[p], -cosine, q))
            q, p, cosine = q[order], p[order], cosine[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = (place < k) & (cosine >= least)
            for column, value in zip(out, (qs[q[keep]], ids[p[keep]], cosine[keep]), strict=True):
                column.append(value)
    return tuple(np.concatenate(c) if c else np.zeros(0, dtype=t) for c, t in zip(out, (np.int64, np.int64, np.float64), strict=True))


class Router:
    """Finds the pivots whose shards a vector visits."""

    def __init__(self, pivots: np.ndarray):
        self.pivots, n = pivots, len(pivots)
        self.children = None
        if n >= TREE:
            self.roots = pivots[: int(np.ceil(np.sqrt(n)))]
            at = np.concatenate([(pivots[b : b + 4096] @ self.roots.T).argmax(1) for b in range(0, n, 4096)])
            order = np.argsort(at, kind="stable")
            self.children = np.split(order, np.searchsorted(at[order], np.arange(1, len(self.roots))))

    def nearest(self, x: np.ndarray, most: int, branches: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """(pivots, cosines) of the ``most`` nearest of each row, best first; -1 where the tree gives fewer."""
        n = len(self.pivots)
        if self.children is None or n <= most or not len(x):  # the branches of a tree don't hold all pivots
            sims = x @ self.pivots.T
            k = min(most, n)
            top = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(x), 1))
            best = np.take_along_axis(sims, top, 1)
        else:
            sims = x @ self.roots.T
            k = min(branches, sims.shape[1])
            rows, far = np.arange(len(x)), np.argpartition(-sims, k - 1, axis=1)[:, :k]
            owner, pivot, cosine = [], [], []
            for j in np.unique(far):
                mine, kids = rows[(far == j).any(1)], self.children[j]
                if not len(kids):
                    continue
                s = x[mine] @ self.pivots[kids].T
                m = min(most, len(kids))
                t = np.argpartition(-s, m - 1, axis=1)[:, :m]
                owner.append(np.repeat(mine, m))
                pivot.append(kids[t].reshape(-1))
                cosine.append(np.take_along_axis(s, t, 1).reshape(-1))
            owner, pivot, cosine = np.concatenate(owner), np.concatenate(pivot), np.concatenate(cosine)
            order = np.lexsort((-cosine, owner))
            owner, pivot, cosine = owner[order], pivot[order], cosine[order]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            ok = place < most
            top, best = np.full((len(x), most), -1), np.full((len(x), most), -2.0, dtype=np.float32)
            top[owner[ok], place[ok]], best[owner[ok], place[ok]] = pivot[ok], cosine[ok]
        order = np.argsort(-best, axis=1, kind="stable")
        return np.take_along_axis(top, order, 1), np.take_along_axis(best, order, 1)

    def visits(self, x: np.ndarray, visits: int | None, reach: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home of each row, rows that visit another pivot, that pivot)."""
        most = len(self.pivots) if visits is None else min(len(self.pivots), 2 * visits)
        rows = max(1, MOST_CELLS // most)
        if visits is None and len(x) > rows:
            parts = [self.visits(x[b : b + rows], None, reach) for b in range(0, len(x), rows)]
            return tuple(np.concatenate(c) for c in zip(*((home, q + i * rows, j) for i, (home, q, j) in enumerate(parts)), strict=True))
        at, sims = self.nearest(x, most)
        home = at[:, 0]
        gaps = self.pivots[home][:, None] - self.pivots[at] if most * len(x) < 2_000_000 else None
        apart = np.linalg.norm(gaps, axis=2) if gaps is not None else np.sqrt(np.maximum(0, 2 - 2 * (self.pivots[home] @ self.pivots.T)))[np.arange(len(x))[:, None], at]
        margin = (sims[:, :1] - sims) / np.maximum(apart, 1e-6)
        margin[at < 0] = np.inf
        margin[:, 0] = -1  # home
        if visits is not None:
            place = margin.argsort(1, kind="stable").argsort(1, kind="stable")
            margin[place >= visits] = np.inf
        margin[:, 0] = np.inf
        q, j = np.nonzero(margin <= (1e9 if reach is None else reach))
        return home, q, at[q, j]

    def homes(self, x: np.ndarray) -> np.ndarray:
        return self.nearest(x, 1)[0][:, 0]

    def every(self, rows: np.ndarray, home: np.ndarray, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, pivot) of the rows with every pivot, with their homes too or without, in pieces."""
        n = len(self.pivots)
        block = max(1, MOST_SENT // n)
        for b in range(0, len(rows), block):
            q = np.repeat(rows[b : b + block], n)
            j = np.tile(np.arange(n), len(q) // n)
            yield (q, j) if own else (q[j != home[q]], j[j != home[q]])


def _batch_vectors(batch, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, digests, unit vectors) of the finite vectors of an Arrow batch (id, embedding) that are not all zero."""
    import xxhash

    raw = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), dtype=np.float32)
    fine = np.isfinite(raw).all(1) & raw.any(1)  # a null among the numbers is not finite here
    ids, raw = batch.column(0).to_numpy(zero_copy_only=False)[fine], raw[fine]
    digests = np.array([xxhash.xxh3_64_intdigest(r.tobytes()) for r in raw], dtype=np.uint64).view(np.int64)
    return ids, digests, unit(raw).astype(np.float32) if len(ids) else raw


class _Seen:
    """Drops the vectors that came before in this task; it forgets when it is full, which only sends some again."""

    def __init__(self, most: int = 1_000_000):
        self.held: set = set()
        self.most = most

    def fresh(self, digests: np.ndarray) -> np.ndarray:
        _, first = np.unique(digests, return_index=True)
        some = np.zeros(len(digests), dtype=bool)
        some[first] = [d not in self.held for d in digests[first].tolist()]
        if len(self.held) > self.most:
            self.held.clear()
        self.held.update(digests[some].tolist())
        return some


def _count_batches(batches: Iterator, router: Router, visits: int | None, reach: float | None, dim: int, asked: int) -> Iterator:
    """(pivot, points, visitors) of this task."""
    import pyarrow as pa

    seen, points, visitors = _Seen(), np.zeros(len(router.pivots), dtype=np.int64), np.zeros(len(router.pivots), dtype=np.int64)
    for batch in batches:
        ids, digests, x = _batch_vectors(batch, dim)
        some = seen.fresh(digests)
        asks = (ids[some] % asked == 0) if asked > 1 else np.ones(int(some.sum()), dtype=bool)
        if visits is None and reach is None:
            home = router.homes(x[some])
            points += np.bincount(home, minlength=len(points))
            visitors += int(asks.sum()) - (np.bincount(home, minlength=len(points)) if asked == 1 else 0)
            continue
        home, q, j = router.visits(x[some], visits, reach)
        points += np.bincount(home, minlength=len(points))
        visitors += np.bincount(j[asks[q]], minlength=len(points)) + (np.bincount(home[asks], minlength=len(points)) if asked > 1 else 0)
    at = np.flatnonzero(points + visitors)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(points[at], pa.int64()), pa.array(visitors[at], pa.int64())], names=["pivot", "points", "visitors"])


class Shards:
    """The numbers of the tasks: each pivot has ``spread`` shards, each shard ``parts`` tasks with parts of its visitors."""

    def __init__(self, n_pivots: int, counts: list, shard: int):
        self.spread, self.parts = np.ones(n_pivots, dtype=np.int64), np.ones(n_pivots, dtype=np.int64)
        for r in counts:
            self.spread[r.pivot] = max(1, -(-r.points // (2 * shard)))
            self.parts[r.pivot] = max(1, -(-r.visitors // (MOST_VISITORS * shard)))
        self.first = np.concatenate([[0], np.cumsum(self.spread * self.parts)])
        self.n = int(self.first[-1])

    def answers_own(self, task: int) -> bool:
        """Whether a task is the first of its shard."""
        pivot = int(np.searchsorted(self.first, task, "right")) - 1
        return bool((task - self.first[pivot]) % self.parts[pivot] == 0)

    def of_points(self, home: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, task): a point is in all tasks of its shard."""
        n = self.parts[home]
        shard = (digests.view(np.uint64) % self.spread[home].astype(np.uint64)).astype(np.int64)
        rows = np.repeat(np.arange(len(home)), n)
        part = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        return rows, (self.first[home] + shard * n)[rows] + part

    def of_visitors(self, q: np.ndarray, pivot: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, task): a visitor goes to one task of each shard of the pivot."""
        n = self.spread[pivot]
        rows = np.repeat(np.arange(len(q)), n)
        shard = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
        part = ((digests[q].view(np.uint64) >> np.uint64(20)) % self.parts[pivot].astype(np.uint64)).astype(np.int64)
        return q[rows], self.first[pivot[rows]] + shard * self.parts[pivot[rows]] + part[rows]


def _route_batches(batches: Iterator, router: Router, shards: Shards, visits: int | None, reach: float | None, dim: int, asked: int) -> Iterator:
    """(id, embedding) -> (task, id, kind, digest, vector): kind 0 a point in its own shard, 1 a query."""
    import pyarrow as pa

    seen, seen_asking = _Seen(), _Seen()
    for batch in batches:
        ids, digests, x = _batch_vectors(batch, dim)
        some = np.flatnonzero(seen.fresh(digests))
        if asked > 1:  # few ask: a shard answers those sent to it only, its own among them
            asks = ids % asked == 0
            asks[asks] = seen_asking.fresh(digests[asks])
        else:
            asks = np.isin(np.arange(len(ids)), some)
        if visits is None and reach is None:
            home = router.homes(x)
            met = router.every(np.flatnonzero(asks), home, asked > 1)
        else:
            home, q, j = router.visits(x, visits, reach)
            if asked > 1:
                q, j = np.concatenate([q, np.arange(len(ids))]), np.concatenate([j, home])
            met = iter([(q[asks[q]], j[asks[q]])])
        packed = [v.tobytes() for v in x]

        def sent(rows: np.ndarray, tasks: np.ndarray, kind: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(tasks, pa.int32()), pa.array(ids[rows], pa.int64()), pa.array(np.full(len(rows), kind), pa.int32()), pa.array(digests[rows], pa.int64()), pa.array([packed[i] for i in rows], pa.binary())],  # noqa: B023
                names=["task", "id", "kind", "digest", "vector"],
            )

        rows, to = shards.of_points(home[some], digests[some])
        yield sent(some[rows], to, 0)
        for q, j in met:
            yield sent(*shards.of_visitors(q, j, digests), 1)
        # its own shard's other tasks and shards of its pivot hold points that a point has not met
        near = np.flatnonzero(shards.spread[home] > 1) if asked == 1 else np.zeros(0, dtype=np.int64)
        near = near[asks[near]]
        kin, beside = shards.of_visitors(near, home[near], digests)
        own = shards.first[home[kin]] + (digests[kin].view(np.uint64) % shards.spread[home[kin]].astype(np.uint64)).astype(np.int64) * shards.parts[home[kin]]
        foreign = (beside < own) | (beside >= own + shards.parts[home[kin]])
        yield sent(kin[foreign], beside[foreign], 1)


def _distinct(ids: np.ndarray, digests: np.ndarray, x: np.ndarray) -> Points:
    """One row a digest, with its least id."""
    order = np.lexsort((ids, digests))
    first = order[np.r_[True, digests[order][1:] != digests[order][:-1]]] if len(order) else order
    first = first[np.argsort(ids[first])]
    return ids[first], digests[first], x[first]


def nearest_vectors(
    vectors: DataFrame, k: int = 5, dim: int = 64, visits: int | None = None, reach: float | None = None, beam: int = BEAM, degree: int = DEGREE, shard: int = SHARD, asked: int = 1, least: float = -2.0
) -> DataFrame:
    """vectors(id, embedding) -> (id, other, cosine): the k most similar others of each id.

    asked: only of ids divisible by it. least: only those of that cosine or more, the others are not carried on.
    """
    import pandas as pd

    spark = vectors.sparkSession
    rows = vectors.where(F.size("embedding") == dim).select(F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<float>").alias("embedding")).where("id is not null")
    n = rows.count()
    c = int(min(MOST_PIVOTS, max(1, -(-n // shard))))
    sample = np.array([r.embedding for r in rows.orderBy(F.xxhash64("id"), "id").limit(max(c, 64)).collect()], dtype=np.float32).reshape(-1, dim)
    sample = np.unique(unit(sample[np.isfinite(sample).all(1) & sample.any(1)]).astype(np.float32), axis=0)
    if not len(sample):  # of many rows, none of the sample's is fine
        sample = np.eye(1, dim, dtype=np.float32)
    router = Router(sample[np.random.default_rng(7).permutation(len(sample))[:c]])
    counts = rows.mapInArrow(lambda b: _count_batches(b, router, visits, reach, dim, asked), "pivot int, points long, visitors long")
    shards = Shards(len(router.pivots), counts.groupBy("pivot").agg(F.sum("points").alias("points"), F.sum("visitors").alias("visitors")).collect(), shard)
    share = spark.sparkContext.broadcast((router, shards))
    routed = rows.mapInArrow(lambda b: _route_batches(b, *share.value, visits, reach, dim, asked), "task int, id long, kind int, digest long, vector binary")

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf["kind"].to_numpy() == 0
        every = pdf["id"].to_numpy(), pdf["digest"].to_numpy(), _unpack(pdf["vector"], dim)
        points, guests = (_distinct(*(x[which] for x in every)) for which in (own, ~own))
        if not len(points[0]):
            return pd.DataFrame({"id": [], "other": [], "cosine": []})
        # of the tasks of one shard, only the first answers for its own points
        first = share.value[1].answers_own(int(pdf["task"].iloc[0]))
        q, o, s = answer_shard(points, guests, k, beam, degree, residents=asked == 1 and first, least=least)
        return pd.DataFrame({"id": q, "other": o, "cosine": s})

    found = routed.repartition(max(1, min(shards.n, 20_000)), "task").groupBy("task").applyInPandas(answer, "id long, other long, cosine double")
    if asked == 1:  # what one end has met, both have
        found = found.unionByName(found.select(F.col("other").alias("id"), F.col("id").alias("other"), "cosine"))
    # the ids of equal vectors: all of them have their point's neighbours, the first k + 1 can be a neighbour
    marks = rows.select(F.xxhash64("embedding").alias("class"), F.hash("embedding").alias("check"), "id", "embedding")
    several = marks.groupBy("class", "check").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("class", "check")
    fine = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v)) & F.exists("embedding", lambda v: v != 0)
    copies = cut(marks.join(sized(cut(several)), ["class", "check"]).where(fine).select(F.struct("class", "check").alias("class"), F.col("id").alias("copy")).distinct())
    top = lambda by: Window.partitionBy(by).orderBy(F.desc("cosine"), "other")
    if not copies.isEmpty():
        place = F.row_number().over(Window.partitionBy("class").orderBy("copy"))
        firsts = sized(cut(copies.withColumn("place", place).where(F.col("place") <= k + 1).select("class", F.col("copy").alias("member"))))
        of = copies.withColumnRenamed("copy", "point")
        # each end by its class, or by itself
        wide = found.join(of, found.other == of.point, "left").drop("point").join(firsts, "class", "left").select("id", F.coalesce("member", "other").alias("other"), "cosine")
        mine = wide.join(of, wide.id == of.point, "left").select("class", F.when(F.col("class").isNull(), F.col("id")).alias("id"), "other", "cosine").distinct()
        single, shared = mine.where("class is null").select("id", "other", "cosine"), mine.where("class is not null").select("class", "other", "cosine")
        shared = shared.unionByName(firsts.select("class", F.col("member").alias("other"), F.lit(1.0).alias("cosine")))
        shared = shared.withColumn("place", F.row_number().over(top("class"))).where(F.col("place") <= k + 1).drop("place")
        found = single.unionByName(shared.join(copies, "class").where("copy <> other").select(F.col("copy").alias("id"), "other", "cosine")).where(F.col("id") % asked == 0)
    return found.distinct().withColumn("place", F.row_number().over(top("id"))).where(F.col("place") <= k).drop("place")
