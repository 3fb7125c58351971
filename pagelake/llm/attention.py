"""A small causal self-attention model over subword ids, trained and run in numpy.

Ids are numbered so that those that follow alike lie together, in clusters. The model gives the cluster of the next
id, then the id within it, each by a softmax of its own; so every id is told apart, at the cost of two short
softmaxes. Both start from the logarithm of what pair counts say (`base`); the model learns what to add to it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

#: Width, hidden width, tokens in a window, and by how many the next window is further on when scoring.
WIDTH, HIDDEN, WINDOW, STRIDE = 16, 32, 48, 40
#: Windows in a training step at most, and steps that a part of the corpus should have where it can.
BATCH, STEPS = 128, 300
RATE, TINY = np.float32(WIDTH**-0.5), np.float32(1e-37)

Params = dict[str, np.ndarray]


@dataclass(frozen=True, eq=False)
class Base:
    """What the counts say. edges: first id of each cluster, and the number of ids. row: the table's row for every id
    before. clusters, inner: log probability of a cluster, and of an id within its cluster, by row.
    """

    edges: np.ndarray
    row: np.ndarray
    clusters: np.ndarray
    inner: np.ndarray

    @functools.cached_property
    def of(self) -> np.ndarray:
        """Cluster of every id, in 16 bits where they do, as those are sorted fastest."""
        return _short(np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges)), len(self.edges))

    @functools.cached_property
    def blocks(self) -> list[np.ndarray]:
        """`inner` cluster by cluster, so that a cluster's part of a row is in one piece."""
        return [np.ascontiguousarray(self.inner[:, lo:hi]) for lo, hi in zip(self.edges[:-1], self.edges[1:], strict=True)]

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("edges", "row", "clusters", "inner")}  # what follows from them stays


class Windows(NamedTuple):
    """Of every window and place: the id before, the one before that, the id to tell, whether it counts, its position."""

    seen: np.ndarray
    before: np.ndarray
    target: np.ndarray
    counts: np.ndarray
    position: np.ndarray


def fresh(ids: int, clusters: int, seed: int = 5) -> Params:
    rng = np.random.default_rng(seed)
    d = WIDTH
    m = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    embed = lambda n, scale: (scale * rng.standard_normal((n, d))).astype(np.float32)
    return {
        "embed": embed(ids, 0.5), "before": embed(ids, 0.5), "place": embed(WINDOW, 0.1),
        "qkv": m(d, 3 * d), "o": m(d, d), "w1": m(d, HIDDEN), "b1": np.zeros(HIDDEN, np.float32), "w2": m(HIDDEN, d),
        "top": np.zeros((d, clusters), np.float32), "inner": np.zeros((d, ids), np.float32),
    }


MASK = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)


#: Logits are cut off here, far above what occurs, so that no maximum has to be taken from them first.
HIGHEST = np.float32(60)


def _short(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys below n in 16 bits if they fit: numpy sorts those by counting."""
    return keys.astype(np.uint16) if n <= 1 << 16 else keys


def _length(x: np.ndarray) -> float:
    """The longest row's length."""
    return float(np.sqrt(np.einsum("...i,...i->...", x, x).max(initial=0)))


def _exp(x: np.ndarray, bound: float) -> np.ndarray:
    """exp in place; returns its sums over the last axis, by a product, which is faster than adding up short rows.

    bound: no x is above it; so it tells whether anything may have to be cut off.
    """
    if not bound < HIGHEST:
        np.minimum(x, HIGHEST, out=x)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[-1], x.dtype)


def _rated(qkv: np.ndarray) -> np.ndarray:
    """With queries scaled, which is cheaper on the weights than on what comes of them."""
    out = qkv.copy()
    out[:, :WIDTH] *= RATE
    return out


def hidden(p: Params, seen: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, tuple]:
    """States (window and position, width) after one attention layer; a position sees itself and what is before."""
    n, d = len(seen), WIDTH
    flat = p["embed"].take(seen.ravel(), axis=0)
    flat += p["before"].take(before.ravel(), axis=0)
    x = flat.reshape(n, WINDOW, d)
    x += p["place"]
    qkv = (flat @ _rated(p["qkv"])).reshape(n, WINDOW, 3 * d)
    q, k, v = qkv[..., :d], qkv[..., d : 2 * d], qkv[..., 2 * d :]
    a = q @ k.transpose(0, 2, 1)
    a += MASK
    turn = (1 / _exp(a, _length(q) * _length(k)))[..., None]
    m = a @ v
    m *= turn
    m = m.reshape(-1, d)
    h = flat + m @ p["o"]
    z = h @ p["w1"]
    z += p["b1"]
    np.maximum(z, 0, out=z)
    return h + z @ p["w2"], (flat, q, k, v, a, turn, m, h, z)


def outputs(p: Params, base: Base, g: np.ndarray, seen: np.ndarray, target: np.ndarray, slopes: bool) -> tuple[np.ndarray, np.ndarray | None, Params]:
    """Log probability of every target; with slopes, also those of the summed loss by state and by weight.

    Places are put in the order of their targets' clusters first, so that each cluster's are one piece.
    """
    cluster = base.of.take(target)
    order = np.argsort(cluster, kind="stable")
    cluster, g, row = cluster[order], g.take(order, axis=0), base.row.take(seen.take(order))
    cuts = np.searchsorted(cluster, np.arange(len(base.edges)))
    rows, length = np.arange(len(target)), _length(g)
    e = g @ p["top"]
    e += base.clusters.take(row, axis=0)
    sums = _exp(e, length * _length(p["top"].T))
    at = rows * e.shape[1] + cluster
    told = np.log(e.take(at) + TINY) - np.log(sums)
    dg, d = None, {}
    if slopes:
        e *= (1 / sums)[:, None]
        e.reshape(-1)[at] -= 1
        d = {"top": g.T @ e, "inner": np.zeros_like(p["inner"])}
        dg = e @ p["top"].T
    bound = length * _length(p["inner"].T)
    to = target.take(order) - base.edges.take(cluster)
    got, sums = np.empty_like(told), np.empty_like(told)
    for k in np.flatnonzero(np.diff(cuts)):
        lo, hi, mine = base.edges[k], base.edges[k + 1], slice(cuts[k], cuts[k + 1])
        some, w = g[mine], p["inner"][:, lo:hi]
        e = some @ w
        e += base.blocks[k].take(row[mine], axis=0)
        sums[mine] = s = _exp(e, bound)
        at = rows[: len(some)] * e.shape[1] + to[mine]
        got[mine] = e.take(at)
        if slopes:
            e *= (1 / s)[:, None]
            e.reshape(-1)[at] -= 1
            d["inner"][:, lo:hi] = some.T @ e
            dg[mine] += e @ w.T
    told += np.log(got + TINY) - np.log(sums)
    back = np.empty_like(order)
    back[order] = rows
    return told.take(back), None if dg is None else dg.take(back, axis=0), d


def _sum_by(n: int, key: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rows of x summed by their key."""
    order = np.argsort(_short(key, n), kind="stable")
    keys = key.take(order)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    out = np.zeros((n, x.shape[1]), np.float32)
    out[keys[first]] = np.add.reduceat(x.take(order, axis=0), first)
    return out


def slopes(p: Params, base: Base, w: Windows) -> tuple[float, Params]:
    """Mean loss over the places that count, and its gradients."""
    d_ = WIDTH
    g, (x, q, k, v, a, turn, m, h, z) = hidden(p, w.seen, w.before)
    n, ok = len(w.seen), np.flatnonzero(w.counts)
    places = max(1, len(ok))
    told, dsome, d = outputs(p, base, g.take(ok, axis=0), w.seen.take(ok), w.target.take(ok), True)
    dg = np.zeros_like(g)
    dg[ok] = dsome
    d["w2"] = z.T @ dg
    dz = dg @ p["w2"].T
    dz *= z > 0
    d["w1"], d["b1"] = h.T @ dz, np.ones(len(dz), dz.dtype) @ dz
    dh = dg + dz @ p["w1"].T
    d["o"] = m.T @ dh
    dm = (dh @ p["o"].T).reshape(n, WINDOW, d_)
    a *= turn
    da = dm @ v.transpose(0, 2, 1)
    da -= np.einsum("nwi,nwi->nw", dm, m.reshape(dm.shape))[..., None]
    da *= a
    dqkv = np.empty((n, WINDOW, 3 * d_), da.dtype)
    np.matmul(da, k, out=dqkv[..., :d_])
    np.matmul(da.transpose(0, 2, 1), q, out=dqkv[..., d_ : 2 * d_])
    np.matmul(a.transpose(0, 2, 1), dm, out=dqkv[..., 2 * d_ :])
    dqkv = dqkv.reshape(-1, 3 * d_)
    d["qkv"] = _rated(x.T @ dqkv)
    dx = dh + dqkv @ _rated(p["qkv"]).T
    d["place"] = dx.reshape(n, WINDOW, d_).sum(axis=0)
    d["embed"], d["before"] = _sum_by(len(p["embed"]), w.seen.ravel(), dx), _sum_by(len(p["embed"]), w.before.ravel(), dx)
    return -float(told.sum()) / places, {name: y / np.float32(places) for name, y in d.items()}


def windows(target: np.ndarray, lengths: np.ndarray, begin: int, stride: int) -> Windows:
    """Windows over sequences that lie one after the other in `target`; every position counts in one window only.

    What is before a sequence's first id is `begin`, the end of some text.
    """
    first = np.cumsum(lengths) - lengths
    seen = np.concatenate([[begin], target[:-1]])[: len(target)]
    seen[first] = begin
    before = np.concatenate([[begin], seen[:-1]])[: len(target)]
    before[first] = begin
    many = 1 + np.maximum(0, -(-(lengths - WINDOW) // stride))
    which = np.repeat(np.arange(len(lengths)), many)
    far = ((np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)) * stride)[:, None]
    step = np.arange(WINDOW)
    inside = far + step < lengths[which][:, None]
    at = np.where(inside, first[which][:, None] + far + step, first[which][:, None])
    return Windows(seen[at], before[at], target[at], inside & ((far == 0) | (step >= WINDOW - stride)), at)


def pick(w: Windows, rows: np.ndarray | slice) -> Windows:
    return Windows(*(x[rows] for x in w))


class Trainer:
    """Adam over windows that come in portions; the rate falls to a twentieth over the steps that are expected."""

    def __init__(self, p: Params, base: Base, expected: int, rate: float = 0.01):
        self.p, self.base = {k: v.copy() for k, v in p.items()}, base
        self.m, self.s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        self.step, self.places, self.expected, self.rate, self.loss = 0, 0, max(1, expected), rate, 0.0

    def learn(self, w: Windows, size: int) -> None:
        """One pass over the windows, in shuffled order, so many in a step."""
        order = np.random.default_rng(self.step).permutation(len(w.seen))
        for i in range(0, len(order), size):
            part = pick(w, order[i : i + size])
            loss, d = slopes(self.p, self.base, part)
            self.step += 1
            self.places += int(part.counts.sum())
            self.loss = loss if self.step == 1 else 0.95 * self.loss + 0.05 * loss
            rate = self.rate * max(0.05, 1 - self.step / (self.expected + 1)) * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
            for k, x in d.items():
                m, s = self.m[k], self.s[k]
                m *= np.float32(0.9)
                m += np.float32(0.1) * x
                x *= x
                x *= np.float32(0.01)
                s *= np.float32(0.99)
                s += x
                np.sqrt(s, out=x)
                x += np.float32(1e-8)
                np.divide(m, x, out=x)
                x *= np.float32(rate)
                self.p[k] -= x


def portions(many: int) -> int:
    """Windows in a step, for a part of the corpus that has so many windows: small parts take smaller steps, more often."""
    return int(min(BATCH, max(16, many // STEPS)))


def score(p: Params, base: Base, target: np.ndarray, lengths: np.ndarray, begin: int, size: int = 512) -> np.ndarray:
    """Natural log probability of every target, by position, from overlapping windows."""
    out = np.zeros(len(target), np.float64)
    for w in _some(target, lengths, begin, size):
        g, _ = hidden(p, w.seen, w.before)
        ok = w.counts.ravel()
        out[w.position.ravel()[ok]], _, _ = outputs(p, base, g[ok], w.seen.ravel()[ok], w.target.ravel()[ok], False)
    return out


def _some(target: np.ndarray, lengths: np.ndarray, begin: int, size: int) -> Iterator[Windows]:
    w = windows(target, lengths, begin, STRIDE)
    for i in range(0, len(w.seen), size):
        yield pick(w, slice(i, i + size))


def bisect(features: np.ndarray, weight: np.ndarray, parts: int) -> list[np.ndarray]:
    """Rows in `parts` (a power of two) groups: halved again and again along the direction in which a group spreads most.

    Halves have equal sums of the weights' square roots: a group costs its weight times its size, which is least in all
    when these sums are alike, so that rows of great weight are in small groups.
    """
    groups, rng = [np.arange(len(features))], np.random.default_rng(0)
    while len(groups) < parts:
        halves = []
        for g in groups:
            if len(g):
                w = weight[g]
                x = features[g] - np.average(features[g], axis=0, weights=w)
                v = rng.standard_normal(x.shape[1])
                for _ in range(15):
                    v = x.T @ (w * (x @ v))
                    v /= np.linalg.norm(v) + 1e-30
                g = g[np.argsort(x @ v, kind="stable")]
            to = np.cumsum(np.sqrt(weight[g]))
            cut = min(int(np.searchsorted(to, to[-1] / 2)) + 1, max(1, len(g) - 1)) if len(g) else 0
            halves += [g[:cut], g[cut:]]
        groups = halves
    return groups
