"""A forest's trees on binned rows inside a task (ML-04, ML-12): numpy only, no Spark.

The rows of a tree are kept ordered by node, so that all nodes of a level are handled together:
counts and sums of the labels by node and candidate range, slot by slot, then every node's best split
among the slots drawn for it, then the rows move on to the children.  A row that a tree drew
several times has that weight.  As in Spark's trees: variance gain, candidate ranges, the share
of the features drawn anew for every node, at least ``min_leaf`` drawn rows on either side; a two-valued slot (a flag) is told by
the rows that have it set.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

from isotherm.operators.histograms import Layout, hashed


@dataclass
class Rows:
    """Rows of a table, slot by slot: the bins of the ranged slots, the numbers of the flags that are set (as many columns
    as a row has set flags, filled up with the number of flags), the labels and the rows' draws."""
    bins: np.ndarray
    sets: np.ndarray
    y: np.ndarray
    draw: np.ndarray


def rows_of(layout: Layout, chunks: Callable[[], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> Rows:
    """``chunks``: the bytes of ``layout`` (a line a row), labels and draws of some rows at a time; gone through twice."""
    k, f = len(layout.ranged), len(layout.flags)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)
    n = many = 0
    for encoded, y, _ in chunks():
        n, many = n + len(y), max(many, int(bits[encoded[:, k:]].sum(axis=1).max(initial=0)))
    out = Rows(np.empty((k, n), np.uint8), np.full((many, n), f, np.uint16), np.empty(n), np.empty(n, np.uint32))
    first = 0
    for encoded, y, draw in chunks():
        of = slice(first, first + len(y))
        out.bins[:, of], out.y[of], out.draw[of] = encoded[:, :k].T, y, draw
        if many:
            row, flag = np.nonzero(np.unpackbits(encoded[:, k:], axis=1, count=f, bitorder="little"))
            number = np.bincount(row, minlength=len(y))
            out.sets[np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number), first + row] = flag
        first += len(y)
    return out


def tree_key(seed: int, tree: int) -> int:
    """What a tree's draws of rows follow from."""
    return int(np.random.default_rng([seed, tree, 1]).integers(2 ** 32))


def weights(draw: np.ndarray, share: float, key: int) -> np.ndarray:
    """How often a tree draws each row: Poisson with mean ``share``, the same in every pass over the rows."""
    mass, k = [math.exp(-share)], 0
    while mass[-1] > 1e-12 or k < share:
        k += 1
        mass.append(mass[-1] * share / k)
    return np.searchsorted(np.cumsum(mass), (hashed(draw, key) + 0.5) / 2.0 ** 32).astype(float)


@dataclass
class Nodes:
    """A tree in order of its levels: the left child (the right one is next to it; -1: a leaf), the split and the drawn rows'
    count, sum and sum of squares."""
    left: np.ndarray
    slot: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    n: np.ndarray
    s: np.ndarray
    q: np.ndarray


class Chosen:
    """The best split so far of each of ``m`` nodes."""

    def __init__(self, n: np.ndarray, s: np.ndarray):
        self.n, self.s = n, s
        self.best = np.full(len(n), -np.inf)
        self.of, self.at = np.full(len(n), -1, np.int32), np.zeros(len(n), np.int32)

    def offer(self, of, at, left_n, left_s, min_leaf: int, allowed: np.ndarray, which: np.ndarray) -> None:
        """Candidates of the nodes ``which``, a line a node: number ``of`` and range ``at`` (a function of the column), and the sums
        of one side.  Of candidates that are equal up to rounding the first stays."""
        other = self.n[which, None] - left_n
        valid = (left_n >= min_leaf) & (other >= min_leaf) & allowed
        with np.errstate(divide="ignore", invalid="ignore"):
            score = left_s * left_s / left_n + (self.s[which, None] - left_s) ** 2 / other
        score[~valid] = -np.inf
        value = score.max(axis=1)
        col = (score >= value[:, None] * (1 - 1e-12)).argmax(axis=1)
        better = value > self.best[which] * (1 + 1e-12)
        to, col = which[better], col[better]
        self.best[to], self.of[to], self.at[to] = value[better], of(col), at(col)

    def gain(self) -> np.ndarray:
        return (self.best - self.s ** 2 / self.n) / self.n

    def wins(self, q: np.ndarray) -> np.ndarray:
        """Whether the best split gains more than rounding; ``q``: the labels' sums of squares."""
        return (self.of >= 0) & (self.gain() > 1e-12 * q / self.n)


def draw_features(rng: np.random.Generator, nodes: int, width: int, n_allowed: int) -> np.ndarray:
    """The slots each node may split on: ``n_allowed`` of ``width``, drawn for it."""
    if n_allowed >= width:
        return np.ones((nodes, width), bool)
    out = np.zeros((nodes, width), bool)
    np.put_along_axis(out, np.argpartition(rng.random((nodes, width), np.float32), n_allowed, axis=1)[:, :n_allowed], True, axis=1)
    return out


class Candidates:
    """The candidate ranges of one tree: of every bin, how many there are and the last bin of each."""

    def __init__(self, layout: Layout, rng: np.random.Generator):
        self.layout, self.groups, self.flags = layout, layout.groups(rng).astype(np.uint8), len(layout.flags)
        self.ranges = [int(g[len(c)]) + 1 for g, c in zip(self.groups, layout.cuts, strict=True)]
        self.last = [np.searchsorted(g[:len(c) + 1], np.arange(r), side="right") - 1
                     for g, c, r in zip(self.groups, layout.cuts, self.ranges, strict=True)]

    def sums(self, at: np.ndarray, sets: np.ndarray, node: np.ndarray, m: int, w: np.ndarray, wy: np.ndarray) -> Iterator[tuple]:
        """Drawn rows and their labels' sum, by node and range slot by slot, then by node and flag."""
        for i, r in enumerate(self.ranges):
            to = node * r + at[i]
            yield tuple(np.bincount(to, x, m * r).reshape(m, r) for x in (w, wy))
        have = np.zeros((2, m * (self.flags + 1)))
        for column in sets:
            to = node * (self.flags + 1) + column
            for h, x in zip(have, (w, wy), strict=True):
                h += np.bincount(to, x, len(h))
        yield tuple(have.reshape(2, m, self.flags + 1)[:, :, :self.flags])

    def choose(self, best: Chosen, sums: Iterator[tuple], min_leaf: int, allowed: np.ndarray, first: int = 0) -> None:
        """Offer the candidates in ``sums`` of the nodes from ``first`` on; a line of ``allowed`` a node."""
        k = len(self.ranges)
        for i, both in enumerate(sums):
            if i < k:
                which = np.flatnonzero(allowed[:, self.layout.ranged[i]])
                below = [np.cumsum(x[which], axis=1)[:, :-1] for x in both]
                best.offer(lambda col, i=i: i, lambda col: col, *below, min_leaf, True, which + first)
            elif self.flags:
                best.offer(lambda col: k + col, lambda col: 0 * col, *both, min_leaf, allowed[:, list(self.layout.flags)],
                           np.arange(first, first + len(allowed)))

    def split(self, of: int, at: int) -> tuple[int, float]:
        """Slot and threshold of candidate ``of``, range ``at``."""
        k = len(self.ranges)
        if of >= k:
            return self.layout.flags[of - k], self.layout.flag_cuts[of - k]
        return self.layout.ranged[of], self.layout.cuts[of][self.last[of][at]]


def grow(rows: Rows, w: np.ndarray, layout: Layout, rng: np.random.Generator, depth: int, min_leaf: int, n_allowed: int,
         cells: int) -> Nodes:
    """One tree on ``rows`` drawn ``w`` times each; at most ``cells`` sums of a slot are held at once."""
    k, candidates = len(layout.ranged), Candidates(layout, rng)
    if not w.any():
        w = np.ones(len(w))
    taken = np.flatnonzero(w)
    at = np.empty((k, len(taken)), np.uint8)
    for i in range(k):
        at[i] = candidates.groups[i][rows.bins[i][taken]]
    sets, w = rows.sets[:, taken], w[taken]
    wy = w * rows.y[taken]
    del taken
    step = max(1, cells // max([len(layout.flags) + 1, *candidates.ranges]))
    ends, ids = np.array([0, len(w)]), np.array([0])
    n, s, q = np.array([w.sum()]), np.array([wy.sum()]), np.array([(wy * wy / w).sum()])
    found, made = [], 1
    for level in range(depth + 1):
        # of all nodes of the level; those in ``ids`` may split and hold the rows from one end to the next
        left, slot, threshold, gain = np.full(len(n), -1, np.int32), np.full(len(n), -1, np.int32), np.zeros(len(n)), np.full(len(n), -1.0)
        found.append((left, slot, threshold, gain, n, s, q))
        if level == depth or not len(ids):
            break
        best = Chosen(n[ids], s[ids])
        for first in range(0, len(ids), step):
            until = min(first + step, len(ids))
            of = slice(ends[first], ends[until])
            node = np.repeat(np.arange(until - first), np.diff(ends[first:until + 1]))
            allowed = draw_features(rng, until - first, layout.width, n_allowed)
            candidates.choose(best, candidates.sums(at[:, of], sets[:, of], node, until - first, w[of], wy[of]), min_leaf, allowed, first)
        won = best.gain()
        split = best.wins(q[ids])
        of, place = best.of, best.at
        for i in range(k):
            mine = split & (of == i)
            slot[ids[mine]], threshold[ids[mine]] = layout.ranged[i], layout.cuts[i][candidates.last[i][place[mine]]]
        flagged = split & (of >= k)
        if flagged.any():
            slot[ids[flagged]], threshold[ids[flagged]] = np.array(layout.flags)[of[flagged] - k], layout.flag_cuts[of[flagged] - k]
        gain[ids[split]] = won[split]
        left[ids[split]] = made + 2 * np.arange(split.sum())
        # the rows move on: children are numbered in pairs, in the order of their parents
        size = np.diff(ends)
        of, place = np.repeat(np.where(split, of, -1), size), np.repeat(place, size)
        right = np.zeros(len(of), bool)
        to = np.flatnonzero((of >= 0) & (of < k))
        right[to] = at[of[to], to] > place[to]
        if flagged.any():
            for column in sets:
                right |= (of >= k) & (column == of - k)
        child = np.repeat(2 * (np.cumsum(split) - 1), size) + right
        inside, many = of >= 0, 2 * int(split.sum())
        made += many
        n, s, q = (np.bincount(child[inside], x[inside], many) for x in (w, wy, wy * wy / w))
        open_ = (n >= 2 * min_leaf) & (q - s * s / np.maximum(n, 1) > 1e-12 * q) if level + 1 < depth else np.zeros(many, bool)
        inside[inside] = open_[child[inside]]
        order = np.concatenate([np.flatnonzero(inside & ~right), np.flatnonzero(inside & right)])
        sizes = np.bincount(child[order], minlength=many)
        ids = np.concatenate([np.flatnonzero(open_[0::2]) * 2, np.flatnonzero(open_[1::2]) * 2 + 1])
        ends = np.append(0, np.cumsum(sizes[ids]))
        del of, place, right, to, child, inside  # before the rows are copied
        at = at[:, order]
        sets, w, wy = sets[:, order], w[order], wy[order]
    return Nodes(*(np.concatenate(x) for x in zip(*found, strict=True)))


#: A node while rows are walked down: the next node (a leaf's is itself; one more where its test holds) by column, mask and limit of a row's bytes.
WALK = np.dtype([("left", np.uint32), ("column", np.uint16), ("mask", np.uint8), ("limit", np.uint8)])


def walk_of(layout: Layout, ids: np.ndarray, left: np.ndarray, slot: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """Nodes for ``descend``; ``left`` is below 0 for a leaf."""
    out = np.zeros(len(ids), WALK)
    out["left"], out["limit"] = np.where(left < 0, ids, left), 255
    place, flag = {s: i for i, s in enumerate(layout.ranged)}, {s: i for i, s in enumerate(layout.flags)}
    for s in np.unique(slot[left >= 0]).tolist():
        mine = np.flatnonzero((slot == s) & (left >= 0))
        if s in place:
            out["column"][mine], out["mask"][mine] = place[s], 255
            out["limit"][mine] = np.searchsorted(layout.cuts[place[s]], threshold[mine])
        else:
            out["column"][mine], out["mask"][mine], out["limit"][mine] = len(place) + flag[s] // 8, 1 << flag[s] % 8, 0
    return out


def descend(walk: np.ndarray, codes: np.ndarray, depth: int) -> np.ndarray:
    """The node that every row of ``codes`` (a row's bytes) reaches in ``depth`` steps."""
    flat, row = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
    packed, at = walk.view(np.uint64), np.zeros(len(codes), np.int64)
    if not len(flat):
        return at  # no slot varies: there is no split
    for _ in range(depth):
        p = packed[at]
        column, mask, limit = (p >> np.uint64(32)) & np.uint64(0xFFFF), (p >> np.uint64(48)) & np.uint64(0xFF), p >> np.uint64(56)
        code = flat[row + column.astype(np.int64)] & mask.astype(np.uint8)
        at = (p & np.uint64(0xFFFFFFFF)).astype(np.int64) + (code > limit.astype(np.uint8))
    return at
