"""Trees on binned features: boosting with leaf penalties, forests with out-of-bag votes, adaptive boosting.

Features are cut at exact quantiles once. Rows are kept as blocks of bounded size (bins, labels, weights, a hash of the key). A level of a tree
is one aggregation: every task sums histograms by (node, feature, bin) over its blocks, the sums of a node and feature
meet in one reducer that finds the best cut, and one row for each open node and feature reaches the driver. Statistics are summed as whole numbers
(fixed point), so that a model depends neither on cores nor on blocks. Rows, columns and bags are drawn by hashes.

A table of one block takes the same steps inside one task, without a job for each level. The trees of a forest do not wait for each other: while
the binned table is small (``SHARED_BYTES``, counted first) each task grows a few whole trees on it; larger ones take a job for each level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import best_index, finite_or, name, poisson_bounds
from sparktab.operators.ranking import order_values
from sparktab.session import checkpointed, ensure_checkpoint_dir

# Rows of a block; statistics count in steps of 1 / SCALE.
BLOCK_ROWS, SCALE = 1 << 16, float(1 << 24)
# Cells of histograms that a task holds at once: more open nodes are taken in several passes.
HIST_CELLS = 1 << 22
# Trees of a forest that grow side by side.
GROUP_TREES = 20
# A binned table of up to so many bytes is handed to every task that grows trees of a forest, at most so many trees to a task.
SHARED_BYTES, TASK_TREES = 64 << 20, 4
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
ARRAYS = {"bins": np.uint8, "y": np.int32, "w": np.float64, "h": np.uint64, "state": np.float64}
BLOCK_DDL = "block long, rows int, " + ", ".join(f"{c} binary" for c in ARRAYS)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(h: np.ndarray, *salts: int) -> np.ndarray:
    """Repeatable uniform numbers in [0, 1) from hashes and whole-number salts."""
    x = np.asarray(h, dtype=np.uint64)
    for s in salts:
        x = mixed(x + np.uint64((int(GOLDEN) * (s + 1)) & 0xFFFFFFFFFFFFFFFF))
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def drawn(count: int, d: int, *salts: int) -> np.ndarray:
    """``count`` of ``d`` features in a random order."""
    return np.argsort(uniform(np.arange(d, dtype=np.uint64), *salts), kind="stable")[:count]


def drawn_at(d: int, nodes: np.ndarray, *salts: int) -> np.ndarray:
    """``drawn(d, d, *salts, node)`` for each of ``nodes``, one row each."""
    x = np.arange(d, dtype=np.uint64)
    for s in salts:
        x = mixed(x + np.uint64((int(GOLDEN) * (s + 1)) & 0xFFFFFFFFFFFFFFFF))
    x = mixed(x[None, :] + (GOLDEN * (nodes.astype(np.uint64) + np.uint64(1)))[:, None])
    return np.argsort((x >> np.uint64(11)).astype(np.float64) * 2.0**-53, axis=1, kind="stable")


@dataclass
class Tree:
    """Nodes in the order of their making; ``feature`` is -1 at a leaf, the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [0.0])
    total: list = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, bin_: int, gain: float, left: np.ndarray) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, bin_, a, gain
        for stats in (left, self.total[node] - left):
            for column, v in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.gain, 0.0), (self.total, stats)):
                column.append(v)
        return a, a + 1

    def prune(self, least: float) -> None:
        """Undo, from the last one up, splits of two leaves that gained less than ``least``."""
        for node in reversed(range(len(self.feature))):
            a = self.left[node]
            if self.feature[node] >= 0 and self.feature[a] < 0 and self.feature[a + 1] < 0 and self.gain[node] < least:
                self.feature[node] = -1

    def assign(self, bins: np.ndarray) -> np.ndarray:
        """Node of every row; ``bins`` is (features, rows)."""
        feature, cut, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node, rows = np.zeros(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
        while len(rows):
            rows = rows[feature[node[rows]] >= 0]
            at = node[rows]
            node[rows] = left[at] + (bins[feature[at], rows] > cut[at])
        return node


@dataclass
class Block:
    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    h: np.ndarray
    state: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        n = row["rows"]
        a = {c: np.frombuffer(row[c] or b"", dtype=t) for c, t in ARRAYS.items()}
        return cls(a["bins"].reshape(-1, n), a["y"], a["w"], a["h"], a["state"].reshape(n, -1))

    def row(self, block: int) -> dict:
        return {"block": block, "rows": len(self.y), **{c: np.ascontiguousarray(getattr(self, c)).astype(t).tobytes() for c, t in ARRAYS.items()}}


@dataclass(frozen=True)
class Newton:
    """Second-order boosting. Channels: gradient, hessian, rows."""

    l1: float = 0.0
    l2: float = 1.0
    min_child: float = 1.0
    channels: int = 3

    def shrunk(self, g: np.ndarray) -> np.ndarray:
        return np.sign(g) * np.maximum(np.abs(g) - self.l1, 0.0)

    def score(self, s: np.ndarray) -> np.ndarray:
        return self.shrunk(s[..., 0]) ** 2 / np.maximum(s[..., 1] + self.l2, 1e-12)

    def gains(self, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        right = total - left
        ok = (left[..., 1] >= self.min_child) & (right[..., 1] >= self.min_child) & (left[..., 2] > 0) & (right[..., 2] > 0)
        gain = self.score(left) + self.score(right) - self.score(total)
        return np.where(ok & (gain > 1e-6), gain, -np.inf)

    def open(self, total: np.ndarray) -> bool:
        return total[2] > 1

    def leaf(self, total: np.ndarray) -> np.ndarray:
        return np.array([-self.shrunk(total[0]) / max(total[1] + self.l2, 1e-12)])


@dataclass(frozen=True)
class Gini:
    """Classification trees. Channels: weight of each class, rows."""

    classes: int
    min_split: int = 2
    min_leaf: int = 1

    @property
    def channels(self) -> int:
        return self.classes + 1

    def score(self, s: np.ndarray) -> np.ndarray:
        w = s[..., :-1]
        return (w * w).sum(-1) / np.maximum(w.sum(-1), 1e-12)

    def gains(self, left: np.ndarray, total: np.ndarray) -> np.ndarray:
        right = total - left
        ok = (left[..., -1] >= max(self.min_leaf, 1)) & (right[..., -1] >= max(self.min_leaf, 1))
        # an impure node may be split without a gain, as the next cut may bring one
        return np.where(ok, np.maximum(self.score(left) + self.score(right) - self.score(total), 0.0), -np.inf)

    def open(self, total: np.ndarray) -> bool:
        return total[-1] >= max(self.min_split, 2) and (total[:-1] > 0).sum() > 1

    def leaf(self, total: np.ndarray) -> np.ndarray:
        return total[:-1] / max(total[:-1].sum(), 1e-12)


def best_cut(hist: np.ndarray, rule) -> tuple[float, int, np.ndarray, np.ndarray]:
    """Gain, bin, statistics on the left and in all, for one node and feature: ``hist`` is (bins, channels), whole numbers."""
    upto = np.cumsum(hist, axis=0)
    gains = rule.gains(upto[:-1] / SCALE, upto[-1] / SCALE)
    at = int(np.argmax(gains)) if len(gains) else 0
    return (float(gains[at]) if len(gains) else -np.inf), at, upto[at], upto[-1]


@dataclass(frozen=True)
class Open:
    """A node that may be split, and the features that it may use."""

    tree: int
    node: int
    features: tuple[int, ...]


def histograms(block: Block, trees: list[Tree], open_: Sequence[Open], stats: Callable, levels: int, channels: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(place in ``open_``, feature, sums by bin and channel) over one block. ``stats(block, tree)`` gives (rows, channels) in whole numbers."""
    for t in sorted({o.tree for o in open_}):
        own = [(i, o) for i, o in enumerate(open_) if o.tree == t]
        values, node = stats(block, t), trees[t].assign(block.bins)
        slot = np.full(len(trees[t].feature), -1)
        slot[[o.node for _, o in own]] = np.arange(len(own))
        at = slot[node]
        rows = np.flatnonzero((at >= 0) & (values[:, -1] > 0))
        at, values = at[rows], values[rows]
        allowed = np.zeros((len(own), len(block.bins)), dtype=bool)
        for s, (_, o) in enumerate(own):
            allowed[s, list(o.features)] = True
        for f in np.flatnonzero(allowed.any(axis=0)).tolist():
            some = slice(None) if allowed[:, f].all() else np.flatnonzero(allowed[at, f])
            code = at[some] * levels + block.bins[f, rows[some]]
            sums = np.stack([np.bincount(code, weights=values[some, c], minlength=len(own) * levels) for c in range(channels)], axis=1)
            sums = np.rint(sums).astype(np.int64).reshape(len(own), levels, channels)
            for s in np.flatnonzero(allowed[:, f]).tolist():
                yield own[s][0], f, sums[s]


class Alone:
    """The steps of a fit on one block, in this process."""

    def __init__(self, block: Block):
        self.block = block

    def cuts(self, trees: list[Tree], open_: Sequence[Open], stats: Callable, levels: int, rule) -> list[tuple]:
        return [(i, f, *best_cut(h, rule)) for i, f, h in histograms(self.block, trees, open_, stats, levels, rule.channels)]

    def update(self, change: Callable[[Block], np.ndarray]) -> None:
        self.block = replace(self.block, state=change(self.block))

    def sums(self, fn: Callable[[Block], np.ndarray]) -> np.ndarray:
        return np.rint(fn(self.block)).astype(np.int64)

    def close(self) -> None:
        pass


class Spread:
    """The same steps on blocks kept by the executors: a job for each level; a change of the rows' state is made by the job that follows it."""

    EVERY = 10  # changes between two checkpoints

    def __init__(self, blocks: DataFrame, count: int):
        ensure_checkpoint_dir(blocks.sparkSession)
        cores = blocks.sparkSession.sparkContext.defaultParallelism
        dealt = blocks.repartitionByRange(min(count, max(2 * cores, count // 16)), "block")
        self.blocks: RDD = dealt.rdd.map(lambda row: Block.of(row.asDict())).persist(StorageLevel.MEMORY_AND_DISK)
        self.older: list[RDD] = []
        self.changes, self.parts = 0, min(self.blocks.getNumPartitions(), cores)

    def done(self) -> None:
        """After a job the current blocks are kept: those before them can go."""
        for rdd in self.older:
            rdd.unpersist()
        self.older = []

    def cuts(self, trees: list[Tree], open_: Sequence[Open], stats: Callable, levels: int, rule) -> list[tuple]:
        channels = rule.channels

        def summed(blocks: Iterator[Block]) -> Iterator[tuple]:
            known: dict[tuple[int, int], np.ndarray] = {}
            for block in blocks:
                for i, f, h in histograms(block, trees, open_, stats, levels, channels):
                    known[i, f] = known[i, f] + h if (i, f) in known else h
            yield from known.items()

        sums = self.blocks.mapPartitions(summed).reduceByKey(np.add, self.parts)
        best = sums.map(lambda kv: (*kv[0], *best_cut(kv[1], rule))).collect()  # one for each open node and feature
        self.done()
        return best

    def update(self, change: Callable[[Block], np.ndarray]) -> None:
        self.changes += 1
        self.older.append(self.blocks)
        self.blocks = self.blocks.map(lambda block: replace(block, state=change(block))).persist(StorageLevel.MEMORY_AND_DISK)
        if self.changes % self.EVERY == 0:
            self.blocks.checkpoint()
            self.blocks.count()
            self.done()

    def sums(self, fn: Callable[[Block], np.ndarray]) -> np.ndarray:
        found = self.blocks.map(lambda block: np.rint(fn(block)).astype(np.int64)).reduce(np.add)
        self.done()
        return found

    def close(self) -> None:
        self.done()
        self.blocks.unpersist()


def grow(store, trees: list[Tree], rule, depth: int, levels: int, width: int, stats: Callable, features: Callable[[int, int, int], Sequence[int]]) -> None:
    """Grow ``trees`` level by level. ``features(tree, node, attempt)`` names those to try; none ends the attempts at a node."""
    waiting = [(t, 0, 0) for t in range(len(trees))]
    for _ in range(depth):
        below: list[tuple[int, int, int]] = []
        while waiting:
            most = max(1, HIST_CELLS // (levels * width * rule.channels))
            now, waiting = waiting[:most], waiting[most:]
            open_ = [Open(t, node, tuple(int(f) for f in features(t, node, k))) for t, node, k in now]
            best: dict[int, tuple] = {}
            for place, f, gain, at, left, total in store.cuts(trees, open_, stats, levels, rule):
                o = open_[place]
                if o.node == 0 and trees[o.tree].total[0] is None:
                    trees[o.tree].total[0] = total
                if gain > -np.inf and (place not in best or (gain, -f) > (best[place][0], -best[place][1])):
                    best[place] = (gain, f, at, left)
            for place, (t, node, k) in enumerate(now):
                whole = trees[t].total[node]
                if whole is None or not rule.open(whole / SCALE):
                    continue
                if place in best:
                    gain, f, at, left = best[place]
                    below += [(t, child, 0) for child in trees[t].split(node, f, at, gain, left) if rule.open(trees[t].total[child] / SCALE)]
                elif len(features(t, node, k + 1)):
                    waiting.append((t, node, k + 1))  # no valid cut among these features: try the next ones
        waiting = below
        if not waiting:
            break


def leaves(tree: Tree, rule, width: int) -> np.ndarray:
    """Value of every node of a tree (nodes, width)."""
    return np.stack([rule.leaf(t / SCALE) if t is not None else np.zeros(width) for t in tree.total])


@dataclass
class PackedTree:
    """A fitted classification tree as arrays; ``left`` of a leaf is its row in the table of leaf values."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray

    def assign(self, bins: np.ndarray) -> np.ndarray:
        """Row in the table of leaf values of every row; ``bins`` is (features, rows)."""
        node, rows = np.zeros(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
        while len(rows):
            rows = rows[self.feature[node[rows]] >= 0]
            at = node[rows]
            node[rows] = self.left[at] + (bins[self.feature[at], rows] > self.bin[at])
        return self.left[node].astype(np.int64)


def packed(feature: np.ndarray, bin_: np.ndarray, left: np.ndarray, totals: np.ndarray) -> tuple[PackedTree, np.ndarray]:
    """Tree and class shares of its leaves. ``totals`` (nodes, classes) are whole numbers; many leaves have the same ones, which are kept once."""
    leaf = np.flatnonzero(feature < 0)
    kinds, which = np.unique(totals[leaf], axis=0, return_inverse=True)
    left = left.astype(np.int32)
    left[leaf] = which.ravel()
    return PackedTree(feature.astype(np.int16), bin_.astype(np.uint8), left), shares_of(kinds / SCALE)


def shares_of(totals: np.ndarray) -> np.ndarray:
    return totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-12)


def packed_tree(tree: Tree, classes: int) -> tuple[PackedTree, np.ndarray]:
    totals = np.array([np.zeros(classes, dtype=np.int64) if t is None else t[:-1] for t in tree.total])
    return packed(np.array(tree.feature), np.array(tree.bin), np.array(tree.left), totals)


def best_cuts(code: np.ndarray, label: np.ndarray, weight: np.ndarray, total: np.ndarray, levels: int, rule: Gini) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, bin and left statistics of the best cut of one feature at every open node; gain -inf where there is none.

    ``code`` is node * levels + bin of every row, ``total`` (nodes, channels). Only bins that hold rows are looked at: the work grows with the rows, not with the nodes.
    """
    m = len(total)
    order = np.argsort(code, kind="stable")
    code = code[order]
    last = np.flatnonzero(np.append(code[1:] != code[:-1], True))
    at, bin_ = np.divmod(code[last], levels)
    first = np.searchsorted(at, np.arange(m + 1))  # entries of each node
    upto = np.empty((len(last), rule.channels), dtype=np.int64)
    for c in range(rule.classes):
        upto[:, c] = np.cumsum(np.where(label[order] == c, weight[order], 0))[last]
    upto[:, -1] = (last + 1) * int(SCALE)
    held = np.flatnonzero(first[1:] > first[:-1])
    before = np.zeros((m, rule.channels), dtype=np.int64)
    before[held] = np.where(first[held, None] > 0, upto[np.maximum(first[held] - 1, 0)], 0)
    upto -= before[at]
    gains = np.where(bin_ < levels - 1, rule.gains(upto / SCALE, total[at] / SCALE), -np.inf)
    best, place = np.full(m, -np.inf), np.zeros(m, dtype=np.int64)
    best[held] = np.maximum.reduceat(gains, first[held]) if len(held) else -np.inf
    hit = np.flatnonzero(gains == best[at])[::-1]
    place[at[hit]] = hit  # the first one stays
    if not len(last):
        return best, place, before
    return best, bin_[place], upto[place]


def grow_alone(block: Block, copies: np.ndarray, rule: Gini, depth: int, levels: int, features: int, salts: tuple[int, int]) -> tuple[PackedTree, np.ndarray]:
    """The tree that ``grow`` makes, for a whole table in one task: rows go down with their nodes, and a level is a few array operations for all its nodes."""
    width = len(block.bins)
    rows = np.flatnonzero(copies > 0)
    y, w = block.y[rows], np.rint(block.w[rows] * copies[rows] * SCALE).astype(np.int64)
    root = np.append(np.bincount(y, weights=w, minlength=rule.classes).astype(np.int64), len(rows) * int(SCALE))[None]
    totals = [root]
    ids, total, slot, made = np.array([0]), root, np.zeros(len(rows), dtype=np.int64), 1

    def is_open(t: np.ndarray) -> np.ndarray:
        return (t[:, -1] / SCALE >= max(rule.min_split, 2)) & ((t[:, :-1] > 0).sum(axis=1) > 1)

    marks: list[tuple] = []  # splits of a level: nodes, features, bins, left children
    if not (len(rows) and width and is_open(root)[0]):
        ids = ids[:0]
    for _ in range(depth):
        if not len(ids):
            break
        order = drawn_at(width, ids, *salts)
        chosen, cut, child = np.full(len(ids), -1), np.zeros(len(ids), dtype=np.int64), np.full(len(ids), -1)
        made_totals, waiting, attempt = [], np.arange(len(ids)), 0
        while len(waiting) and attempt * features < width:
            allowed = np.zeros((len(ids), width), dtype=bool)
            allowed[waiting[:, None], order[waiting, attempt * features : (attempt + 1) * features]] = True
            gain, sides = np.full(len(ids), -np.inf), np.zeros((len(ids), rule.channels), dtype=np.int64)
            for f in np.flatnonzero(allowed[waiting].any(axis=0)).tolist():
                some = np.flatnonzero(allowed[slot, f])
                code = slot[some] * levels + block.bins[f, rows[some]]
                g, b, s = best_cuts(code, y[some], w[some], total, levels, rule)
                better = np.flatnonzero(g > gain)
                gain[better], chosen[better], cut[better], sides[better] = g[better], f, b[better], s[better]
            split = waiting[gain[waiting] > -np.inf]
            child[split] = made + 2 * np.arange(len(split))
            made += 2 * len(split)
            pair = np.stack([sides[split], total[split] - sides[split]], axis=1)
            made_totals.append(pair.reshape(-1, rule.channels))
            waiting = waiting[gain[waiting] == -np.inf]
            attempt += 1
        marks.append((ids, chosen, cut, child))
        fresh = np.concatenate(made_totals)
        base = made - len(fresh)
        totals.append(fresh)
        go_on = is_open(fresh)
        ids, total = base + np.flatnonzero(go_on), fresh[go_on]
        to = np.full(len(fresh), -1)
        to[go_on] = np.arange(len(ids))
        some = np.flatnonzero(child[slot] >= 0)
        own = slot[some]
        down = to[child[own] - base + (block.bins[chosen[own], rows[some]] > cut[own])]
        kept = some[down >= 0]
        rows, y, w, slot = rows[kept], y[kept], w[kept], down[down >= 0]
    feature, bin_, left = np.full(made, -1), np.zeros(made, dtype=np.int64), np.full(made, -1)
    for nodes, f, b, c in marks:
        feature[nodes], bin_[nodes], left[nodes] = f, b, c
    return packed(feature, bin_, left, np.concatenate(totals)[:, :-1])


def shares(votes: np.ndarray) -> np.ndarray:
    """Votes (rows, classes) as shares; equal ones without any vote."""
    whole = votes.sum(axis=1, keepdims=True)
    return np.divide(votes, whole, out=np.full_like(votes, 1 / votes.shape[1]), where=whole > 0)


@dataclass(frozen=True)
class Boosting:
    """Rounds of Newton trees on the logistic (two classes) or softmax loss."""

    classes: int
    rounds: int
    depth: int
    rate: float
    rows: float
    cols: float
    rule: Newton
    gamma: float
    seed: int

    @property
    def outputs(self) -> int:
        return 1 if self.classes == 2 else self.classes

    @property
    def initial(self) -> list[float]:
        return [0.0] * self.outputs

    def chances(self, model: list, bins: np.ndarray) -> np.ndarray:
        """Class probabilities (rows, classes)."""
        margin = np.zeros((bins.shape[1], self.outputs))
        for trees, values in model:
            margin += np.stack([v[t.assign(bins)] for t, v in zip(trees, values, strict=True)], axis=1)
        if self.classes == 2:
            p = 1 / (1 + np.exp(-margin[:, 0]))
            return np.stack([1 - p, p], axis=1)
        e = np.exp(margin - margin.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def gradients(self, block: Block, k: int, r: int) -> np.ndarray:
        if self.classes == 2:
            p = 1 / (1 + np.exp(-block.state[:, 0]))
            hit, curve = block.y == 1, p * (1 - p)
        else:
            e = np.exp(block.state - block.state.max(axis=1, keepdims=True))
            p = (e / e.sum(axis=1, keepdims=True))[:, k]
            hit, curve = block.y == k, 2 * p * (1 - p)
        inside = uniform(block.h, self.seed, r, 1) < self.rows
        out = np.stack([block.w * (p - hit), block.w * np.maximum(curve, 1e-16), np.ones(len(p))], axis=1) * inside[:, None]
        return np.rint(out * SCALE)

    def run(self, store, levels: int, width: int) -> list:
        count, model = max(1, int(self.cols * width)), []
        for r in range(self.rounds):
            trees = [Tree() for _ in range(self.outputs)]
            some = [sorted(drawn(count, width, self.seed, r, k).tolist()) for k in range(self.outputs)]
            grow(store, trees, self.rule, self.depth, levels, width, lambda b, k, r=r: self.gradients(b, k, r), lambda k, _, a, some=some: some[k] if a == 0 else ())
            for t in trees:
                t.prune(self.gamma)
            values = [self.rate * leaves(t, self.rule, 1)[:, 0] for t in trees]
            if all(t.total[0] is None for t in trees):
                break
            model.append((trees, values))
            store.update(lambda b, trees=trees, values=values: b.state + np.stack([v[t.assign(b.bins)] for t, v in zip(trees, values, strict=True)], axis=1))
        return model


@dataclass(frozen=True)
class Adaptive:
    """SAMME rounds of shallow classification trees; the class balance enters every tree on top of the rows' weights."""

    classes: int
    rounds: int
    depth: int
    rate: float
    rule: Gini
    seed: int
    initial = (1.0,)

    def chances(self, model: list, bins: np.ndarray) -> np.ndarray:
        """Shares of the weighted votes (rows, classes)."""
        out = np.zeros((bins.shape[1], self.classes))
        for tree, guess, alpha in model:
            out[np.arange(len(out)), guess[tree.assign(bins)]] += alpha
        return shares(out)

    def weights(self, block: Block) -> np.ndarray:
        out = np.zeros((len(block.y), self.classes + 1))
        out[np.arange(len(block.y)), block.y] = np.rint(block.w * block.state[:, 0] * SCALE)
        out[:, -1] = SCALE
        return out

    def run(self, store, levels: int, width: int) -> list:
        model, everything = [], tuple(range(width))
        for _ in range(self.rounds):
            tree = Tree()
            grow(store, [tree], self.rule, self.depth, levels, width, lambda b, _: self.weights(b), lambda *a: everything if a[2] == 0 else ())
            if tree.total[0] is None:
                break
            guess = leaves(tree, self.rule, self.classes).argmax(axis=1)

            def missed(b: Block, tree=tree, guess=guess) -> np.ndarray:
                return guess[tree.assign(b.bins)] != b.y

            wrong, whole, n = store.sums(lambda b: np.array([np.rint(b.state[missed(b), 0] * SCALE).sum(), np.rint(b.state[:, 0] * SCALE).sum(), len(b.y)])).tolist()
            error = wrong / whole
            if error >= 1 - 1 / self.classes:
                break
            if error <= 0:
                model.append((tree, guess, 1.0))
                break
            alpha = self.rate * (np.log((1 - error) / error) + np.log(self.classes - 1))
            model.append((tree, guess, float(alpha)))
            mean = whole / SCALE / n  # dividing by the mean keeps the weights in range over many rounds
            store.update(lambda b, alpha=alpha, mean=mean: b.state * np.where(missed(b), np.exp(alpha), 1.0)[:, None] / mean)
        return model


@dataclass(frozen=True)
class Bagging:
    """Trees on Poisson bags; a few random features at each node, more only if none of them allows a cut."""

    classes: int
    trees: int
    depth: int | None
    rule: Gini
    features: int
    seed: int
    initial = ()

    def chances(self, model: list, bins: np.ndarray) -> np.ndarray:
        """Mean class shares of the leaves (rows, classes)."""
        out = np.zeros((bins.shape[1], self.classes))
        for tree, values in model:
            out += values[tree.assign(bins)]
        return shares(out)

    def groups(self, size: int = GROUP_TREES) -> list[range]:
        return [range(at, min(self.trees, at + size)) for at in range(0, self.trees, size)]

    def copies(self, block: Block, tree: int) -> np.ndarray:
        return np.searchsorted(poisson_bounds(1.0), uniform(block.h, self.seed, tree, 2), side="right")

    def weights(self, block: Block, tree: int) -> np.ndarray:
        copies = self.copies(block, tree)
        out = np.zeros((len(block.y), self.classes + 1))
        out[np.arange(len(block.y)), block.y] = np.rint(block.w * copies * SCALE)
        out[:, -1] = (copies > 0) * SCALE
        return out

    def some(self, store, chosen: Sequence[int], levels: int, width: int) -> list:
        made = [Tree() for _ in chosen]

        def features(t: int, node: int, attempt: int) -> np.ndarray:
            return drawn(width, width, self.seed, chosen[t], node)[attempt * self.features : (attempt + 1) * self.features]

        grow(store, made, self.rule, self.depth or 1 << 30, levels, width, lambda b, t: self.weights(b, chosen[t]), features)
        return [packed_tree(t, self.classes) for t in made]

    def alone(self, block: Block, chosen: Sequence[int], levels: int) -> list:
        """The same trees on a whole table in one task."""
        return [grow_alone(block, self.copies(block, t), self.rule, self.depth or 1 << 30, levels, self.features, (self.seed, t)) for t in chosen]

    def run(self, store, levels: int, width: int) -> list:
        return [t for chosen in self.groups() for t in self.some(store, chosen, levels, width)]


@dataclass
class Table:
    """Binned rows: cut values of each feature, blocks, their number and that of the rows."""

    cuts: list[np.ndarray]
    blocks: DataFrame
    count: int
    rows: int

    @property
    def levels(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1


def inputs(features: Sequence[str] | str) -> Column:
    """Features as one array; what is missing or infinite counts as 0."""
    if isinstance(features, str):
        return F.transform(F.col(name(features)), lambda v: finite_or(v))
    return F.array(*[finite_or(F.col(name(c))) for c in features])


def binned(df: DataFrame, features: Sequence[str] | str, label: str, weights: dict, width: int, initial: Sequence[float], key: str | None, bins: int, block_rows: int) -> Table:
    """Cut every feature at its exact quantiles and gather rows in blocks by a hash of the key (without one: of the whole row)."""
    if not 2 <= bins <= 256:
        raise ValueError("2 to 256 bins")
    x = inputs(features)
    mark = F.xxhash64(F.col(name(key)).cast("string")) if key else F.xxhash64(x, F.col(name(label)))
    rows = df.select(mark.alias("h"), F.col(name(label)).cast("int").alias("y"), x.alias("x"))
    wide = rows.select(*[F.col("x")[i].alias(f"f{i}") for i in range(width)])
    ranked = order_values(wide, [f"f{i}" for i in range(width)], lambda n: sorted({i * n // bins for i in range(1, bins)}))
    cuts = [np.unique(np.array(list(ranked[f"f{i}",].values.values()), dtype=np.float64)) if (f"f{i}",) in ranked else np.empty(0) for i in range(width)]
    total = rows.count()
    blocks = max(1, -(-total // block_rows))
    held = np.array([weights.get(c, 1.0) for c in range(max([*weights, 0]) + 1)])
    start = np.array(initial, dtype=np.float64)

    def gathered(table: pa.Table) -> pa.Table:
        h, y = table.column("h").to_numpy(), table.column("y").to_numpy()
        values = np.array(table.column("x").to_pylist(), dtype=np.float64).reshape(len(h), width)
        order = np.lexsort((y, h))
        own = np.stack([np.searchsorted(c, values[order, f], side="right") for f, c in enumerate(cuts)]) if width else np.empty((0, len(h)))
        made = Block(own.astype(np.uint8), y[order], held[y[order]], h[order].view(np.uint64), np.tile(start, (len(h), 1)))
        return pa.Table.from_pylist([made.row(int(table.column("block")[0].as_py()))], schema=SCHEMA)

    spread = rows.select(F.pmod(F.col("h"), F.lit(blocks)).alias("block"), "*")
    return Table(cuts, spread.groupBy("block").applyInArrow(gathered, BLOCK_DDL), blocks, total)


SCHEMA = pa.schema([("block", pa.int64()), ("rows", pa.int32()), *[(c, pa.binary()) for c in ARRAYS]])


def fitted(table: Table, plan, width: int) -> list:
    """Run ``plan`` on the blocks: inside one task if there is one block, else as jobs over all of them; trees of a forest in tasks of their own."""
    ensure_checkpoint_dir(table.blocks.sparkSession)
    blocks = checkpointed(table.blocks)
    levels = table.levels
    if isinstance(plan, Bagging) and table.rows * row_bytes(width) <= SHARED_BYTES:
        return forest_of(blocks, plan, levels)
    if table.count > 1:
        store = Spread(blocks, table.count)
        try:
            return plan.run(store, levels, width)
        finally:
            store.close()

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = plan.run(Alone(Block.of(row)), levels, width)
                yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(made)], pa.binary())], ["model"])

    return [m for r in blocks.mapInArrow(alone, "model binary").collect() for m in cloudpickle.loads(r["model"])]


def row_bytes(width: int) -> int:
    """Bytes of a row in a block without state."""
    return width + sum(np.dtype(ARRAYS[c]).itemsize for c in ("y", "w", "h"))


def forest_of(blocks: DataFrame, plan: Bagging, levels: int) -> list:
    """Each task gets all blocks (``SHARED_BYTES`` at most) and grows a few trees."""
    groups = plan.groups(TASK_TREES)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        for place in sorted({r["place"] for r in rows}):
            own = [Block.of(r) for r in rows if r["place"] == place]
            table = Block(np.concatenate([b.bins for b in own], axis=1), *[np.concatenate([getattr(b, c) for b in own]) for c in ("y", "w", "h", "state")])
            for t in groups[place]:
                made = cloudpickle.dumps(plan.alone(table, [t], levels)[0])
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([made], pa.binary())], ["tree", "model"])

    each = blocks.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(len(groups) - 1)))).repartitionByRange(len(groups), "place")
    found = each.mapInArrow(grown, "tree int, model binary").collect()  # the model: its size is that of its trees
    return [cloudpickle.loads(r["model"]) for r in sorted(found, key=lambda r: r["tree"])]


@dataclass
class BinnedModel:
    """Cut values, plan and trees as one transform."""

    features: Sequence[str] | str
    cuts: list[np.ndarray]
    plan: object
    trees: list

    def bins_of(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)])

    def transform(self, df: DataFrame) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(self)  # trees: bounded by the parameters of the fit

        @F.pandas_udf("array<double>")
        def chances(x: pd.Series) -> pd.Series:
            m = held.value
            values = np.array(x.tolist(), dtype=np.float64).reshape(len(x), len(m.cuts))
            return pd.Series(list(m.plan.chances(m.trees, m.bins_of(values))))

        out = df.withColumn("__chances", chances(inputs(self.features)))
        return out.select(*[F.col(name(c)) for c in df.columns], best_index(F.col("__chances")).alias("prediction"), F.col("__chances").alias("probability"))


@dataclass(frozen=True)
class BinnedLearner:
    """Recipe of a tree model. ``make(classes, features)`` gives its plan; labels are 0..K-1.

    ``key`` names the column whose hash draws rows and bags; without it equal rows are drawn together.
    """

    features: tuple[str, ...] | str
    label: str
    make: Callable[[int, int], object]
    weighting: str | None = "balanced"
    key: str | None = None
    bins: int = 256
    block_rows: int = BLOCK_ROWS

    def fit(self, df: DataFrame) -> BinnedModel:
        return self._fit(df)[0]

    def _fit(self, df: DataFrame) -> tuple[BinnedModel, Table]:
        df = df.where(F.col(name(self.label)).isNotNull())
        counts = {int(r[0]): r[1] for r in df.groupBy(F.col(name(self.label)).cast("int")).count().collect()}
        rows = sum(counts.values())
        weights = {c: 1.0 for c in counts}
        if self.weighting == "balanced":
            weights = {c: rows / (len(counts) * n) for c, n in counts.items()}
        elif self.weighting == "ratio":
            weights[1] = counts.get(0, 0) / counts[1] if counts.get(1) else 1.0
        if isinstance(self.features, str):
            first = df.select(F.size(name(self.features)).alias("n")).first()
            width = first["n"] if first else 0
        else:
            width = len(self.features)
        plan = self.make(max(2, max(counts, default=0) + 1), width)
        table = binned(df, self.features, self.label, weights, width, plan.initial, self.key, self.bins, self.block_rows)
        return BinnedModel(self.features, table.cuts, plan, fitted(table, plan, width) if rows else []), table

    def out_of_bag(self, df: DataFrame) -> tuple[BinnedModel, DataFrame]:
        """The forest, and ``label, prediction, n`` over the votes of the trees that left each row out.

        One pass over the blocks; rows that every tree drew have no votes and are not counted.
        """
        model, table = self._fit(df)
        plan: Bagging = model.plan
        held = df.sparkSession.sparkContext.broadcast(model)

        def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = held.value.trees
            for batch in batches:
                for row in batch.to_pylist():
                    block = Block.of(row)
                    out, seen = np.zeros((len(block.y), plan.classes)), np.zeros(len(block.y), dtype=bool)
                    for t, (tree, values) in enumerate(trees):
                        outside = plan.copies(block, t) == 0
                        out[outside] += values[tree.assign(block.bins[:, outside])]
                        seen |= outside
                    code = (block.y * plan.classes + out.argmax(axis=1))[seen]
                    n = np.bincount(code, minlength=plan.classes**2)
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([pa.array((at // plan.classes).astype(np.int32)), pa.array((at % plan.classes).astype(np.int32)), pa.array(n[at])], ["label", "prediction", "n"])

        found = table.blocks.mapInArrow(votes, "label int, prediction int, n long")
        return model, found.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
