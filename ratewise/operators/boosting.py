"""Boosted regression trees with squared loss over features that are binned once.

Settings follow the reference's boosters: L1 (soft threshold) and L2 leaf penalties, a least number of
rows a child, one draw of columns a tree, missing values tried on either side of each split, and a stop
when the training error has not fallen for some rounds (the trees up to the best round stay).

Plan
----
* Cut points come from at most ``EDGE_ROWS`` rows, those with the least hash of their features: midpoints of
  the distinct values, or quantiles where a feature has more than ``max_bins`` of them. Missing values (NULL, NaN) have a
  bin of their own.
* Features come in groups (those of a user, those of an item): a block stores each group's distinct combinations
  of bins once, and of a row the numbers of its combinations. Rows are dealt to blocks by the first group, so that
  the rows of a combination are together. Blocks are cached; the passes read them there.
* A level of a tree is one pass: tasks find the node of each row and sum its residual and count by
  (node, drawn feature, bin): first by (node, combination), then what there is of those by bin. Only the smaller
  child of each split is summed; its sibling is the parent less that. Partial histograms are added up by the
  executors, in pieces, unless all of them together are known to be within ``DRIVER_BYTES``; the driver then holds
  nodes x features x bins sums, whatever the number of rows, and picks the splits. A table of one block (up to
  ``ALONE_ROWS``) needs no exchange between its levels, so the task that has it grows ``ALONE_TREES`` at once.
* Predictions of a block and the nodes of its rows are a function of the trees so far. A task leaves them in a file
  of its executor's own folder, beside the rows of the block, where the Python workers of that executor find them.
  Where they are missing (a lost executor, a moved block) a pass goes over the cached blocks and computes them from the
  trees, so none of it has to be kept.

Residuals are summed as integers (units of 2^-20), so sums are exact and the model depends on rows and
settings alone: not on partitions, cores, or the order in which tasks end.
"""

from __future__ import annotations

import os
import pickle
import shutil
from dataclasses import dataclass, field
from itertools import groupby
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

EDGE_ROWS = 1 << 15
#: Rows of a block at most, and of a table that is one block; trees that a task grows of the latter.
BLOCK_ROWS, ALONE_ROWS, ALONE_TREES = 1 << 20, 1 << 22, 10
DRIVER_BYTES = 64 << 20
PIECE = 1 << 16  # histogram cells summed under one key
#: Rows that a task moves down a tree at once; rows packed at once; combinations of the columns that are summed together.
STEP_ROWS, PACK_ROWS, PART = 1 << 15, 1 << 17, 256
UNIT = float(1 << 20)
#: A split must gain more than this.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    trees: int = 100
    depth: int = 6
    rate: float = 0.3
    min_rows: int = 1
    columns: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    stop_rounds: int | None = None
    max_bins: int = 64
    base: float = 0.5
    seed: int = 0


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i + 1 and 2i + 2); feature -1 marks a leaf."""
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def leaf(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, bool), np.zeros(n))

    @property
    def levels(self) -> int:
        """How many times a row moves down at most."""
        return int(np.flatnonzero(self.feature >= 0).max(initial=-1) + 1).bit_length()

    def leaves(self, bins: Grouped, missing: np.ndarray) -> np.ndarray:
        node = np.zeros(bins.n, np.int32)
        for _ in range(self.levels):
            node = bins.step(self, node, missing)
        return node


class Grouped:
    """Binned rows. ``columns`` are the features of each group, ``tables`` its distinct combinations (feature,
    combination) and ``codes`` which of them each row has. ``parts``, of each group: (features, table, combination
    of these features that each of the group's has), for features that have few combinations together."""

    def __init__(self, columns: list[np.ndarray], tables: list[np.ndarray], codes: list[np.ndarray], parts: list | None = None):
        self.columns, self.tables, self.codes, self.n = columns, tables, codes, len(codes[0])
        self.parts = parts or [[(c[k:k + 1], t[k:k + 1], None) for k in range(len(c))] for c, t in zip(columns, tables)]
        self.flat = np.concatenate([t.reshape(-1) for t in tables])
        self.base, self.group = (np.zeros(sum(map(len, columns)), np.int64) for _ in range(2))
        start = 0
        for g, (c, t) in enumerate(zip(columns, tables)):
            self.base[c], self.group[c] = start + np.arange(len(c)) * t.shape[1], g
            start += t.size

    def __reduce__(self):
        return Grouped, (self.columns, self.tables, self.codes, self.parts)

    @classmethod
    def dense(cls, bins: np.ndarray) -> Grouped:
        """(feature, row) bytes as they are."""
        return cls([np.arange(len(bins))], [bins], [np.arange(bins.shape[1])])

    def step(self, tree: Tree, node: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The node of each row one level further down; ``missing``: each feature's bin for missing values."""
        f, split = tree.feature, tree.feature >= 0
        # bytes wrap: where missing values go left, theirs (the last) becomes 0 and the others follow
        shift = np.where(split & tree.missing_left, 256 - missing[f].astype(np.int64), 0)
        cut, first = np.where(split, tree.cut + shift, 255).astype(np.uint8), np.arange(len(f)) + 1
        first[split] += first[split]
        base, group, shift = self.base[f], self.group[f], shift.astype(np.uint8)
        out, shifted, several = np.empty_like(node), shift.any(), len(self.codes) > 1
        for s in range(0, self.n, STEP_ROWS):
            rows = slice(s, s + STEP_ROWS)
            at = node[rows].astype(np.intp)
            code = self.codes[0][rows]
            if several:
                of = group.take(at)
                for g in range(1, len(self.codes)):
                    code = np.where(of == g, self.codes[g][rows], code)
            b = self.flat.take(base.take(at) + code)
            if shifted:
                b += shift.take(at)
            out[rows] = first.take(at) - (b <= cut.take(at))
        return out


@dataclass
class Block:
    """Rows of the binned table and what a worker knows of them."""
    key: str
    bins: Grouped
    label: np.ndarray
    state: dict = field(default_factory=dict)

    def __post_init__(self):
        if isinstance(self.bins, np.ndarray):
            self.bins = Grouped.dense(self.bins)


# ---- split finding ------------------------------------------------------------------------
def _shrunk(g, s: Settings):
    return g - np.clip(g, -s.l1, s.l1) if s.l1 > 0 else g


def _score(g, h, s: Settings):
    return _shrunk(g, s) ** 2 / (h + s.l2 if s.l2 > 0 else np.maximum(h, 1))


def leaf_value(g: int, h: int, s: Settings) -> float:
    return float(-s.rate * _shrunk(g / UNIT, s) / (h + s.l2)) if h + s.l2 > 0 else 0.0


class Cells:
    """Where the sums of some features lie in a flat histogram: each has its bins, then missing values."""

    def __init__(self, columns: np.ndarray, missing: np.ndarray):
        self.columns, self.sizes = columns, missing[columns].astype(np.int64) + 1
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        self.n = int(self.starts[-1])
        self.of = np.repeat(np.arange(len(columns)), self.sizes)
        self.missing_at = self.starts[1:] - 1


def best_splits(hist: np.ndarray, cells: Cells, s: Settings):
    """For each node of ``hist`` (node, cell, (residual, rows)): (gain, feature, cut, missing left, left
    residual, left rows); gain 0 where no split is allowed.

    Ties go to the first feature, then to missing values on the right, then to the lowest cut."""
    run = hist.cumsum(1)
    run[:, cells.starts[1]:] -= run[:, cells.starts[1:-1] - 1][:, cells.of[cells.starts[1]:] - 1]
    total = run[:, cells.missing_at[:1]]
    whole = _score(total[..., 0] / UNIT, total[..., 1], s)
    k, least = np.arange(len(hist)), max(1, s.min_rows)

    def best(left, at):
        gl, hl = left[..., 0], left[..., 1]
        gr, hr = total[..., 0] - gl, total[..., 1] - hl
        gain = _score(gl / UNIT, hl, s) + _score(gr / UNIT, hr, s) - whole
        gain[(hl < least) | (hr < least) | (gain <= LEAST_GAIN)] = 0.0
        b = gain.argmax(1)
        f = cells.of[at[b]]
        return gain[k, b], f, at[b] - cells.starts[f], gl[k, b], hl[k, b]

    bins = np.ones(cells.n, bool)
    bins[cells.missing_at] = False
    gain, feature, cut, g_left, h_left = best(run[:, bins], np.flatnonzero(bins))
    side = np.zeros(len(hist), bool)
    some = hist[:, cells.missing_at, 1].any(0)  # without missing values both sides are the same
    if some.any():
        at = np.flatnonzero(bins & some[cells.of])
        other, f, c, g, h = best(run[:, at] + hist[:, cells.missing_at[cells.of[at]]], at)
        side = (other > gain) | ((other == gain) & (other > 0) & (f < feature))
        gain, feature, cut = np.where(side, other, gain), np.where(side, f, feature), np.where(side, c, cut)
        g_left, h_left = np.where(side, g, g_left), np.where(side, h, h_left)
    return gain, cells.columns[feature], cut, side, g_left, h_left


def histogram(bins: Grouped, residual: np.ndarray, slot: np.ndarray, slots: int, cells: Cells) -> np.ndarray:
    """(slot, cell, (residual, rows)) sums of the rows whose slot is not -1."""
    if residual.dtype != np.int32 and np.abs(residual).max(initial=0.0) * len(residual) >= 2 ** 53:  # sums would not be exact: those of the upper and of the lower bits are
        high = np.floor(residual / UNIT)
        out = histogram(bins, residual - high * UNIT, slot, slots, cells)
        out[..., 0] += histogram(bins, high, slot, slots, cells)[..., 0] * int(UNIT)
        return out
    out, start = np.empty((slots, cells.n, 2), np.int64), dict(zip(cells.columns.tolist(), zip(cells.starts.tolist(), cells.sizes.tolist())))
    rows = np.flatnonzero(slot >= 0)
    whole = len(rows) == len(slot)
    slot, residual = (slot, residual) if whole else (slot.take(rows), residual.take(rows))
    slot, residual = slot.astype(np.intp), residual.astype(float)
    for table, code, parts in zip(bins.tables, bins.codes, bins.parts):
        parts = [(c, t, of, drawn) for c, t, of in parts if (drawn := [k for k, f in enumerate(c.tolist()) if f in start])]
        if not parts:
            continue
        sums = slot, (code if whole else code.take(rows)).astype(np.intp), residual, None
        if slots * table.shape[1] <= 4 * len(rows):
            sums = _by_code(*sums, slots, table.shape[1])
        for columns, t, of, drawn in parts:
            s, c, g, h = sums
            if of is not None:
                s, c, g, h = _by_code(s, of.take(c), g, h, slots, t.shape[1])
            for k in drawn:
                begin, size = start[int(columns[k])]
                at = s * size + t[k].take(c)
                out[:, begin:begin + size, 0] = np.bincount(at, g, slots * size).reshape(slots, size)
                out[:, begin:begin + size, 1] = np.bincount(at, h, slots * size).reshape(slots, size)
    return out


def _by_code(slot, code, g, h, slots: int, size: int):
    """(slot, code, residual, rows) summed by slot and code, those with rows."""
    key = slot * size + code
    h = np.bincount(key, h, slots * size)
    some = np.flatnonzero(h)
    return some // size, some % size, np.bincount(key, g, slots * size)[some], h[some]


class Growth:
    """One tree, grown level by level from the histograms that ``wanted`` asks for."""

    def __init__(self, columns: np.ndarray, missing: np.ndarray, s: Settings):
        self.tree, self.cells, self.missing, self.s, self.level = Tree.leaf(s.depth), Cells(columns, missing), missing, s, 0
        self.wanted = np.zeros(1, np.int64)  # nodes whose rows are to be summed, in slot order
        self.parents: dict[int, np.ndarray] = {}

    def take(self, hist: np.ndarray) -> None:
        """Split the nodes of this level, given the sums of the wanted ones."""
        nodes, hists = [], []
        for node, h in zip(self.wanted.tolist(), hist):
            nodes.append(node)
            hists.append(h)
            if node:
                nodes.append(node + 1 if node % 2 else node - 1)
                hists.append(self.parents[(node - 1) // 2] - h)
        if not self.level:
            g, h = self.total(hists[0])
            self.tree.value[0] = leaf_value(g, h, self.s)
        gain, feature, cut, side, g_left, h_left = best_splits(np.stack(hists), self.cells, self.s)
        order = np.argsort(nodes)
        self.parents, wanted, t = {}, [], self.tree
        self.level += 1
        for k in order[gain[order] > 0].tolist():
            node, (g, h) = nodes[k], self.total(hists[k])
            t.feature[node], t.cut[node], t.missing_left[node] = feature[k], cut[k], side[k]
            t.value[2 * node + 1] = leaf_value(g_left[k], h_left[k], self.s)
            t.value[2 * node + 2] = leaf_value(g - g_left[k], h - h_left[k], self.s)
            if self.level < self.s.depth and h >= 2 * max(1, self.s.min_rows):
                self.parents[node] = hists[k]
                wanted.append(2 * node + 1 if 2 * h_left[k] <= h else 2 * node + 2)
        self.wanted = np.array(wanted, np.int64)

    def total(self, hist: np.ndarray) -> np.ndarray:
        return hist[:self.cells.sizes[0]].sum(0)


# ---- tasks --------------------------------------------------------------------------------
def _folder(key: str) -> str | None:
    """Where the workers of this executor keep what they know of the blocks of a fit; Spark deletes it with the executor."""
    local = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return os.path.join(local, "python", f"boosting-{key.split('-')[0]}") if local else None


def _put(path: str, write) -> None:
    """A whole file in the place of the former, if any: two tasks may have the same block."""
    new = f"{path}.{uuid4().hex}"
    with open(new, "wb") as f:
        write(f)
    os.replace(new, path)


def _shelve(block: Block) -> None:
    """Leave the rows of the block to the tasks of this executor."""
    folder, bins = _folder(block.key), block.bins
    if not folder:
        return
    at = os.path.join(folder, block.key)
    try:
        os.makedirs(folder, exist_ok=True)
        for name, rows in [("label", block.label), *((f"code{g}", c) for g, c in enumerate(bins.codes))]:
            _put(f"{at}-{name}.npy", lambda f, rows=rows: np.save(f, rows))
        _put(f"{at}-bins", lambda f: pickle.dump((bins.columns, bins.tables, bins.parts), f))
    except OSError:  # a full disk: the passes read the cached blocks
        pass


def _shelved(key: str) -> Block:
    """The block that :func:`_shelve` left on this executor; OSError where there is none."""
    at = os.path.join(_folder(key) or "", key)
    with open(f"{at}-bins", "rb") as f:
        columns, tables, parts = pickle.load(f)
    codes = [np.load(f"{at}-code{g}.npy", "r") for g in range(len(columns))]
    return Block(key, Grouped(columns, tables, codes, parts), np.load(f"{at}-label.npy", "r"))


def _known(block: Block) -> Block:
    """The block with what :func:`_keep` left of it on this executor."""
    at = os.path.join(_folder(block.key) or "", block.key)
    try:
        with open(f"{at}-of") as f:
            trees, level = map(int, f.read().split())
        block.state = dict(trees=trees, level=level, at=np.load(f"{at}-at{trees}.npy", "r"), residual=np.load(f"{at}-residual{trees}.npy", "r"),
                           node=np.load(f"{at}-node{trees}.{level}.npy", "r") if level else np.zeros(len(block.label), np.int16))
    except (OSError, ValueError, EOFError):
        block.state = {}
    block.state["kept"] = block.state.get("trees", -1), block.state.get("level", -1)
    return block


def _keep(block: Block) -> None:
    """Leave what is known of the block to the next task that has it."""
    folder, st = _folder(block.key), block.state
    (trees, level), at = st["kept"], os.path.join(folder or "", block.key)
    if not folder or (trees, level) == (st["trees"], st["level"]):
        return
    try:
        os.makedirs(folder, exist_ok=True)
        if st["level"]:
            _put(f"{at}-node{st['trees']}.{st['level']}.npy", lambda f: np.save(f, st["node"]))
        if trees != st["trees"]:
            _put(f"{at}-at{st['trees']}.npy", lambda f: np.save(f, st["at"]))
            _put(f"{at}-residual{st['trees']}.npy", lambda f: np.save(f, st["residual"]))
        _put(f"{at}-of", lambda f: f.write(f"{st['trees']} {st['level']}".encode()))
        for old in [f"node{trees}.{level}"] * (level > 0) + [f"at{trees}", f"residual{trees}"] * (0 <= trees != st["trees"]):
            os.unlink(f"{at}-{old}.npy")
    except OSError:  # a full disk: the next task computes it
        pass


def _advance(block: Block, trees: list, s: Settings, missing: np.ndarray, growth_tree: Tree | None, level: int):
    """(residual in units, node of each row in the tree that grows) after ``trees``."""
    st, bins = block.state, block.bins
    kind = np.int16 if s.depth < 14 else np.int32
    if "at" not in st or st["trees"] > len(trees):
        st.update(trees=0, at=np.full(bins.n, s.base), level=0, node=np.zeros(bins.n, kind))
        st.pop("residual", None)
    while st["trees"] < len(trees):
        tree = trees[st["trees"]]
        for _ in range(st["level"], tree.levels):
            st["node"] = bins.step(tree, st["node"], missing)
        st["at"] = _plus(st["at"], tree.value, st["node"])
        st.update(trees=st["trees"] + 1, level=0, node=np.zeros(bins.n, kind))
        st.pop("residual", None)
    if level < st["level"]:
        st.update(level=0, node=np.zeros(bins.n, kind))
    while st["level"] < level:
        st["node"] = bins.step(growth_tree, st["node"], missing)
        st["level"] += 1
    if "residual" not in st:
        st["residual"] = _residual(st["at"], block.label)
    return st["residual"], st["node"]


def _plus(at: np.ndarray, value: np.ndarray, node: np.ndarray) -> np.ndarray:
    out = np.empty(len(at))
    for s in range(0, len(at), STEP_ROWS):
        rows = slice(s, s + STEP_ROWS)
        np.add(at[rows], value.take(node[rows]), out=out[rows])
    return out


def _residual(at: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Integers, in four bytes where all of them fit."""
    out = np.empty(len(at))
    for s in range(0, len(at), STEP_ROWS):
        rows = slice(s, s + STEP_ROWS)
        np.rint((at[rows] - label[rows]) * UNIT, out=out[rows])
    return out.astype(np.int32) if np.abs(out).max(initial=0.0) < 2 ** 31 else out


def _squares(residual: np.ndarray) -> int:
    return sum(int(np.rint((residual[s:s + STEP_ROWS] / UNIT) ** 2 * UNIT).astype(np.int64).sum()) for s in range(0, len(residual), STEP_ROWS))


def _sums(block: Block, residual, node, growth: Growth) -> np.ndarray:
    slot = np.full((2 << growth.s.depth) - 1, -1, np.int16 if growth.s.depth < 16 else np.int32)
    slot[growth.wanted] = np.arange(len(growth.wanted))
    return histogram(block.bins, residual, slot.take(node), len(growth.wanted), growth.cells)


def _drawn(s: Settings, tree: int, features: int) -> np.ndarray:
    """The columns that a tree may use."""
    draw = np.random.default_rng([s.seed, tree])
    return np.sort(draw.choice(features, max(1, int(s.columns * features)), replace=False))


def _grow_alone(block: Block, trees: list, s: Settings, missing: np.ndarray) -> list:
    """(sum of squares before it, tree) of the next trees of a table that is one block."""
    trees, found = [trees[t] for t in range(len(trees))], []
    while len(trees) < s.trees and len(found) < ALONE_TREES:
        growth = Growth(_drawn(s, len(trees), len(missing)), missing, s)
        squares = _squares(_advance(block, trees, s, missing, None, 0)[0])
        while len(growth.wanted):
            growth.take(_sums(block, *_advance(block, trees, s, missing, growth.tree, growth.level), growth))
        trees.append(growth.tree)
        found.append((squares, growth.tree))
    _keep(block)
    return found


class _Trees:
    """The trees so far, as tasks get them: whole groups as broadcasts, the last few with the task."""
    GROUP = 10

    def __init__(self, sc):
        self.sc, self.groups, self.recent, self.all = sc, [], [], []

    def add(self, tree: Tree) -> None:
        self.all.append(tree)
        self.recent.append(tree)
        if len(self.recent) == self.GROUP:
            self.groups.append(self.sc.broadcast(self.recent))
            self.recent = []

    def handle(self):
        return _Handle(list(self.groups), list(self.recent))

    def last(self):
        return _Last(len(self.all), self.all[-1] if self.all else None)

    def release(self) -> None:
        for g in self.groups:
            g.unpersist()


class _Handle:
    """What a task knows of the trees; a group is fetched when one of its trees is asked for."""

    def __init__(self, groups, recent):
        self.groups, self.recent = groups, recent

    def __len__(self):
        return _Trees.GROUP * len(self.groups) + len(self.recent)

    def __getitem__(self, t):
        g, k = divmod(t, _Trees.GROUP)
        return self.groups[g].value[k] if g < len(self.groups) else self.recent[k]


@dataclass
class _Last:
    """The last of so many trees: all that a task needs which finds what is known after the others."""
    trees: int
    tree: Tree | None

    def __len__(self):
        return self.trees

    def __getitem__(self, t):
        if t != self.trees - 1:
            raise FileNotFoundError("what was known of a block")
        return self.tree


# ---- binning ------------------------------------------------------------------------------
def feature_array(df: DataFrame, feature_cols: list[str]) -> Column:
    """All features of a row as one array of doubles; vector columns take one place an element."""
    kinds, nan, parts = dict(df.dtypes), F.lit(float("nan")), []
    for vector, run in groupby(feature_cols, lambda c: kinds[c] == "vector"):
        parts += [vector_to_array(c) for c in run] if vector else [
            F.array(*[F.coalesce(F.col(c).cast("double"), nan) for c in run])]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """(rows, features) of an array column whose rows have one length."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def cut_points(x: np.ndarray, max_bins: int) -> list[np.ndarray]:
    """Ascending cuts of each column: a value is in bin k if k cuts are below it."""
    out = []
    for v in x.T:
        v = np.sort(v[~np.isnan(v)])
        u = np.unique(v)
        if len(u) > max_bins:
            cuts = np.unique(v[np.arange(1, max_bins) * len(v) // max_bins - 1])
            out.append(cuts[cuts < u[-1]])
        else:
            with np.errstate(over="ignore", invalid="ignore"):
                middle = u[:-1] + (u[1:] - u[:-1]) / 2
            out.append(np.where(np.isfinite(middle) & (middle < u[1:]), middle, u[:-1]))
    return out


def missing_bins(cuts: list[np.ndarray]) -> np.ndarray:
    """The bin for missing values of each feature: the one after its last."""
    return np.array([len(c) + 1 for c in cuts], np.uint8)


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(feature, row) bytes."""
    out = np.empty((len(cuts), len(x)), np.uint8)
    for k, c in enumerate(cuts):
        out[k] = np.where(np.isnan(x[:, k]), len(c) + 1, np.searchsorted(c, x[:, k]))
    return out


def _coded(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, which of them each row is) of a matrix of bytes."""
    rows = np.ascontiguousarray(rows)
    if not rows.size:
        return rows[:1], np.zeros(len(rows), np.int32)
    d = pa.Array.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows)]).dictionary_encode()
    flat = np.frombuffer(d.dictionary.buffers()[1], np.uint8)[:len(d.dictionary) * rows.shape[1]]
    return flat.reshape(-1, rows.shape[1]), d.indices.to_numpy()


def _parts(columns: np.ndarray, table: np.ndarray) -> list:
    """The columns of a group in parts with at most ``PART`` combinations, those with few values first."""
    parts, open_, combined = [], [], None
    for k in np.argsort(table.max(1, initial=0), kind="stable").tolist():
        if combined is not None:
            both, of = np.unique(combined * 256 + table[k], return_inverse=True)
            if len(both) <= PART:
                open_, combined = [*open_, k], of
                continue
            parts.append((open_, combined))
        open_, combined = [k], np.unique(table[k], return_inverse=True)[1]
    out = []
    for ks, of in [*parts, (open_, combined)]:
        if len(ks) == 1:
            out.append((columns[ks], table[ks], None))
        else:
            first = np.zeros(int(of.max(initial=0)) + 1, np.int64)
            first[of] = np.arange(len(of))
            out.append((columns[ks], table[ks][:, first], of))
    return out


def _hashes(rows: np.ndarray) -> np.ndarray:
    """A number for each row of a matrix of bytes, the same for equal rows."""
    h = np.full(len(rows), 1469598103934665603, np.uint64)
    for c in rows.T:
        h = (h ^ c) * np.uint64(1099511628211)
        h ^= h >> np.uint64(29)
    return h


def _blocks(rows: DataFrame, cuts: list[np.ndarray], groups: list[np.ndarray], parts: int, bounds: np.ndarray, uid: str):
    """RDD of blocks, ``len(bounds) + 1`` of them in ``parts`` partitions. A row goes to the block that the
    hash of its first group has among ``bounds``; bounds that are the same share the rows with that hash."""
    def pack(x, y):
        first = _hashes(x[groups[0]].T)
        low, high = np.searchsorted(bounds, first, "left"), np.searchsorted(bounds, first, "right")
        block = low + np.arange(len(y)) % (high - low + 1)
        for p in np.unique(block).tolist():
            mine = np.flatnonzero(block == p)
            found = [_coded(x[c][:, mine].T) for c in groups]
            yield pa.record_batch({"part": pa.array([p % parts], pa.int32()), "block": pa.array([p], pa.int32()), "label": [y[mine].tobytes()],
                                   "tables": [[t.tobytes() for t, _ in found]], "codes": [[c.astype(np.int32).tobytes() for _, c in found]]})

    def run(batches):
        xs, ys, n = [], [], 0
        for b in batches:
            xs.append(to_bins(_matrix(pa.chunked_array([b.column("x")])), cuts))
            ys.append(b.column("y").to_numpy(zero_copy_only=False))
            n += len(ys[-1])
            if n >= PACK_ROWS:
                yield from pack(np.concatenate(xs, 1), np.concatenate(ys))
                xs, ys, n = [], [], 0
        if n:
            yield from pack(np.concatenate(xs, 1), np.concatenate(ys))

    def opened(packs):
        for k, mine in groupby(packs, lambda p: p["block"]):
            mine, tables, codes, combined = list(mine), [], [], []
            for g, columns in enumerate(groups):
                each = [np.frombuffer(p["tables"][g], np.uint8).reshape(-1, len(columns)) for p in mine]
                table, at = _coded(np.concatenate(each))
                start = np.cumsum([0, *map(len, each)])
                at = at.astype(np.uint16 if len(table) <= 1 << 16 else np.int32)
                codes.append(np.concatenate([at[s:e].take(np.frombuffer(p["codes"][g], np.int32)) for s, e, p in zip(start, start[1:], mine)]))
                tables.append(np.ascontiguousarray(table.T))
                combined.append(_parts(columns, tables[-1]))
            order = np.argsort(codes[0], kind="stable")  # rows of a combination side by side
            codes = [c[order] for c in codes]
            label = np.concatenate([np.frombuffer(p["label"]) for p in mine])[order]
            with np.errstate(over="ignore"):
                short = label.astype(np.float32)
            yield Block(f"{uid}-{k}", Grouped(groups, tables, codes, combined), short if (short == label).all() else label)

    packed = rows.mapInArrow(run, "part int, block int, label binary, tables array<binary>, codes array<binary>")
    return packed.repartitionById(parts, "part").sortWithinPartitions("block").rdd.mapPartitions(opened).persist(StorageLevel.MEMORY_AND_DISK)


# ---- model --------------------------------------------------------------------------------
@dataclass
class BoostedTrees:
    """``trees`` are those that stay; ``rmse`` the training error after each round that was run."""
    feature_cols: list[str]
    cuts: list[np.ndarray]
    trees: list[Tree]
    settings: Settings
    rmse: list[float]

    @property
    def n_trees(self) -> int:
        return len(self.trees)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins, missing = Grouped.dense(to_bins(x, self.cuts)), missing_bins(self.cuts)
        out = np.full(len(x), self.settings.base)
        for t in self.trees:
            out += t.value[t.leaves(bins, missing)]
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the model's prediction."""
        @F.pandas_udf("double")
        def predicted(x: pd.Series) -> pd.Series:
            return pd.Series(self.score(np.stack(x.to_numpy()).astype(float)) if len(x) else np.zeros(0))

        return df.withColumn(out, predicted(feature_array(df, self.feature_cols)))


def fit(rows: DataFrame, feature_cols: list[str], label_col: str, settings: Settings,
        block_rows: int | None = None, groups: list[list[str]] | None = None) -> BoostedTrees:
    """Boosted trees over ``rows``; a NULL label drops the row. Without rows the model has no tree.

    ``groups`` of feature columns whose values repeat together from row to row (those of a user, those of an item)
    make the passes cheaper; the model is the same with any. Columns in none are one more group."""
    s, sc = settings, rows.sparkSession.sparkContext
    if not 2 <= s.max_bins <= 254 or (block_rows or 1) > ALONE_ROWS:
        raise ValueError("max_bins must be 2 to 254, block_rows at most 2^22")
    widths = _widths(rows, feature_cols)
    rows = rows.select(feature_array(rows, feature_cols).alias("x"), F.col(label_col).cast("double").alias("y")).where("y is not null")
    n = rows.count()
    if not n:
        return BoostedTrees(feature_cols, [], [], s, [])
    some = rows.select("x", F.xxhash64("x").alias("h"))
    if n > 2 * EDGE_ROWS:  # spares the sort most rows; the limit below is the bound
        some = some.where(F.pmod("h", F.lit(1 << 30)) < int(1.5 * EDGE_ROWS / n * (1 << 30)))
    sample = _matrix(some.orderBy(F.pmod("h", F.lit(1 << 30)), "x").limit(EDGE_ROWS).select("x").toArrow().column("x"))
    cuts = cut_points(sample, s.max_bins)
    uid, missing, of = uuid4().hex, missing_bins(cuts), _groups(feature_cols, widths, len(cuts), groups or [])
    cores, n_blocks = sc.defaultParallelism, 1
    if n > (block_rows or ALONE_ROWS):  # a block a core at least; the model is the same however rows are dealt
        n_blocks = cores * -(-n // (cores * min(block_rows or BLOCK_ROWS, -(-n // cores))))
    parts = min(n_blocks, cores)
    drawn = np.sort(_hashes(to_bins(sample, cuts)[of[0]].T))
    blocks = _blocks(rows, cuts, of, parts, drawn[np.arange(1, n_blocks) * len(drawn) // n_blocks], uid)
    trees, errors = _Trees(sc), []
    passes = _Passes(blocks, parts) if n_blocks > 1 else None
    try:
        while len(trees.all) < s.trees:
            if passes is None:
                handle = trees.handle()
                grown = blocks.map(lambda b, h=handle: _grow_alone(_known(b), h, s, missing)).collect()[0]
            else:
                grown = [_tree(passes, trees, Growth(_drawn(s, len(trees.all), len(cuts)), missing, s))]
            for squares, tree in grown:
                if trees.all:
                    errors.append(float(np.sqrt(squares / UNIT / n)))
                    if s.stop_rounds and len(errors) - 1 - int(np.argmin(errors)) >= s.stop_rounds:
                        break
                trees.add(tree)
            else:
                continue
            break
        else:
            errors.append(_error(blocks, trees.handle(), missing, s, n))
        blocks.foreachPartition(lambda it, key=uid: shutil.rmtree(_folder(key) or "", ignore_errors=True) or sum(1 for _ in it))
    finally:
        if passes:
            passes.release()
        blocks.unpersist()
        trees.release()
    keep = int(np.argmin(errors)) + 1 if s.stop_rounds and errors else len(trees.all)
    return BoostedTrees(feature_cols, cuts, trees.all[:keep], s, errors)


def _widths(rows: DataFrame, feature_cols: list[str]) -> list[int | None]:
    """Places that each column takes among the features; None for a vector column, which only its rows tell."""
    kinds = dict(rows.dtypes)
    return [None if kinds[c] == "vector" else 1 for c in feature_cols]


def _groups(feature_cols: list[str], widths: list[int | None], features: int, groups: list[list[str]]) -> list[np.ndarray]:
    """The places of the features of each group. Several vector columns in a table cannot be told apart; then all is one group."""
    if widths.count(None) > 1:
        return [np.arange(features)]
    rest = features - sum(w for w in widths if w)
    start = np.cumsum([0, *(rest if w is None else w for w in widths)])
    at = {c: np.arange(b, e) for c, b, e in zip(feature_cols, start, start[1:])}
    left = [c for c in feature_cols if not any(c in g for g in groups)]
    found = [np.concatenate([at[c] for c in g if c in at] or [np.zeros(0, np.int64)]) for g in [*groups, left]]
    return [f for f in found if len(f)]


def _error(blocks, handle, missing: np.ndarray, s: Settings, n: int) -> float:
    total = sum(blocks.map(lambda b: _squares(_advance(_known(b), handle, s, missing, None, 0)[0])).collect())
    return float(np.sqrt(total / UNIT / n))


def _tree(blocks: _Passes, trees: _Trees, growth: Growth):
    """(sum of squares before the tree, tree), one pass a level."""
    total = 0
    while len(growth.wanted):
        squares, hist = _level(blocks, trees, growth)
        total = total or squares
        growth.take(hist)
    return total, growth.tree


class _Passes:
    """The cached blocks and, cached where they are, their keys. A pass over the keys finds the rows of the blocks and
    what is known of them in the executor's folder, and so moves neither; where that fails (a lost executor, a task
    elsewhere) it goes over the blocks, which are shelved anew where they are."""

    def __init__(self, blocks, parts: int):
        self.blocks, self.parts, self.keys = blocks, parts, None
        self.shelve()

    def shelve(self) -> None:
        if self.keys is not None:
            self.keys.unpersist()
        self.keys = self.blocks.map(lambda b: _shelve(b) or b.key).persist(StorageLevel.MEMORY_AND_DISK)
        self.keys.count()

    def release(self) -> None:
        self.keys.unpersist()


def _level(blocks: _Passes, trees: _Trees, growth: Growth):
    shape = (len(growth.wanted), growth.cells.n, 2)
    cells = int(np.prod(shape))
    view = _View(growth)

    def partial(it, handle):
        squares, hist = 0, np.zeros(shape, np.int64)
        for b in it:
            b = _known(_shelved(b) if isinstance(b, str) else b)
            if isinstance(handle, _Last) and len(handle) and "at" not in b.state:
                raise FileNotFoundError("what was known of a block")
            residual, node = _advance(b, handle, view.s, view.missing, view.tree, view.level)
            _keep(b)
            squares += 0 if view.level else _squares(residual)
            hist += _sums(b, residual, node, view)
        return squares, hist

    def short(it, handle=trees.last()):
        it = list(it)
        try:
            yield partial(it, handle)
        except OSError:
            yield None

    for found in (blocks.keys.mapPartitions(short), None):
        if found is None:
            blocks.shelve()
            found = blocks.blocks.mapPartitions(lambda it, handle=trees.handle(): [partial(it, handle)])
        if 8 * cells * blocks.parts <= DRIVER_BYTES:
            each = found.collect()
            if None not in [e and 1 for e in each]:
                return sum(q for q, _ in each), sum(h for _, h in each)
            continue
        pieces = -(-cells // PIECE)

        def cut(it):
            for e in it:
                if e is None:
                    yield -2, 1
                else:
                    yield -1, e[0]
                    yield from enumerate(np.array_split(e[1].reshape(-1), pieces))

        sums = dict(found.mapPartitions(cut).reduceByKey(lambda a, b: a + b, min(pieces + 1, blocks.parts)).collect())
        if -2 not in sums:
            return sums[-1], np.concatenate([sums[k] for k in range(pieces)]).reshape(shape)


class _View:
    """The part of a growth that tasks need: not the parents' histograms."""

    def __init__(self, g: Growth):
        self.tree, self.cells, self.missing, self.s, self.level, self.wanted = g.tree, g.cells, g.missing, g.s, g.level, g.wanted
