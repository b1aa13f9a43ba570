"""Tree ensembles for regression (M7, M8, M9): histogram boosting, forests and extra-trees, many models in one go.

*Rows.* Features are cut once into at most 256 bins at quantiles (mergeable sketches, one pass) and packed into blocks of
rows: a byte a feature, and 32-bit values for extra-trees. Columns of one one-hot group are one byte together, since at
most one of them is 1. Targets become integers (a fixed power of two times the target), so that every sum of them is exact
and a tree does not depend on how rows are dealt to tasks.

*Levels.* A tree grows level by level. For every open node, feature and bin the sums of gradients, weights and rows give
the second-order gain of each cut, with L1 and L2 penalties and a least gain; with a limit on leaves, the open nodes that
can still be among the best are widened first and the tree is cut back to the best ones (leaf-wise growth). Extra-trees draw
one cut for each node and feature between the node's least and greatest value. Rows and columns of a tree, bootstrap
weights (Poisson) and cuts come from hashes of the row's id, the tree and the node.

*Ways to run.* Up to ``LOCAL_BYTES`` of rows, a model (or a batch of a forest's trees) is one task, which reads the blocks from
the files they were written to (no copy of them is shuffled); all models, folds and trials run side by side in one job, and each
tree leaves its task as a row. Few boosted models of many rows, whose trees must wait for each other, are grown by all tasks of a
barrier stage together, which tell each other what they found in files of the shared folder. Either each task holds a share of
the rows, columns of few bins packed together in a byte, adds up all columns of its rows and gives each other task the sums of
that task's columns; or, where sums are more than rows, each holds all rows and adds up its share of the columns. Beyond, each
level of all models in flight is one pass in which tasks
give partial sums for (model, node, feature), which Spark adds up before the best cuts come to the driver. All ways make the
same trees.

A fitted ensemble is a table with a row for each tree, so it does not pass through the driver; ``transform`` sends a small one
to the tasks, and of a large one tasks read one tree after another from the table's files.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit.operators.knn import _store
from leasekit.session import _tables, materialize

#: Bytes of binned rows that one group may hold; beyond, levels are distributed passes.
LOCAL_BYTES = 384 << 20
#: Rows of a block; trees of a forest in one group; bytes of trees that are sent to the tasks at once.
BLOCK_ROWS, FOREST_BATCH, SENT_BYTES = 8192, 5, 192 << 20
BINS = 256
#: Rows of a level up to which the entries of all columns are sorted together.
FEW_ROWS = 4096
#: Entries (row x column) of a group up to which all columns are worked on at once; beyond, one after the other, so that a
#: task needs a few numbers a row besides the bytes.
FLAT_ENTRIES = 1 << 22
#: Entries (row x column) from which tasks share the columns of a boosted tree, the most tasks that do so, and the most
#: nodes that one level may have.
SHARED_ENTRIES, SHARED_TASKS, SHARED_NODES = 1 << 22, 16, 1 << 12
#: Bytes of sums that such a task gives out at once, and those that cost as much as a row held by every task, for each tree.
MEET_BYTES, ROW_COSTS = 32 << 20, 200
#: Bytes of sums that a task holds in one distributed pass; further trees and nodes wait for the next.
PASS_BYTES = 128 << 20
#: Blocks that a distributed pass takes at once.
TOGETHER = 16
#: Bytes of feature rows that a task holds while it reads the trees of a large ensemble.
HELD_BYTES = 32 << 20
#: Bytes of finished trees that the driver holds before they are written.
PENDING_BYTES = 32 << 20
#: Values that stand for a feature while its bins are sought.
SUMMARY = 4096
#: After so many boosted trees the distributed way writes the predictions so far.
WRITE_EVERY = 10
_TREE = "model int, tree int, feature binary, cut binary, left binary, right binary, value binary, gain binary"
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


# ------------------------------------------------------------------ parameters
@dataclass(frozen=True)
class Trees:
    """Parameters of an ensemble; ``kind``: boost, forest or extra. ``skip_fold``: rows of this fold are not learned from."""

    kind: str
    trees: int = 300
    rate: float = 0.05
    depth: int | None = 6
    leaves: int | None = None
    least_rows: int = 1
    least_to_split: int = 2
    rows_share: float = 1.0
    columns_share: float = 1.0
    l1: float = 0.0
    l2: float = 0.0
    least_gain: float = 0.0
    seed: int = 42
    skip_fold: int | None = None
    labelCol: str = "label"
    featuresCol: str = "features"
    predictionCol: str = "prediction"

    def fit(self, df: DataFrame) -> Ensemble:
        return fit_all([self], df)[0]


def mix(*parts) -> np.ndarray:
    """A 64-bit hash of integers or integer arrays (splitmix64 steps)."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
    return h


def unit(*parts) -> np.ndarray:
    """A uniform number in [0, 1) from integers."""
    return (mix(*parts) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def row_weights(spec: Trees, tree: int, ids: np.ndarray) -> np.ndarray | None:
    """How often each row counts in a tree (None: once)."""
    if spec.kind == "forest":
        return np.searchsorted(_POISSON, unit(spec.seed, tree, ids, 1), "right").astype(np.float64)
    if spec.rows_share < 1:
        return (unit(spec.seed, tree, ids, 2) < spec.rows_share).astype(np.float64)
    return None


def tree_columns(spec: Trees, tree: int, n: int) -> np.ndarray:
    """Which features a tree may use (extra-trees draw them anew at each node)."""
    if spec.kind == "extra" or spec.columns_share >= 1:
        return np.ones(n, bool)
    place = np.argsort(mix(spec.seed, tree, np.arange(n), 3), kind="stable")
    chosen = np.zeros(n, bool)
    chosen[place[:max(1, math.ceil(spec.columns_share * n))]] = True
    return chosen


# ------------------------------------------------------------------ bins
@dataclass
class Layout:
    """Byte columns: ``members`` are the features of each (one, or a one-hot group), ``edges`` the upper ends of bins."""

    members: list[list[int]]
    edges: list[np.ndarray]
    width: int
    scale: float
    mean: float
    rows: int

    def __post_init__(self) -> None:
        self.sizes = [len(m) + 1 if len(m) > 1 else len(e) + 1 for m, e in zip(self.members, self.edges)]
        self.column_of, self.code_of, self.slot = (np.zeros(self.width, np.int64) for _ in range(3))
        for c, m in enumerate(self.members):
            self.column_of[m], self.code_of[m] = c, np.arange(1, len(m) + 1)
        self.single = np.array([m[0] for m, size in zip(self.members, self.sizes) if len(m) == 1 and size > 1], np.int64)
        self.slot[self.single] = np.arange(len(self.single))
        self.grouped = np.array([len(m) > 1 for m in self.members], bool)

    @property
    def vary(self) -> np.ndarray:
        """Features that have two values at least."""
        return np.array([f for m, size in zip(self.members, self.sizes) if size > 1 for f in m], np.int64)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bytes (column x row) of 32-bit feature rows."""
        out = np.zeros((len(self.members), len(x)), np.uint8)
        for c, (m, e) in enumerate(zip(self.members, self.edges)):
            if len(m) > 1:
                block = x[:, m] > 0.5
                out[c] = np.where(block.any(1), block.argmax(1) + 1, 0)
            else:
                out[c] = np.searchsorted(e, x[:, m[0]], "left")
        return out


def one_hot_groups(names: Sequence[str] | None, width: int) -> list[list[int]]:
    """Features that are 0/1 columns of one category (``low_card__<column>_<level>``), at most 255 in a group."""
    found: dict[str, list[int]] = {}
    for k, name in enumerate(names or []):
        for column in ONE_HOT:
            if name.startswith(f"low_card__{column}_"):
                found.setdefault(column, []).append(k)
    groups = [g[a:a + BINS - 1] for g in found.values() for a in range(0, len(g), BINS - 1)]
    grouped = {k for g in groups for k in g}
    return sorted([*groups, *([k] for k in range(width) if k not in grouped)], key=lambda g: g[0])


def _one_hot_columns() -> tuple[str, ...]:
    from leasekit import presets

    return tuple(sorted({c for c, roles in presets.COLUMN_ROLES.items() if "low_card" in roles}, key=len, reverse=True))


ONE_HOT = _one_hot_columns()


def feature_names(df: DataFrame, features: str) -> list[str] | None:
    attrs = (df.schema[features].metadata or {}).get("ml_attr", {}).get("attrs", {})
    named = {a["idx"]: a.get("name") for kind in attrs.values() for a in kind}
    return [named.get(k) or str(k) for k in range(len(named))] or None


def summarise(value: np.ndarray, weight: np.ndarray, most: int = SUMMARY) -> tuple[np.ndarray, np.ndarray]:
    """Different values, rising, and their weights; over ``most`` values, those at equal steps of weight stand for the rest
    (the least and the greatest stay). Summaries of parts can be summarised again."""
    value, where = np.unique(value, return_inverse=True)
    weight = np.bincount(where, weight, len(value))
    if len(value) <= most:
        return value, weight
    upto = np.cumsum(weight)
    at = np.unique(np.append(0, np.searchsorted(upto, np.arange(1, most) / (most - 1) * upto[-1] * (1 - 1e-12))))
    return value[at], np.diff(np.append(0.0, upto[at]))


def bin_edges(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Upper ends of bins of about equal weight, fewer than BINS; above the last there is at least one value."""
    upto = np.cumsum(weight)
    at = np.unique(np.searchsorted(upto, np.arange(1, BINS) / BINS * upto[-1], "left"))
    return value[at[value[at] < value[-1]]]


def layout(df: DataFrame, label: Column, features: str, names: Sequence[str] | None = None) -> Layout:
    """Bins, the scale of targets, their mean and the number of rows: two aggregations over the rows to learn from."""
    rows = df.select(label.cast("double").alias("y"), vector_to_array(features, "float32").alias("x")).where("y is not null")
    first = rows.agg(F.max(F.size("x")).alias("width"), F.count("y").alias("n"), F.avg("y").alias("mean"), F.max(F.abs("y")).alias("most")).first()
    width, n = first.width or 0, first.n
    groups = one_hot_groups(names, width)
    single = [g[0] for g in groups if len(g) == 1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width).astype(np.float32)
            for k in single:
                v, w = held.get(k, (np.zeros(0, np.float32), np.zeros(0)))
                held[k] = summarise(np.append(v, x[:, k]), np.append(w, np.ones(len(x))))
        yield pa.record_batch([pa.array(list(held), pa.int32()), *(pa.array([h[i].astype(t).tobytes() for h in held.values()], pa.binary()) for i, t in ((0, "<f4"), (1, "<f8")))], names=["feature", "value", "weight"])

    def whole(key, group):
        v, w = np.zeros(0, np.float32), np.zeros(0)
        for r in group.select(["value", "weight"]).to_pylist():
            v, w = summarise(np.append(v, np.frombuffer(r["value"], "<f4")), np.append(w, np.frombuffer(r["weight"], "<f8")))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([bin_edges(v, w).astype("<f4").tobytes()], pa.binary())], names=["feature", "edges"])

    made = rows.select("x").mapInArrow(part, "feature int, value binary, weight binary").groupBy("feature").applyInArrow(whole, "feature int, edges binary")
    edges = {r.feature: np.frombuffer(r.edges, "<f4") for r in made.collect()}  # a row a feature
    # Sums of n targets (up to twice as far from the mean) stay exact in doubles.
    reach = 2.0 * (first.most or 1.0) * max(n, 1) * 16
    none = np.zeros(0, np.float32)
    return Layout(groups, [edges.get(g[0], none) if len(g) == 1 else none for g in groups], width, 2.0 ** math.floor(52 - math.log2(reach)), float(first.mean or 0.0), int(n))


def blocks(df: DataFrame, label: Column, features: str, lay: Layout, id_column: str, fold: Column | None, raw: bool) -> DataFrame:
    """``n, codes, x, y, ids, folds``: rows packed as bytes; ``x`` are the values of features that vary, outside one-hot groups."""
    key = F.xxhash64(id_column)
    rows = df.select(label.cast("double").alias("y"), vector_to_array(features, "float32").alias("x"), key.alias("id"), (fold if fold is not None else F.lit(0)).cast("int").alias("fold"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = -(-batch.num_rows // max(1, -(-batch.num_rows // BLOCK_ROWS)))  # blocks of one size: tasks get as many rows
            for at in range(0, batch.num_rows, max(size, 1)):
                b = batch.slice(at, size)
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, lay.width).astype(np.float32)
                data = [lay.codes(x).tobytes(), np.ascontiguousarray(x[:, lay.single].T).tobytes() if raw else b"", *(b.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes() for c, t in (("y", "<f8"), ("id", "<i8"), ("fold", "<i4")))]
                yield pa.record_batch([pa.array([b.num_rows]), *(pa.array([d], pa.binary()) for d in data)], names=["n", "codes", "x", "y", "ids", "folds"])

    return rows.where("y is not null").mapInArrow(make, "n long, codes binary, x binary, y binary, ids binary, folds binary")


class Rows:
    """Blocks as arrays."""

    def __init__(self, lay: Layout, parts: list[dict]) -> None:
        n = [p["n"] for p in parts]
        read = lambda c, t: np.concatenate([np.frombuffer(p[c], t) for p in parts])
        grid = lambda c, t, k: np.concatenate([np.frombuffer(p[c], t).reshape(k, m) for p, m in zip(parts, n)], 1)
        self.codes = grid("codes", np.uint8, len(lay.members))
        self.x = grid("x", np.float32, len(lay.single)) if len(parts[0]["x"]) else None
        self.y, self.ids, self.folds = read("y", "<f8"), read("ids", "<i8"), read("folds", "<i4")

    def pick(self, rows: np.ndarray) -> Rows:
        out = object.__new__(Rows)
        out.codes, out.x = self.codes[:, rows], None if self.x is None else self.x[:, rows]
        out.y, out.ids, out.folds = self.y[rows], *(v[rows] if len(v) else v for v in (self.ids, self.folds))  # not read: none
        return out

    def alike(self) -> tuple[np.ndarray, np.ndarray] | None:
        """A row for each different row of features, and which of them each row is; None if most rows differ."""
        if not len(self.y) or not len(self.codes):
            return None
        if self.x is None:
            return same_bytes(self.codes)
        seen = np.concatenate([self.codes.T, np.ascontiguousarray(self.x.T).view(np.uint8)], 1)
        first, which = different_rows(seen)
        return None if isinstance(first, slice) else (first, which)

    def values(self, lay: Layout, features: np.ndarray, which: np.ndarray) -> np.ndarray:
        """32-bit values (feature x row); of a one-hot group they follow from its byte."""
        out = np.empty((len(features), len(which)), np.float32)
        for k, f in enumerate(features):
            c = lay.column_of[f]
            out[k] = self.codes[c][which] == lay.code_of[f] if lay.grouped[c] else self.x[lay.slot[f]][which]
        return out

    def value(self, lay: Layout, feature: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The 32-bit value of one feature for each row."""
        column = lay.column_of[feature]
        out = (self.codes[column, which] == lay.code_of[feature]).astype(np.float32)
        plain = ~lay.grouped[column]
        if plain.any():
            out[plain] = self.x[lay.slot[feature[plain]], which[plain]]
        return out


# ------------------------------------------------------------------ splits
def shrink(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0) if l1 else g


@dataclass
class Cuts:
    """The best cut of each open node: gain (-inf: none), feature, code (or value, for extra-trees)."""

    gain: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray | None = None  # sums (gradients, weights, rows) of what goes left, if known

    @classmethod
    def none(cls, m: int) -> Cuts:
        return cls(np.full(m, -np.inf), np.full(m, -1), np.zeros(m))

    @classmethod
    def together(cls, parts: list[Cuts]) -> Cuts:
        known = any(p.left is not None for p in parts)
        left = np.concatenate([np.zeros((3, len(p.gain))) if p.left is None else p.left for p in parts], 1) if known else None
        return cls(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("gain", "feature", "cut")), left)

    def offer(self, gain: np.ndarray, feature: int | np.ndarray, cut: np.ndarray, left: np.ndarray | None = None) -> None:
        better = gain > self.gain
        if left is not None:
            self.left = np.zeros((3, len(gain))) if self.left is None else self.left
            self.left[:, better] = left[:, better]
        self.gain[better], self.cut[better] = gain[better], cut[better]
        self.feature[better] = feature[better] if isinstance(feature, np.ndarray) else feature


class Gain:
    """Second-order gain of cuts (squared error: the second derivative of a row is its weight)."""

    def __init__(self, spec: Trees, scale: float) -> None:
        self.spec, self.l1, self.l2 = spec, spec.l1 * scale, spec.l2
        self.unit = scale * scale

    def score(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        g = shrink(g, self.l1)
        return g * g / np.maximum(h + self.l2, 1e-300)

    def of(self, gl, hl, nl, g, h, n) -> np.ndarray:
        """Of cuts with sums ``gl, hl, nl`` on one side of nodes with ``g, h, n``; -inf where a side is too small."""
        out = (self.score(gl, hl) + self.score(g - gl, h - hl) - self.score(g, h)) / self.unit
        least = max(self.spec.least_rows, 1)
        return np.where((nl >= least) & (n - nl >= least), out, -np.inf)

    def floor(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Gains must exceed this: the least gain, and what rounding may leave of nothing."""
        return self.spec.least_gain + 1e-12 * self.score(g, h) / self.unit + 1e-14


class Cells:
    """The bins of a tree's columns in one row of cells: sums and best cuts of a whole level in a few array operations."""

    def __init__(self, lay: Layout, drawn: np.ndarray) -> None:
        sizes = lay.sizes
        self.columns = [c for c, size in enumerate(sizes) if size >= 2 and drawn[lay.members[c]].any()]
        self.offsets = np.cumsum([0] + [sizes[c] for c in self.columns])
        self.width = int(self.offsets[-1])
        self.start, self.code, self.feature = np.zeros(self.width, np.int64), np.zeros(self.width), np.zeros(self.width, np.int64)
        self.blocked, self.group = np.zeros(self.width, bool), np.zeros(self.width, bool)
        for c, a, b in zip(self.columns, self.offsets[:-1], self.offsets[1:]):
            members = np.array(lay.members[c])
            self.start[a:b], self.code[a:b], self.feature[a:b] = a, np.arange(b - a), members[0]
            if len(members) > 1:  # one level against the others; code 0 is none of them
                self.feature[a + 1:b], self.group[a:b] = members, True
                self.blocked[a], self.blocked[a + 1:b] = True, ~drawn[members]

    def flat(self, codes: np.ndarray) -> np.ndarray:
        """Cell (row x column) of byte columns."""
        return codes[self.columns].T + self.offsets[:-1]

    def sums(self, flat: np.ndarray, node: np.ndarray, m: int, g: np.ndarray, h: np.ndarray | None) -> np.ndarray:
        """Sums (gradients, weights, rows) x node x cell."""
        cell = (flat + (node * self.width)[:, None]).ravel()
        add = lambda w: np.bincount(cell, None if w is None else np.repeat(w, flat.shape[1]), m * self.width).astype(np.float64)
        n = add(None)
        return np.stack([add(g), n if h is None else add(h), n]).reshape(3, m, self.width)

    def best(self, sums: np.ndarray, total: np.ndarray, gain: Gain, out: Cuts) -> None:
        upto = np.concatenate([np.zeros((*sums.shape[:2], 1)), np.cumsum(sums, 2)], 2)
        side = upto[:, :, 1:] - upto[:, :, self.start]
        side[:, :, self.group] = sums[:, :, self.group]
        gains = gain.of(*side, *total[:, :, None])
        gains[:, self.blocked] = -np.inf
        at = gains.argmax(1)
        out.offer(gains[np.arange(len(at)), at], self.feature[at], self.code[at])

    def best_of_rows(self, flat: np.ndarray, node: np.ndarray, m: int, g: np.ndarray, h: np.ndarray | None, total: np.ndarray, gain: Gain, out: Cuts) -> None:
        """The same from few rows: their entries sorted by (node, cell), so that empty cells cost nothing."""
        entry = np.sort((((flat + (node * self.width)[:, None]) << 22) | np.arange(len(node))[:, None]).ravel())
        cell, row = entry >> 22, entry & ((1 << 22) - 1)
        last = np.flatnonzero(np.append(cell[1:] != cell[:-1], True))
        cell = cell[last]
        here, c = cell // self.width, cell % self.width
        column = cell - c + self.start[c]
        begins = np.append(True, column[1:] != column[:-1])
        first = np.append(0, last[:-1] + 1)  # of each cell
        base = np.where(self.group[c], first, first[np.maximum.accumulate(np.where(begins, np.arange(len(cell)), 0))])

        def between(w: np.ndarray) -> np.ndarray:
            upto = np.append(0, np.cumsum(w[row].astype(np.int64)))  # whole numbers: exact over all columns
            return (upto[last + 1] - upto[base]).astype(np.float64)

        n = (last + 1 - base).astype(np.float64)
        gains = gain.of(between(g), n if h is None else between(h), n, *(t[here] for t in total))
        gains[self.blocked[c]] = -np.inf
        starts = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
        top = np.maximum.reduceat(gains, starts)
        hit = np.flatnonzero(gains == np.repeat(top, np.diff(np.append(starts, len(here)))))
        hit = hit[np.append(True, here[hit][1:] != here[hit][:-1])]
        best, feature, code = np.full(m, -np.inf), np.full(m, -1), np.zeros(m)
        best[here[hit]], feature[here[hit]], code[here[hit]] = gains[hit], self.feature[c[hit]], self.code[c[hit]]
        out.offer(best, feature, code)


def histogram(codes: np.ndarray, node: np.ndarray, m: int, size: int, g: np.ndarray, h: np.ndarray | None) -> np.ndarray:
    """Sums (gradients, weights, rows) x node x bin."""
    cell = node * size + codes
    if h is None:
        n = np.bincount(cell, minlength=m * size).astype(np.float64)
        both = n
    elif len(cell) < 1 << 22:  # weights are below 16: both sums fit in one double
        both = np.bincount(cell, h + 2.0 ** 26, m * size)
        n = np.floor(both * 2.0 ** -26)
        both -= n * 2.0 ** 26
    else:
        n, both = np.bincount(cell, minlength=m * size).astype(np.float64), np.bincount(cell, h, m * size)
    return np.stack([np.bincount(cell, g, m * size), both, n]).reshape(3, m, size)


def best_of_bins(sums: np.ndarray, total: np.ndarray, gain: Gain, group: bool) -> tuple[np.ndarray, np.ndarray]:
    """Best gain and code of each node from sums (3 x node x bin); of a one-hot group, one level against the others."""
    side = sums[:, :, 1:] if group else np.cumsum(sums, 2)[:, :, :-1]
    if not side.shape[2]:
        return np.full(sums.shape[1], -np.inf), np.zeros(sums.shape[1])
    gains = gain.of(*side, *total[:, :, None])
    at = gains.argmax(1)
    return gains[np.arange(len(at)), at], at + (1.0 if group else 0.0)


def best_of_sorted(codes: np.ndarray, node: np.ndarray, m: int, size: int, g: np.ndarray, h: np.ndarray | None, total: np.ndarray, gain: Gain) -> tuple[np.ndarray, np.ndarray]:
    """The same for many nodes of few rows each: rows sorted by (node, bin) in place of a bin for each pair."""
    order = np.sort((node * size + codes) << 32 | np.arange(len(node)))
    cell, row = order >> 32, order & 0xFFFFFFFF
    at = cell // size
    last = np.flatnonzero(np.append((cell[1:] != cell[:-1]) & (at[1:] == at[:-1]), False))  # a bin ends, its node does not
    best, cut = np.full(m, -np.inf), np.zeros(m)
    if not len(last):
        return best, cut
    first = np.searchsorted(at, np.arange(m))  # of each node
    here = at[last]

    def upto(w: np.ndarray) -> np.ndarray:
        s = np.concatenate([[0.0], np.cumsum(w)])
        return s[last + 1] - s[first[here]]

    nl = (last + 1 - first[here]).astype(np.float64)
    hl = nl if h is None else upto(h[row])
    gains = gain.of(upto(g[row]), hl, nl, *(t[here] for t in total))
    starts = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
    top = np.maximum.reduceat(gains, starts)
    nodes = here[starts]
    hit = np.flatnonzero(gains == np.repeat(top, np.diff(np.append(starts, len(here)))))
    hit = hit[np.append(True, here[hit][1:] != here[hit][:-1])]
    best[nodes], cut[nodes] = top, (cell[last[hit]] % size).astype(np.float64)
    return best, cut


def random_cuts(spec: Trees, tree: int, nodes: np.ndarray, low: np.ndarray, high: np.ndarray, features: np.ndarray) -> np.ndarray:
    """One 32-bit cut for each feature and node (feature x node) in [low, high); nan where the node has one value or the
    feature is not drawn for the node."""
    features = features[:, None]
    at = (low + unit(spec.seed, tree, nodes[None, :], features, 4) * (high.astype(np.float64) - low)).astype(np.float32)
    at = np.where(at >= high, low, at)
    at[low >= high] = np.nan
    if spec.columns_share < 1:
        drawn = min(max(1, math.ceil(spec.columns_share * len(low))), len(low))
        place = mix(spec.seed, tree, nodes[None, :], features, 5)
        # features without two values do not use up a draw
        place = np.where(np.isnan(at), np.uint64(2 ** 64 - 1), place)
        limit = np.sort(place, 0)[drawn - 1]
        at[place > limit] = np.nan
    return at


def best_random(cuts: np.ndarray, gl: np.ndarray, nl: np.ndarray, total: np.ndarray, gain: Gain, out: Cuts, features: np.ndarray) -> None:
    if not len(features):
        return
    gains = np.where(np.isnan(cuts), -np.inf, gain.of(gl, nl, nl, *total[:, None, :]))
    f = gains.argmax(0)
    out.offer(gains[f, np.arange(len(f))], features[f], cuts[f, np.arange(len(f))].astype(np.float64))


# ------------------------------------------------------------------ one tree
class Growing:
    """A tree while it grows: node arrays as lists, the open nodes, and the sums of every node."""

    def __init__(self, spec: Trees, number: int, lay: Layout) -> None:
        self.spec, self.number, self.lay, self.gain = spec, number, lay, Gain(spec, lay.scale)
        self.feature, self.cut, self.left, self.right, self.got, self.sums, self.level = [-1], [0.0], [-1], [-1], [0.0], [None], [0]
        self.found: dict[int, tuple[float, int, float]] = {}
        self.open = [0]
        self.columns = tree_columns(spec, number, lay.width)
        self.column_of, self.grouped = lay.column_of, lay.grouped
        self.parent: list[int] = [-1]
        self.parts: list[tuple[Cuts, np.ndarray]] = []  # of the first open nodes, while a level takes several passes

    def allowed(self, c: int) -> bool:
        members = self.lay.members[c]
        return bool(self.columns[members].any())

    def take(self, cuts: Cuts, totals: np.ndarray) -> None:
        """The best cuts of the open nodes (in order) and their sums; then widens what may be widened and opens its children."""
        spec = self.spec
        able = (cuts.feature >= 0) & (totals[2] >= max(spec.least_to_split, 2)) & (cuts.gain > self.gain.floor(totals[0], totals[1]))
        each = totals.T.copy()
        for k, node in enumerate(self.open):
            self.sums[node] = each[k]
        for k, gain, feature, cut in zip(*(v.tolist() for v in (np.flatnonzero(able), cuts.gain[able], cuts.feature[able], cuts.cut[able]))):
            if spec.depth is None or self.level[self.open[k]] < spec.depth:
                self.found[self.open[k]] = (gain, int(feature), cut)
        if spec.leaves is None:
            wide = [n for n in self.open if n in self.found]
        else:
            chosen, waiting, leaves = self.chosen()
            room = spec.leaves - leaves
            wide = sorted(waiting, key=lambda n: (-self.found[n][0], n))[:max(room, 0)] if room > 0 else []
        self.widened = wide
        # Children that may not be cut need their sums only, which follow from the cut's.
        place = {node: k for k, node in enumerate(self.open)} if cuts.left is not None and spec.leaves is None else {}
        self.open = []
        for node in wide:
            gain, feature, cut = self.found[node]
            self.feature[node], self.cut[node], self.got[node] = feature, cut, gain
            self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
            for child in (self.left[node], self.right[node]):
                self.feature.append(-1)
                self.cut.append(0.0)
                self.left.append(-1)
                self.right.append(-1)
                self.got.append(0.0)
                self.sums.append(None)
                self.level.append(self.level[node] + 1)
                self.parent.append(node)
                if node in place and self.level[child] == spec.depth:
                    side = cuts.left[:, place[node]]
                    self.sums[child] = side if child == self.left[node] else totals[:, place[node]] - side
                else:
                    self.open.append(child)

    def chosen(self) -> tuple[set[int], list[int], int]:
        """Best-first choice among what is known: nodes to cut, cuttable nodes not yet widened, and leaves so far."""
        cut: set[int] = set()
        waiting: list[int] = []
        heap = [(-self.found[0][0], 0)] if 0 in self.found else []
        leaves = 1
        while heap and leaves < self.spec.leaves:
            _, node = heapq.heappop(heap)
            if self.left[node] < 0:
                waiting.append(node)  # what its children gain is not known yet: the choice ends here
                waiting += [n for _, n in heap if self.left[n] < 0]
                return cut, waiting, leaves
            cut.add(node)
            leaves += 1
            for child in (self.left[node], self.right[node]):
                if child in self.found:
                    heapq.heappush(heap, (-self.found[child][0], child))
        return cut, [], leaves

    def arrays(self) -> dict[str, np.ndarray]:
        """The finished tree: cut back to its chosen nodes, cuts as feature values, leaf values in units of the target."""
        keep = None if self.spec.leaves is None else self.final()
        shown = [0]
        number = {0: 0}
        for node in shown:
            if self.left[node] >= 0 and (keep is None or node in keep):
                for child in (self.left[node], self.right[node]):
                    number[child] = len(shown)
                    shown.append(child)
        m = len(shown)
        feature, cut = np.zeros(m, np.int32), np.full(m, np.inf, np.float32)
        left, right, value, gain = np.arange(m, dtype=np.int32), np.arange(m, dtype=np.int32), np.zeros(m), np.zeros(m, np.float32)
        for k, node in enumerate(shown):
            g, h, _ = self.sums[node]
            value[k] = -float(shrink(np.float64(g), self.gain.l1)) / max(h + self.gain.l2, 1e-300) / self.lay.scale
            if self.left[node] in number:
                feature[k], cut[k], gain[k] = self.feature[node], self.value_of(node), self.got[node]
                left[k], right[k] = number[self.left[node]], number[self.right[node]]
        if self.spec.kind == "boost":
            value *= self.spec.rate
        self.number_of = number
        return {"feature": feature, "cut": cut, "left": left, "right": right, "value": value, "gain": gain}

    def final(self) -> set[int]:
        return self.chosen()[0]

    def value_of(self, node: int) -> np.float32:
        f = self.feature[node]
        if self.spec.kind == "extra":
            return np.float32(self.cut[node])
        c = self.column_of[f]
        return np.float32(0.5) if len(self.lay.members[c]) > 1 else self.lay.edges[c][int(self.cut[node])]

    def goes_left(self, rows: Rows, feature: np.ndarray, cut: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Whether rows ``which`` go left at cuts ``feature, cut`` (one each)."""
        if self.spec.kind == "extra":
            return rows.value(self.lay, feature, which) <= cut.astype(np.float32)
        column = self.column_of[feature]
        code = rows.codes[column, which]
        return np.where(self.grouped[column], code != cut, code <= cut)

    def descend(self, rows: Rows, at: np.ndarray) -> np.ndarray:
        """Node of each row after the last widening, given that before it."""
        if not self.widened:
            return at
        here = np.full(len(self.feature), -1)
        here[self.widened] = np.arange(len(self.widened))
        k = here[at]
        which = np.flatnonzero(k >= 0)
        k = k[which]
        take = lambda x: np.array([x[n] for n in self.widened])[k]
        goes = self.goes_left(rows, take(self.feature), take(self.cut), which)
        at = at.copy()
        at[which] = np.where(goes, take(self.left), take(self.right))
        return at

    def place(self, rows: Rows) -> np.ndarray:
        """Node of each row, from the root."""
        at = np.zeros(len(rows.y), np.int64)
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.cut, self.left, self.right))
        while True:
            which = np.flatnonzero(left[at] >= 0)
            if not len(which):
                return at
            node = at[which]
            at[which] = np.where(self.goes_left(rows, feature[node], cut[node], which), left[node], right[node])

    def leaf_values(self, arrays: dict[str, np.ndarray]) -> np.ndarray:
        """What each node (numbered as while growing) adds to a row's prediction."""
        out = np.zeros(len(self.feature))
        for node in range(len(self.feature)):
            at = node
            while at not in self.number_of:
                at = self.parent[at]
            out[node] = arrays["value"][self.number_of[at]]
        return out


def gradients(spec: Trees, lay: Layout, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Whole numbers: scaled first derivatives of the squared error (forests: minus the centred target)."""
    return np.rint(((margin - y) if spec.kind == "boost" else (lay.mean - y)) * lay.scale)


def local_tree(spec: Trees, number: int, lay: Layout, rows: Rows, margin: np.ndarray) -> tuple[Growing, dict[str, np.ndarray], np.ndarray]:
    """One tree from rows in memory, and the node of every row."""
    tree = Growing(spec, number, lay)
    tree.sums_of = {}
    if spec.kind != "extra":
        tree.cells = Cells(lay, tree.columns)
        few = len(rows.y) * len(tree.cells.columns) <= FLAT_ENTRIES
        tree.flat = tree.cells.flat(rows.codes) if tree.cells.width and few else None
    weight = row_weights(spec, number, rows.ids)
    grad = gradients(spec, lay, rows.y, margin)
    if weight is not None:
        grad = grad * weight
    many = weight if spec.kind == "forest" else None
    at = np.zeros(len(rows.y), np.int64)
    used = np.ones(len(rows.y), bool) if weight is None else weight > 0
    while tree.open:
        place = np.full(len(tree.feature), -1)
        place[tree.open] = np.arange(len(tree.open))
        node = place[at]
        which = np.flatnonzero((node >= 0) & used)
        node, g, h = node[which], grad[which], None if many is None else many[which]
        m = len(tree.open)
        n = np.bincount(node, minlength=m).astype(np.float64)
        totals = np.stack([np.bincount(node, g, m), n if h is None else np.bincount(node, h, m), n])
        cuts = Cuts.none(m)
        if spec.depth is None or tree.level[tree.open[0]] < spec.depth or spec.leaves is not None:
            if spec.kind == "extra":
                _local_random(spec, tree, rows, which, node, g, totals, cuts)
            else:
                _local_bins(spec, tree, rows, which, node, g, h, totals, cuts)
        tree.take(cuts, totals)
        at = tree.descend(rows, at)
    return tree, tree.arrays(), at


def _local_bins(spec, tree, rows, which, node, g, h, totals, cuts) -> None:
    """While there are fewer cells than entries, sums of cells: of two children the one with more rows has the parent's less
    the other's. Then nodes hold few rows each, and rows are sorted instead."""
    m, lay = len(tree.open), tree.lay
    # Nodes that can be cut at all; the others' rows need no sums.
    able = totals[2] >= max(2 * spec.least_rows, spec.least_to_split, 2)
    cells = tree.cells
    if not cells.width:
        return
    if (tree.flat is not None or spec.kind == "boost") and m * cells.width <= max(len(which) * len(cells.columns) // 2, 1 << 15):
        pairs = np.array([tree.parent[n] in tree.sums_of for n in tree.open])
        derived = np.zeros(m, bool)  # by subtraction
        for a in range(0, m - 1, 2):
            if pairs[a]:
                derived[a if totals[2, a] > totals[2, a + 1] else a + 1] = True
        wanted = able.copy()
        for a in range(0, m - 1, 2):
            if pairs[a] and able[a:a + 2].any():
                wanted[a:a + 2] = True
        direct = np.flatnonzero(wanted & ~derived)
        number = np.full(m, -1)
        number[direct] = np.arange(len(direct))
        keep = number[node] >= 0
        picked = which[keep], number[node[keep]], len(direct), g[keep], None if h is None else h[keep]
        sums = np.zeros((3, m, cells.width))
        if tree.flat is not None:
            sums[:, direct] = cells.sums(tree.flat[picked[0]], *picked[1:])
        else:
            for c, a, b in zip(cells.columns, cells.offsets[:-1], cells.offsets[1:]):
                sums[:, direct, a:b] = histogram(rows.codes[c][picked[0]], *picked[1:3], b - a, *picked[3:])
        for k in np.flatnonzero(wanted & derived):
            sums[:, k] = tree.sums_of[tree.parent[tree.open[k]]] - sums[:, k ^ 1]
        if tree.flat is not None:
            cells.best(sums, totals, tree.gain, cuts)
        else:
            for c, a, b in zip(cells.columns, cells.offsets[:-1], cells.offsets[1:]):
                _offer_column(tree, c, sums[:, :, a:b], totals, cuts)
        cuts.gain[~able] = -np.inf
        for n in {tree.parent[n] for n in tree.open}:
            tree.sums_of.pop(n, None)
        if spec.kind == "boost":  # forests soon have too many nodes
            tree.sums_of.update({n: sums[:, k] for k, n in enumerate(tree.open) if able[k]})
        return
    tree.sums_of.clear()
    if not able.all():
        keep = able[node]
        which, node, g, h = which[keep], node[keep], g[keep], None if h is None else h[keep]
    if not len(which):
        return
    if tree.flat is None:  # neighbours in a node are added up in the same place
        order = by_node(node)
        which, node, g, h = which[order], node[order], g[order], None if h is None else h[order]
    if len(which) <= FEW_ROWS:
        cells.best_of_rows(cells.flat(rows.codes[:, which]) if tree.flat is None else tree.flat[which], node, m, g, h, totals, tree.gain, cuts)
        return
    sizes = lay.sizes
    for c in cells.columns:
        codes = rows.codes[c][which]
        if len(lay.members[c]) > 1 or m * sizes[c] <= 2 * len(which):
            _offer_column(tree, c, histogram(codes, node, m, sizes[c], g, h), totals, cuts)
        else:
            gain, at = best_of_sorted(codes, node, m, sizes[c], g, h, totals, tree.gain)
            cuts.offer(gain, lay.members[c][0], at)


def by_node(node: np.ndarray) -> np.ndarray:
    """Places of rows in the order of their nodes (one sort of whole numbers)."""
    return np.sort(node << 32 | np.arange(len(node))) & 0xFFFFFFFF


def _offer_column(tree: Growing, c: int, sums: np.ndarray, totals: np.ndarray, cuts: Cuts) -> None:
    """Offers the best cuts of one column from its sums (3 x node x bin)."""
    members = np.array(tree.lay.members[c])
    group = len(members) > 1
    if group and not tree.columns[members].all():
        sums = sums.copy()
        sums[2, :, 1:][:, ~tree.columns[members]] = 0  # features that the tree has not drawn
    gain, at = best_of_bins(sums, totals, tree.gain, group)
    cuts.offer(gain, members[at.astype(np.int64) - 1] if group else int(members[0]), at)


def _local_random(spec, tree, rows, which, node, g, totals, cuts) -> None:
    able = totals[2] >= max(2 * spec.least_rows, spec.least_to_split, 2)
    which, node, g = which[able[node]], node[able[node]], g[able[node]]
    if not len(which):
        return
    order = by_node(node)
    which, node, g = which[order], node[order], g[order]
    starts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    ends = np.append(starts[1:], len(node))
    step = max(1, FLAT_ENTRIES // max(len(tree.lay.vary), 1))
    for a in range(0, len(starts), step):  # as many nodes as a grid of (feature x node) may hold
        begin, end = starts[a], ends[min(a + step, len(starts)) - 1]
        _random_of_nodes(tree, rows, which[begin:end], node[starts[a:a + step]], starts[a:a + step] - begin, g[begin:end], totals, cuts)


def _random_of_nodes(tree, rows, which, some, starts, g, totals, cuts) -> None:
    """Cuts of nodes ``some`` whose rows lie next to each other from ``starts`` on; features are taken a few at a time, those
    of a one-hot group from its sums."""
    lay, vary, m = tree.lay, tree.lay.vary, len(some)
    sizes = np.diff(np.append(starts, len(which)))
    place = np.repeat(np.arange(m), sizes)
    low, high = np.zeros((len(vary), m), np.float32), np.zeros((len(vary), m), np.float32)
    gl, nl = np.zeros((len(vary), m)), np.zeros((len(vary), m))
    plain = np.flatnonzero(~lay.grouped[lay.column_of[vary]])
    width = max(1, FLAT_ENTRIES // len(which))
    parts = [plain[a:a + width] for a in range(0, len(plain), width)]
    for part in parts:
        x = rows.values(lay, vary[part], which)
        low[part], high[part] = np.minimum.reduceat(x, starts, 1), np.maximum.reduceat(x, starts, 1)
    for c in np.unique(lay.column_of[vary][lay.grouped[lay.column_of[vary]]]):
        part = np.flatnonzero(lay.column_of[vary] == c)
        sums = histogram(rows.codes[c][which], place, m, lay.sizes[c], g, None)[:, :, lay.code_of[vary[part]]]
        ones = sums[2].T
        low[part], high[part] = ones == sizes, ones > 0
        gl[part], nl[part] = totals[0, some] - sums[0].T, sizes - ones  # zeros go left of every cut
    at = random_cuts(tree.spec, tree.number, np.array(tree.open)[some], low, high, vary)
    for part in parts:
        goes = rows.values(lay, vary[part], which) <= np.repeat(at[part], sizes, 1)
        gl[part] = np.add.reduceat(np.where(goes, g, 0.0), starts, 1)
        nl[part] = np.add.reduceat(goes.astype(np.float64), starts, 1)
    found = Cuts.none(m)
    best_random(at, gl, nl, totals[:, some], tree.gain, found, vary)
    cuts.gain[some], cuts.feature[some], cuts.cut[some] = found.gain, found.feature, found.cut


def _tree_row(model: int, number: int, arrays: dict[str, np.ndarray]) -> list:
    kinds = {"feature": "<i4", "cut": "<f4", "left": "<i4", "right": "<i4", "value": "<f8", "gain": "<f4"}
    return [model, number, *(arrays[c].astype(t).tobytes() for c, t in kinds.items())]


_BLOCK = ["n", "codes", "x", "y", "ids", "folds"]


def _rows_of(lay: Layout, batches: list[pa.RecordBatch], skip_fold: int | None) -> Rows:
    """Rows of blocks, in an order that does not depend on how they came."""
    parts = [dict(zip(b.schema.names, (v.as_py() if k == 0 else v.as_buffer() for k, v in enumerate(r)))) for b in batches for r in zip(*b.columns)]
    parts.sort(key=lambda p: hashlib.md5(p["ids"]).digest())
    rows = Rows(lay, parts)
    return rows if skip_fold is None else rows.pick(np.flatnonzero(rows.folds != skip_fold))


def _tree_rows(out: list[list]) -> pa.RecordBatch:
    columns = list(zip(*out))
    return pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[2:])], names=[f.split()[0] for f in _TREE.split(", ")])


def _fit_local(specs: Sequence[Trees], lay: Layout, table: DataFrame) -> DataFrame:
    """Every group (a boosted model, or a batch of a forest's trees) in a task of its own, in one job; few boosted models of
    many rows by all tasks together."""
    boosts = [k for k, s in enumerate(specs) if s.kind == "boost"]
    ranks = _shared_by(table.sparkSession, [specs[k] for k in boosts], lay)
    if ranks < 2:
        return _fit_groups(dict(enumerate(specs)), lay, table)
    made = materialize(_fit_shared({k: specs[k] for k in boosts}, lay, table, ranks))
    rest = {k: s for k, s in enumerate(specs) if k not in boosts}
    return made.unionByName(_fit_groups(rest, lay, table)) if rest else made


def _fit_many_rows(specs: Sequence[Trees], lay: Layout, table: DataFrame, most: int) -> DataFrame:
    """No task holds all rows: boosted models by all tasks together if their shares of the rows are no more than ``most``
    bytes, the others by distributed levels."""
    boosts = [k for k, s in enumerate(specs) if s.kind == "boost"]
    ranks = _shared_by(table.sparkSession, [specs[k] for k in boosts], lay, alone=False)
    if ranks < 2 or lay.rows * (len(lay.members) + 20) > most * ranks:
        return _fit_distributed(specs, lay, table)
    made = materialize(_fit_shared({k: specs[k] for k in boosts}, lay, table, ranks, by_rows=True))
    rest = [k for k in range(len(specs)) if k not in boosts]
    if not rest:
        return made
    others = _fit_distributed([specs[k] for k in rest], lay, table)
    return made.unionByName(others.withColumn("model", F.element_at(F.array(*[F.lit(k) for k in rest]), F.col("model") + 1)))


def _fit_groups(chains: dict[int, Trees], lay: Layout, table: DataFrame) -> DataFrame:
    tasks = []
    for k, spec in chains.items():
        step = spec.trees if spec.kind == "boost" else FOREST_BATCH
        tasks += [(k, a, min(a + step, spec.trees)) for a in range(0, spec.trees, step)]
    files, spark = _files(table), table.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                model, begin, end = task["model"], task["begin"], task["end"]
                spec = chains[model]
                rows = _rows_of(lay, _blocks_of(files, spec.kind == "extra"), spec.skip_fold)
                margin = np.full(len(rows.y), lay.mean)
                for number in range(begin, end):
                    tree, arrays, at = local_tree(spec, number, lay, rows, margin)
                    if spec.kind == "boost":
                        margin += tree.leaf_values(arrays)[at]
                    yield _tree_rows([_tree_row(model, number, arrays)])

    # Longest chains first; a partition of its own for each.
    tasks.sort(key=lambda t: (-(t[2] - t[1]) if chains[t[0]].kind == "boost" else 0, t))
    dealt = spark.createDataFrame([(place, *t) for place, t in enumerate(tasks)], "place int, model int, begin int, end int")
    return dealt.repartitionById(max(len(tasks), 1), F.col("place")).mapInArrow(run, _TREE)


def _files(table: DataFrame) -> list[str]:
    """The files that hold a written table."""
    names = sorted(r.name for r in table.select(F.input_file_name().alias("name")).distinct().collect())
    return names if names and names[0] else sorted(materialize(table, "table").inputFiles())


def _blocks_of(files: list[str], raw: bool) -> list[pa.RecordBatch]:
    out = []
    for name in files:
        for batch in _read(name, [c for c in _BLOCK if raw or c != "x"]):
            x = batch.column("x") if raw else pa.array([b""] * batch.num_rows, pa.binary())
            out.append(pa.RecordBatch.from_arrays([x if c == "x" else batch.column(c) for c in _BLOCK], names=_BLOCK))
    return out


def _read(name: str, columns: list[str], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """A file of a written table, ``rows`` at a time."""
    import pyarrow.parquet as pq

    store, path = _store(name)
    with store.open_input_file(path) as f:
        yield from pq.ParquetFile(f).iter_batches(rows, columns=columns, use_threads=False)


# ------------------------------------------------------------------ boosted trees grown by several tasks
def _shared_by(spark, boosts: Sequence[Trees], lay: Layout, alone: bool = True) -> int:
    """How many tasks grow the boosted models together, one model after the other; 0 or 1: each model has a task of its own
    (if the rows are few enough for that: ``alone``).
    A barrier stage needs all its tasks at once, so there are no more of them than cores."""
    conf = spark.sparkContext.getConf()
    if not boosts or conf.get("spark.dynamicAllocation.enabled", "false") == "true" or lay.rows * len(lay.members) <= SHARED_ENTRIES:
        return 0
    if any(not s.leaves and (s.depth is None or 2 ** s.depth > SHARED_NODES) for s in boosts):
        return 0
    slots = spark.sparkContext.defaultParallelism // int(conf.get("spark.task.cpus", "1"))
    if conf.contains("spark.default.parallelism"):  # may be more than there are cores
        slots = min(slots, int(conf.get("spark.executor.instances", "1")) * int(conf.get("spark.executor.cores", "1")) // int(conf.get("spark.task.cpus", "1")))
    return min(slots, SHARED_TASKS) if 2 * len(boosts) <= slots or not alone else 0


def _by_rows(chains: dict[int, Trees], lay: Layout) -> bool:
    """Whether tasks that grow boosted models together share the rows, not the columns."""
    cells = 16 * sum(size for size in lay.sizes if size > 1)
    sums = sum(s.trees * cells * (s.leaves or 2 ** s.depth) for s in chains.values())
    return sums <= lay.rows * ROW_COSTS * sum(s.trees for s in chains.values())


def _fit_shared(chains: dict[int, Trees], lay: Layout, table: DataFrame, ranks: int, by_rows: bool | None = None) -> DataFrame:
    """All models in one barrier stage: its tasks hold the same rows, or a share of them, and the first gives out the trees."""
    by_rows = _by_rows(chains, lay) if by_rows is None else by_rows
    needs = {"ids": True, "folds": any(s.skip_fold is not None for s in chains.values()), "x": False}
    dealt = table.select("n", "codes", *[F.col(c) if needs.get(c, True) else F.lit(b"").alias(c) for c in _BLOCK[2:]])
    if by_rows:  # the blocks of each part of the table in turn, begun at different tasks
        turn = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.xxhash64(F.spark_partition_id())
        dealt = dealt.withColumn("task", F.pmod(turn, F.lit(ranks)).cast("int")).repartitionById(ranks, F.col("task"))
    else:
        dealt = dealt.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(ranks - 1)))).repartitionById(ranks, F.col("task"))

    folder = f"{_tables(table.sparkSession)}/meet"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        rank = context.partitionId()
        told = Told(f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}", rank, ranks)  # a stage that runs again meets elsewhere
        if by_rows:
            packs = Packs(lay)
            every = packs.rows(batches)
        else:
            held = [b.select(_BLOCK) for b in batches if b.num_rows]
            every = _rows_of(lay, held, None)
            held.clear()
        for model, spec in chains.items():
            rows = every if spec.skip_fold is None else every.pick(np.flatnonzero(every.folds != spec.skip_fold))
            margin = np.full(len(rows.y), lay.mean)
            for number in range(spec.trees):
                if by_rows:
                    arrays = tree_of_shares(spec, number, lay, packs, rows, margin, rank, ranks, told)
                else:
                    arrays = shared_tree(spec, number, lay, rows, margin, rank, ranks, lambda found: _meet(found, told))  # noqa: B023
                if rank == 0:
                    yield _tree_rows([_tree_row(model, number, arrays)])

    return dealt.mapInArrow(run, _TREE, barrier=True)


class Told:
    """What every task of a barrier stage tells the others, round by round, in small files (a barrier's own messages take a
    second each). Who has read all files of a round knows that all have read those of the round before."""

    def __init__(self, folder: str, rank: int, ranks: int, patience: float = 900.0) -> None:
        self.store, self.top = _store(folder)
        self.store.create_dir(self.top, recursive=True)
        self.rank, self.ranks, self.patience, self.round = rank, ranks, patience, 0

    def name(self, rank: int, back: int = 0) -> str:
        return f"{self.top}/{self.round - back}-{rank}"

    def __call__(self, mine: bytes) -> list[bytes]:
        with self.store.open_output_stream(f"{self.name(self.rank)}.part") as out:
            out.write(mine)
        self.store.move(f"{self.name(self.rank)}.part", self.name(self.rank))  # seen whole or not at all
        got = [mine if r == self.rank else self.read(self.name(r)) for r in range(self.ranks)]
        if self.round:
            self.store.delete_file(self.name(self.rank, 1))
        self.round += 1
        return got

    def deal(self, parts: list[np.ndarray]) -> list[np.ndarray]:
        """Gives each task its part (parts have the same sizes in all tasks); returns this task's parts from all."""
        with self.store.open_output_stream(f"{self.name(self.rank)}.part") as out:
            for part in parts:
                if part.nbytes:
                    out.write(memoryview(part).cast("B"))
        self.store.move(f"{self.name(self.rank)}.part", self.name(self.rank))
        begin, size = sum(p.nbytes for p in parts[:self.rank]), parts[self.rank].nbytes
        got = []
        for turn in range(self.ranks):  # each begins elsewhere
            r = (self.rank + turn) % self.ranks
            got.append(parts[r].ravel() if turn == 0 else np.array(memoryview(self.read(self.name(r), begin, size)).cast("d")))
        if self.round:
            self.store.delete_file(self.name(self.rank, 1))
        self.round += 1
        return got

    def read(self, name: str, begin: int = 0, size: int | None = None) -> bytes:
        end, pause = time.monotonic() + self.patience, 0.0005
        while self.store.get_file_info(name).type != fs.FileType.File:
            if time.monotonic() > end:
                raise TimeoutError(f"nothing told in {name}")
            time.sleep(pause)
            pause = min(2 * pause, 0.005)
        if size is None:
            with self.store.open_input_stream(name) as held:
                return held.read()
        with self.store.open_input_file(name) as held:
            return held.read_at(size, begin)


def _meet(cuts: Cuts, tell: Callable[[bytes], list[bytes]]) -> Cuts:
    """The best cuts of all tasks; of equal ones that of the first columns, as in one task."""
    m = len(cuts.gain)
    told = tell(np.stack([cuts.gain, cuts.feature.astype(np.float64), cuts.cut, *([] if cuts.left is None else cuts.left)]).astype("<f8").tobytes())
    best = Cuts.none(m)
    for t in told:
        gain, feature, cut, *left = np.frombuffer(t, "<f8").reshape(-1, m)
        best.offer(gain, feature.astype(np.int64), cut, np.stack(left) if left else None)
    return best


def shared_tree(spec: Trees, number: int, lay: Layout, rows: Rows, margin: np.ndarray, rank: int, ranks: int, meet: Callable[[Cuts], Cuts]) -> dict[str, np.ndarray]:
    """One boosted tree, as ``local_tree`` makes it, from a share of its columns; adds its values to ``margin``. A node's rows
    lie in a list of their own, so that a level costs what its rows cost."""
    tree = Growing(spec, number, lay)
    cells = Cells(lay, tree.columns)
    mine = [int(c) for c in np.array_split(np.array(cells.columns, np.int64), ranks)[rank]]
    at = np.cumsum([0] + [lay.sizes[c] for c in mine])
    weight = row_weights(spec, number, rows.ids)
    grad = gradients(spec, lay, rows.y, margin)
    # Rows of each open node or leaf: those that count, and the others.
    held = {0: (np.arange(len(rows.y)), np.zeros(0, np.int64)) if weight is None else (np.flatnonzero(weight > 0), np.flatnonzero(weight == 0))}
    total = {0: (float(grad[held[0][0]].sum()), float(len(held[0][0])))}
    sums: dict[int, np.ndarray] = {}  # (gradients, rows) x cell of own columns
    while tree.open:
        g, n = np.array([total[node] for node in tree.open]).T
        totals, cuts = np.stack([g, n, n]), Cuts.none(len(tree.open))
        if spec.leaves is not None or tree.level[tree.open[0]] < spec.depth:
            able = n >= max(2 * spec.least_rows, spec.least_to_split, 2)
            grid = np.zeros((2, len(tree.open), at[-1]))
            for k, other in _added_up(tree, able, n):
                which = held[tree.open[k]][0]
                own = grid[:, k]
                value = grad.take(which)
                for c, a, b in zip(mine, at[:-1], at[1:]):
                    code = rows.codes[c].take(which).astype(np.intp)
                    own[0, a:b], own[1, a:b] = np.bincount(code, value, b - a), np.bincount(code, minlength=b - a)
                if other is not None:
                    grid[:, other] = sums[tree.parent[tree.open[k]]] - own
            for c, a, b in zip(mine, at[:-1], at[1:]):
                _offer_column(tree, c, grid[[0, 1, 1], :, a:b], totals, cuts)
            cuts.gain[~able] = -np.inf
            for k, node in enumerate(tree.open):
                sums.pop(tree.parent[node], None)
                if able[k]:
                    sums[node] = grid[:, k].copy()
            if able.any():
                cuts = meet(cuts)
        tree.take(cuts, totals)
        for node in tree.widened:
            _part(tree, rows, node, held, total, grad)
    arrays = tree.arrays()
    values = tree.leaf_values(arrays)
    for node, lists in held.items():
        for which in lists:
            margin[which] += values[node]
    return arrays


def _added_up(tree: Growing, able: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int | None]]:
    """Places of open nodes whose rows are added up, with the parent's other child, whose sums follow; none where neither may
    be cut."""
    if tree.open[0] == 0:
        pairs = [(0, None)] if able[0] else []
    else:  # children are opened in pairs
        pairs = [(a, a + 1) if n[a] <= n[a + 1] else (a + 1, a) for a in range(0, len(tree.open), 2) if able[a:a + 2].any()]
    yield from pairs


def _dealt(tree: Growing, codes: Callable[[int, np.ndarray], np.ndarray], node: int, held: dict) -> list[list[np.ndarray]]:
    """A widened node's lists of rows, divided into its children's."""
    c = tree.column_of[tree.feature[node]]
    lists: list[list[np.ndarray]] = [[], []]
    for which in held.pop(node):
        code, cut = codes(c, which), np.uint8(tree.cut[node])
        goes = code != cut if tree.grouped[c] else code <= cut
        lists[0].append(which.take(np.flatnonzero(goes)))
        lists[1].append(which.take(np.flatnonzero(~goes)))
    return lists


def _part(tree: Growing, rows: Rows, node: int, held: dict, total: dict, grad: np.ndarray) -> None:
    """Deals a widened node's rows to its children; the sums of the one with more rows are the rest."""
    two = tree.left[node], tree.right[node]
    lists = _dealt(tree, lambda c, which: rows.codes[c].take(which), node, held)
    few = 0 if len(lists[0][0]) <= len(lists[1][0]) else 1
    g = float(grad.take(lists[few][0]).sum())
    whole = total.pop(node)
    for side, child in enumerate(two):
        held[child] = lists[side][0], lists[side][1]
        total[child] = g if side == few else whole[0] - g, float(len(lists[side][0]))


class Packs:
    """Columns of few bins together in a byte: the sums of a pack's codes hold those of each of its columns."""

    def __init__(self, lay: Layout) -> None:
        self.lay, self.columns, self.sizes = lay, [], []
        for c in sorted((c for c, size in enumerate(lay.sizes) if size > 1), key=lambda c: -lay.sizes[c]):
            place = next((k for k, size in enumerate(self.sizes) if size * lay.sizes[c] <= BINS), None)
            if place is None:
                place = len(self.sizes)
                self.columns.append([])
                self.sizes.append(1)
            self.columns[place].append((c, self.sizes[place]))
            self.sizes[place] *= lay.sizes[c]
        self.of = {c: (k, step) for k, some in enumerate(self.columns) for c, step in some}
        self.read = {c: (np.arange(BINS) // step % lay.sizes[c]).astype(np.uint8) for c, (_, step) in self.of.items()}

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Rows:
        """Rows of blocks, with packs in place of columns."""
        parts = []
        for batch in batches:
            for r in zip(*batch.select(_BLOCK).columns):
                p = dict(zip(_BLOCK, (v.as_py() if k == 0 else v.as_buffer() for k, v in enumerate(r))))
                codes = np.frombuffer(p["codes"], np.uint8).reshape(-1, p["n"])
                packed = np.zeros((len(self.sizes), p["n"]), np.uint8)
                for k, some in enumerate(self.columns):
                    for c, step in some:
                        packed[k] += codes[c] * np.uint8(step)
                parts.append({"codes": packed, **{c: bytes(p[c]) for c in ("y", "ids", "folds")}})
        out = object.__new__(Rows)
        out.codes = np.concatenate([np.zeros((len(self.sizes), 0), np.uint8), *(p["codes"] for p in parts)], 1)
        out.x = None
        out.y, out.ids, out.folds = (np.frombuffer(b"".join(p[c] for p in parts), t) for c, t in (("y", "<f8"), ("ids", "<i8"), ("folds", "<i4")))
        return out

    def codes(self, rows: Rows, c: int, which: np.ndarray) -> np.ndarray:
        return self.read[c].take(rows.codes[self.of[c][0]].take(which))

    def sums(self, rows: Rows, columns: list[int], which: np.ndarray, node: np.ndarray, m: int, g: np.ndarray) -> dict[int, np.ndarray]:
        """Sums (gradients, rows) x node x bin of each of ``columns``."""
        out, wanted = {}, set(columns)
        for k, (some, size) in enumerate(zip(self.columns, self.sizes)):
            if not any(c in wanted for c, _ in some):
                continue
            cell = node * size
            cell += rows.codes[k].take(which)
            both = np.stack([np.bincount(cell, g, m * size), np.bincount(cell, minlength=m * size)])
            for c, step in some:
                if c in wanted:
                    each = self.lay.sizes[c]
                    out[c] = both.reshape(2, m, each) if each == size else both.reshape(2, m, size // (step * each), each, step).sum((2, 4))
        return out


def tree_of_shares(spec: Trees, number: int, lay: Layout, packs: Packs, rows: Rows, margin: np.ndarray, rank: int, ranks: int, told: Told) -> dict[str, np.ndarray]:
    """One boosted tree, as ``local_tree`` makes it, from a share of the rows; adds its values to ``margin``. Sums are whole
    numbers, so that those of all shares are exact in whatever order they are added."""
    tree = Growing(spec, number, lay)
    cells = Cells(lay, tree.columns)
    # Columns of each task: about as many cells each, in order.
    first = np.searchsorted(cells.offsets[:-1], np.arange(ranks + 1) * cells.width / ranks)
    shares = [cells.columns[a:b] for a, b in zip(first[:-1], first[1:])]
    mine = shares[rank]
    at = np.cumsum([0] + [lay.sizes[c] for c in mine])
    weight = row_weights(spec, number, rows.ids)
    grad = gradients(spec, lay, rows.y, margin)
    held = {0: (np.arange(len(rows.y)), np.zeros(0, np.int64)) if weight is None else (np.flatnonzero(weight > 0), np.flatnonzero(weight == 0))}
    own = np.array([grad[held[0][0]].sum(), len(held[0][0])])
    total = {0: np.sum([np.frombuffer(t, "<f8") for t in told(own.astype("<f8").tobytes())], 0)}
    sums: dict[int, np.ndarray] = {}  # (gradients, rows) x cell of own columns
    left_of: dict[int, np.ndarray] = {}  # sums of what goes left at a node's best cut
    step = max(1, MEET_BYTES // (16 * max(cells.width, 1)))
    while tree.open:
        g, n = np.array([total[node] for node in tree.open]).T
        totals, cuts = np.stack([g, n, n]), Cuts.none(len(tree.open))
        if spec.leaves is not None or tree.level[tree.open[0]] < spec.depth:
            able = n >= max(2 * spec.least_rows, spec.least_to_split, 2)
            grid = np.zeros((2, len(tree.open), at[-1]))
            added = list(_added_up(tree, able, n)) if cells.width else []
            for a in range(0, len(added), step):
                some = added[a:a + step]
                lists = [held[tree.open[k]][0] for k, _ in some]
                which, node = np.concatenate(lists), np.repeat(np.arange(len(some)), [len(x) for x in lists])
                found = packs.sums(rows, cells.columns, which, node, len(some), grad.take(which))
                parts = [np.concatenate([np.zeros((2, len(some), 0)), *(found[c] for c in share)], 2).astype("<f8") for share in shares]
                whole = np.sum(told.deal(parts), 0).reshape(2, len(some), -1)
                for i, (k, other) in enumerate(some):
                    grid[:, k] = whole[:, i]
                    if other is not None:
                        grid[:, other] = sums[tree.parent[tree.open[k]]] - whole[:, i]
            left = np.zeros((3, len(tree.open)))
            for c, a, b in zip(mine, at[:-1], at[1:]):
                before = cuts.gain.copy()
                _offer_column(tree, c, grid[[0, 1, 1], :, a:b], totals, cuts)
                new = np.flatnonzero(cuts.gain > before)
                if len(new):
                    code = cuts.cut[new].astype(np.int64)
                    if tree.grouped[c]:
                        side = totals[:2, new] - grid[:, new, a + code]
                    else:
                        side = np.cumsum(grid[:, new, a:b], 2)[:, np.arange(len(new)), code]
                    left[:, new] = side[[0, 1, 1]]
            cuts.gain[~able], cuts.left = -np.inf, left
            for k, node in enumerate(tree.open):
                sums.pop(tree.parent[node], None)
                if able[k]:
                    sums[node] = grid[:, k].copy()
            if able.any():
                cuts = _meet(cuts, told)
                left_of.update(zip(tree.open, cuts.left[:2].T))
        tree.take(cuts, totals)
        for node in tree.widened:
            lists = _dealt(tree, lambda c, which: packs.codes(rows, c, which), node, held)
            side, whole = left_of.pop(node), total.pop(node)
            for child, which, value in zip((tree.left[node], tree.right[node]), lists, (side, whole - side)):
                held[child], total[child] = tuple(which), value
    arrays = tree.arrays()
    values = tree.leaf_values(arrays)
    for node, lists in held.items():
        for which in lists:
            margin[which] += values[node]
    return arrays


# ------------------------------------------------------------------ distributed levels
def _fit_distributed(specs: Sequence[Trees], lay: Layout, table: DataFrame) -> DataFrame:
    """The next tree of every boosted model and all trees of all forests grow side by side, a level in one pass (two for
    extra-trees: least and greatest values first). A pass takes as many trees and open nodes as PASS_BYTES hold the sums of."""
    spark = table.sparkSession
    state = table.withColumn("margins", F.lit(None).cast("binary"))
    rows_out: list[DataFrame] = []
    pending: list[list] = []
    since: list[list[tuple[Growing, dict]]] = [[] for _ in specs]
    growing = {(k, t): Growing(s, t, lay) for k, s in enumerate(specs) for t in range(min(s.trees, 1) if s.kind == "boost" else s.trees)}
    while growing:
        for item, (cuts, totals) in _pass(state, lay, specs, _items(growing, lay), since).items():
            tree = growing[item.key]
            tree.parts.append((cuts, totals))
            if item.end < len(tree.open):
                continue
            parts, tree.parts = tree.parts, []
            tree.take(Cuts.together([c for c, _ in parts]), np.concatenate([t for _, t in parts], 1))
            if not tree.open:
                k, number = item.key
                del growing[item.key]
                arrays = tree.arrays()
                pending.append(_tree_row(k, number, arrays))
                if specs[k].kind == "boost":
                    since[k].append((tree, arrays))
                    if number + 1 < specs[k].trees:
                        growing[k, number + 1] = Growing(specs[k], number + 1, lay)
        if max(map(len, since)) >= WRITE_EVERY:
            state, since = materialize(_with_margins(state, lay, specs, since)), [[] for _ in specs]
        if pending and (not growing or sum(len(v) for r in pending for v in r[2:]) > PENDING_BYTES):
            rows_out.append(materialize(spark.createDataFrame(pending, _TREE)))
            pending = []
    out = rows_out[0]
    for r in rows_out[1:]:
        out = out.unionByName(r)
    return out


@dataclass(frozen=True)
class Item:
    """Open nodes ``begin`` to ``end`` of a tree."""

    key: tuple[int, int]
    begin: int
    end: int


def _items(growing: dict[tuple[int, int], Growing], lay: Layout) -> dict[Item, Growing]:
    """What the next pass works on: boosted trees first, then the lowest numbers, so that few trees are half grown."""
    room, out = PASS_BYTES, {}
    for key, tree in sorted(growing.items(), key=lambda g: (g[1].spec.kind != "boost", g[0][1], g[0][0])):
        node = 40 * len(lay.vary) + 24 if tree.spec.kind == "extra" else 24 * (sum(lay.sizes) + 1)
        begin = sum(len(c.gain) for c, _ in tree.parts)
        end = min(len(tree.open), begin + (max(room // node, 0) if out else max(room // node, 1)))
        if end > begin:
            out[Item(key, begin, end)] = tree
            room -= node * (end - begin)
        if room <= 0:
            break
    return out


def _margins(parts: list[dict], rows: Rows, lay: Layout, models: int, since, first: np.ndarray | None = None) -> np.ndarray:
    """Predictions so far (model x row): what is written, and the trees since; ``rows`` may be the rows ``first`` of the parts."""
    held = np.concatenate([np.frombuffer(p["margins"], "<f8").reshape(models, -1) if p["margins"] else np.full((models, p["n"]), lay.mean) for p in parts], 1)
    held = held if first is None else held[:, first]
    for k, made in enumerate(since):
        for tree, arrays in made:
            held[k] += tree.leaf_values(arrays)[tree.place(rows)]
    return held


def _with_margins(state: DataFrame, lay: Layout, specs, since) -> DataFrame:
    models = len(specs)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, part in enumerate(batch.to_pylist()):
                rows = Rows(lay, [part])
                first, which = rows.alike() or (None, slice(None))  # rows alike have one prediction
                held = _margins([part], rows if first is None else rows.pick(first), lay, models, since, first)
                data = held[:, which].astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns[:-1], pa.array([data], pa.binary())], names=batch.schema.names)

    return state.mapInArrow(add, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema))


def _pass(state: DataFrame, lay: Layout, specs, items: dict[Item, Growing], since) -> dict[Item, tuple[Cuts, np.ndarray]]:
    """Best cuts and sums of the open nodes of every item."""
    models, vary = len(specs), lay.vary
    of = list(items)
    live = dict(enumerate(items.values()))
    span = {k: (i.begin, i.end) for k, i in enumerate(of)}
    count = {k: i.end - i.begin for k, i in enumerate(of)}
    boosts = any(s.kind == "boost" for s in specs)
    # Columns that no tree of the pass needs are not read.
    needs = {"ids": any(t.spec.kind == "forest" or t.spec.rows_share < 1 for t in items.values()), "folds": any(s.skip_fold is not None for s in specs)}
    state = state.withColumns({c: F.lit(b"") for c, needed in needs.items() if not needed})

    def level(k: int, rows: Rows, margins: np.ndarray | None, one: Rows, which: np.ndarray | None, held: dict):
        """Rows of ``one`` in the item's nodes, their nodes there, and what they stand for: gradients, weights, numbers of
        rows. ``one`` is ``rows``, or their different rows (then ``which`` tells the one of each row)."""
        tree, spec = live[k], live[k].spec
        if held.get("tree") != of[k].key:
            weight = row_weights(spec, tree.number, rows.ids)
            same = ("every row", spec.skip_fold) if weight is None and not boosts else None  # the same in all such trees
            if same not in held or same is None:
                used = np.ones(len(rows.y), bool) if weight is None else weight > 0
                if spec.skip_fold is not None:
                    used &= rows.folds != spec.skip_fold
                margin = margins[of[k].key[0]] if boosts else None
                g = gradients(spec, lay, rows.y, margin[which] if boosts and which is not None else margin)
                g, n = g if weight is None else g * weight, used.astype(np.float64)
                h = weight if spec.kind == "forest" else n
                if which is not None:
                    one_n = np.bincount(which, n, len(one.y))
                    g, h, n = np.bincount(which, g * used, len(one.y)), one_n if h is n else np.bincount(which, h * used, len(one.y)), one_n
                held[same] = g, h, n
            held["tree"], held["sums"] = of[k].key, held[same]
        place = np.full(len(tree.feature), -1)
        place[tree.open[span[k][0]:span[k][1]]] = np.arange(count[k])
        node = place[tree.place(one)]
        some = np.flatnonzero((node >= 0) & (held["sums"][2] > 0))
        return some, node[some], *(v[some] for v in held["sums"])

    def partial(batches: Iterator[pa.RecordBatch], cuts_of: dict | None) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, TOGETHER):
                parts = batch.slice(a, TOGETHER).to_pylist()
                rows = Rows(lay, parts)
                alike = None if not boosts and len(live) < 2 else rows.alike()
                one, row_of = (rows, None) if alike is None else (rows.pick(alike[0]), alike[1])
                # Rows alike fall into the same leaves: one prediction for all.
                margins = _margins(parts, one, lay, models, since, None if alike is None else alike[0]) if boosts else None
                held: dict = {}
                for k, tree in live.items():
                    which, node, g, h, n = level(k, rows, margins, one, row_of, held)
                    m = count[k]
                    keep = lambda c, new, how=np.add: sums.__setitem__((k, c), how(sums[k, c], new) if (k, c) in sums else new)  # noqa: E731,B023
                    cells = lambda codes, size: np.stack([np.bincount(node * size + codes, v, m * size) for v in (g, h, n)]).reshape(3, m, size)  # noqa: E731,B023
                    if cuts_of is None:
                        keep(-1, cells(0, 1))
                    if tree.spec.kind == "extra":
                        x = one.values(lay, vary, which)
                        if cuts_of is None:
                            order = np.argsort(node, kind="stable")
                            starts = np.searchsorted(node[order], np.arange(m))
                            full = np.diff(np.append(starts, len(node))) > 0
                            low, high = np.full((len(vary), m), np.inf, np.float32), np.full((len(vary), m), -np.inf, np.float32)
                            if full.any():
                                low[:, full] = np.minimum.reduceat(x[:, order], starts[full], 1)
                                high[:, full] = np.maximum.reduceat(x[:, order], starts[full], 1)
                            keep(-2, low.astype(np.float64)[None], np.minimum)
                            keep(-3, high.astype(np.float64)[None], np.maximum)
                        elif k in cuts_of:
                            at = cuts_of[k]
                            goes = x <= at[:, node]
                            two = np.stack([np.stack([np.bincount(node, np.where(r, v, 0.0), m) for v in (g, n)]) for r in goes]) if len(goes) else np.zeros((0, 2, m))
                            keep(-4, two.transpose(1, 0, 2))
                    elif cuts_of is None:
                        for c, size in enumerate(lay.sizes):
                            if size >= 2 and tree.allowed(c):
                                keep(c, cells(one.codes[c][which], size))
        if sums:
            keys = list(sums)
            yield pa.record_batch([pa.array([k for k, _ in keys], pa.int32()), pa.array([c for _, c in keys], pa.int32()), pa.array([sums[q].astype("<f8").tobytes() for q in keys], pa.binary())], names=["model", "col", "sums"])

    shapes = lambda k, c: {-1: (3, count[k], 1), **dict.fromkeys((-2, -3), (1, len(vary), count[k])), -4: (2, len(vary), count[k])}.get(c) or (3, count[k], lay.sizes[c])

    def whole(key, group):
        """Adds up one (model, column); of a binned column only each node's best cut goes on."""
        k, c = (int(v.as_py()) for v in key)
        how = {-2: np.minimum, -3: np.maximum}.get(c, np.add)
        total = None
        for s in group.column("sums"):
            new = np.frombuffer(s.as_buffer(), "<f8").reshape(shapes(k, c))
            total = new if total is None else how(total, new)
        if c >= 0:
            tree, group = live[k], len(lay.members[c]) > 1
            node_sums = total.sum(2)
            if group and not tree.columns[lay.members[c]].all():
                total = total.copy()
                total[2, :, 1:][:, ~tree.columns[lay.members[c]]] = 0
            gain, at = best_of_bins(total, node_sums, tree.gain, group)
            place = np.arange(len(at)), at.astype(np.int64)
            left = node_sums - total[:, *place] if group else np.cumsum(total, 2)[:, *place]
            total = np.stack([gain, at, *left])
        return pa.table([pa.array([k], pa.int32()), pa.array([c], pa.int32()), pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["model", "col", "sums"])

    kind = "model int, col int, sums binary"

    def job(cuts_of: dict | None) -> dict[tuple[int, int], np.ndarray]:
        made = state.mapInArrow(lambda batches: partial(batches, cuts_of), kind).groupBy("model", "col").applyInArrow(whole, kind)
        return {(r.model, r.col): np.frombuffer(r.sums, "<f8") for r in made.collect()}

    first = job(None)
    out, cuts_of = {}, {}
    for k, tree in live.items():
        m = count[k]
        totals = first[k, -1].reshape(3, m) if (k, -1) in first else np.zeros((3, m))
        cuts = Cuts.none(m)
        for c in range(len(lay.members)):
            if (k, c) in first:
                gain, at, *left = first[k, c].reshape(5, m)
                group = len(lay.members[c]) > 1
                cuts.offer(gain, np.array(lay.members[c])[at.astype(np.int64) - 1] if group else lay.members[c][0], at, np.stack(left))
        if tree.spec.kind == "extra" and (k, -2) in first and (tree.spec.depth is None or tree.level[tree.open[0]] < tree.spec.depth):
            low, high = (first[k, c].reshape(len(vary), m).astype(np.float32) for c in (-2, -3))
            cuts_of[k] = random_cuts(tree.spec, tree.number, np.array(tree.open)[span[k][0]:span[k][1]], low, high, vary)
        out[k] = (cuts, totals)
    if cuts_of:
        second = job(cuts_of)
        for k, at in cuts_of.items():
            if (k, -4) in second:
                gl, nl = second[k, -4].reshape(2, len(vary), -1)
                best_random(at, gl, nl, out[k][1], live[k].gain, out[k][0], vary)
    return {of[k]: found for k, found in out.items()}


# ------------------------------------------------------------------ fitted
@dataclass
class Ensemble:
    """A fitted ensemble; ``trees`` is a table with a row for each tree."""

    spec: Trees
    trees: DataFrame
    base: float
    width: int
    names: list[str] | None = field(default=None)

    def save(self, path: str) -> None:
        """The trees as Parquet, parameters as JSON."""
        from leasekit.sources.artifacts import write_json

        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        write_json(self.trees.sparkSession, f"{path}/plain", {"spec": asdict(self.spec), "base": self.base, "width": self.width, "names": self.names})

    @classmethod
    def load(cls, spark, path: str) -> Ensemble:
        from leasekit.sources.artifacts import read_json

        plain = read_json(spark, f"{path}/plain")
        return cls(Trees(**plain["spec"]), spark.read.parquet(f"{path}/trees"), plain["base"], plain["width"], plain["names"])

    def batches(self) -> Iterator[list]:
        """Trees in order, in lists of bounded size."""
        sizes = self.trees.select("tree", (F.octet_length("feature") * 7).alias("size")).orderBy("tree").collect()
        begin, total = 0, 0
        for row in sizes:
            if total and total + row.size > SENT_BYTES:
                yield self._some(begin, row.tree)
                begin, total = row.tree, 0
            total += row.size
        if total:
            yield self._some(begin, sizes[-1].tree + 1)

    def _some(self, begin: int, end: int) -> list:
        held = self.trees.where(F.col("tree").between(begin, end - 1)).orderBy("tree").collect()
        kinds = {"feature": "<i4", "cut": "<f4", "left": "<i4", "right": "<i4", "value": "<f8"}
        return [{c: np.frombuffer(r[c], t) for c, t in kinds.items()} for r in held]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction (null features: null)."""
        import pandas as pd

        spec, spark = self.spec, df.sparkSession
        total = self.trees.agg(F.sum(F.octet_length("feature") * 7)).first()[0] or 0
        if total <= SENT_BYTES:
            sent = spark.sparkContext.broadcast([t for some in self.batches() for t in some] if total else [])
            trees = lambda: sent.value
        else:
            trees = self._from_files()

        def add(parts):
            held, size = [], 0

            def scored():
                rows = [r for _, r in held if len(r)]
                sums = np.zeros(0)
                if rows:
                    rows = np.concatenate(rows)
                    one, which = different_rows(rows)
                    sums = walk(trees(), rows[one])[which]
                begin = 0
                for there, r in held:
                    out = np.full(len(there), np.nan)
                    out[there] = sums[begin:begin + len(r)]
                    begin += len(r)
                    yield pd.Series(out)
                held.clear()

            for x in parts:
                there = x.notna().to_numpy()
                held.append((there, np.stack(x[there].to_numpy()).astype(np.float32) if there.any() else np.zeros((0, 0), np.float32)))
                size += held[-1][1].nbytes
                if size >= (HELD_BYTES if total > SENT_BYTES else 0):
                    yield from scored()
                    size = 0
            yield from scored()

        add.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        add = F.pandas_udf(add, "double")
        scale = 1.0 if spec.kind == "boost" else 1.0 / max(spec.trees, 1)
        sums = F.nullif(add(vector_to_array(spec.featuresCol, "float32")), F.lit(float("nan"))) if total else F.lit(0.0)
        return df.withColumn(spec.predictionCol, F.lit(self.base) + sums * scale)

    def _from_files(self) -> Callable[[], Iterator[dict]]:
        """Gives the trees in order, one after the other, from the files of the table."""
        trees = self.trees
        found = trees.select("model", "tree", F.input_file_name().alias("name")).collect()  # a row a tree
        if any(not r.name for r in found):
            trees = materialize(trees, "table")
            found = trees.select("model", "tree", F.input_file_name().alias("name")).collect()
        files = list(dict.fromkeys(r.name for r in sorted(found, key=lambda r: r.tree)))
        wanted = {(r.model, r.tree) for r in found}
        kinds = {"feature": "<i4", "cut": "<f4", "left": "<i4", "right": "<i4", "value": "<f8"}

        def read():
            for name in files:
                for batch in _read(name, ["model", "tree", *kinds], 1):
                    if (batch.column("model")[0].as_py(), batch.column("tree")[0].as_py()) in wanted:
                        yield {c: np.frombuffer(batch.column(c)[0].as_buffer(), t) for c, t in kinds.items()}
        return read

    @property
    def featureImportances(self) -> np.ndarray:
        """Gain of each feature's cuts, summing to 1; in forests every tree has the same weight."""
        each, width = self.spec.kind != "boost", self.width

        def per_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    gain = np.bincount(np.frombuffer(r["feature"], "<i4"), np.frombuffer(r["gain"], "<f4"), width)
                    if each and gain.sum() > 0:
                        gain = gain / gain.sum()
                    some = np.flatnonzero(gain)
                    yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(gain[some])], names=["feature", "gain"])

        sums = self.trees.select("feature", "gain").mapInArrow(per_tree, "feature int, gain double").groupBy("feature").agg(F.sum("gain").alias("gain")).collect()  # a row a feature
        out = np.zeros(self.width)
        for s in sums:
            out[s.feature] = s.gain
        return out / out.sum() if out.sum() > 0 else out


def same_bytes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Rows of byte columns (column x row) such that each row is one of them, and which; None if most differ. Columns are
    joined one after the other, without a sort as long as there are few different rows."""
    n = codes.shape[1]
    if isinstance(different_rows(codes[:, :256].T)[0], slice):
        return None
    which, m = np.zeros(n, np.int64), 1
    for c in codes:
        cell = which * BINS + c
        if m * BINS > max(4 * n, 1 << 16):
            some, which = np.unique(cell, return_inverse=True)
            m = len(some)
        else:
            some = np.flatnonzero(np.bincount(cell, minlength=m * BINS))
            number = np.zeros(m * BINS, np.int64)
            number[some] = np.arange(len(some))
            which, m = number[cell], len(some)
        if 2 * m > n:
            return None
    first = np.empty(m, np.int64)
    first[which] = np.arange(n)
    return first, which


def different_rows(x: np.ndarray) -> tuple[np.ndarray | slice, np.ndarray | slice]:
    """Rows of ``x`` such that each row is one of them, and which; all rows, if most of the first ones differ."""
    every = slice(None)
    if not x.shape[1]:
        return every, every
    whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()
    if 2 * len(np.unique(whole[:256])) > min(len(whole), 256):
        return every, every
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    return first, which


def walk(trees: Iterable[dict], x: np.ndarray) -> np.ndarray:
    """Sum of all trees' values for rows of 32-bit features."""
    total = np.zeros(len(x))
    for t in trees:
        at = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while len(live):
            node = at[live]
            goes = x[live, t["feature"][node]] <= t["cut"][node]
            step = np.where(goes, t["left"][node], t["right"][node])
            live = live[step != node]
            at[live] = step[step != node]
        total += t["value"][at]
    return total


def fit_all(specs: Sequence[Trees], df: DataFrame, names: Sequence[str] | None = None, id_column: str = "id", fold: Column | None = None,
            local_bytes: int | None = None) -> list[Ensemble]:
    """Fits all ensembles to ``df`` (id, label, features) together; rows without a label are left out.

    An ensemble with ``skip_fold`` leaves out the rows whose ``fold`` it is. Without rows every prediction is 0. Rows with one
    id draw alike. ``local_bytes``: see LOCAL_BYTES.
    """
    label, features = F.col(specs[0].labelCol), specs[0].featuresCol
    names = list(names) if names else feature_names(df, features)
    lay = layout(df, label, features, names)
    raw = any(s.kind == "extra" for s in specs)
    made = materialize(blocks(df, label, features, lay, id_column, fold, raw))
    size = lay.rows * (len(lay.members) + 20 + (4 * len(lay.single) if raw else 0))
    most = LOCAL_BYTES if local_bytes is None else local_bytes
    if not lay.rows:
        table = df.sparkSession.createDataFrame([], _TREE)
    else:
        table = materialize(_fit_local(specs, lay, made) if size <= most else _fit_many_rows(specs, lay, made, most), compression="zstd")
    return [Ensemble(s, table.where(F.col("model") == k), lay.mean, lay.width, names) for k, s in enumerate(specs)]
