"""Boosted regression trees for many fits that share their passes over the rows.

``GBTRegressor`` reads and bins all rows anew for every fit and runs some twenty small jobs before the first tree. Here the
vector of a problem is coded once, in blocks that stay with the executors: a value is its place among at most ``LEVELS``
values of its column. Fits that wait together grow their trees level by level in the same Spark jobs. A task adds up
the histograms of its blocks, a shuffle brings those of one fit together and gives back the best splits, and only these reach
the driver. The rules are those of ``GBTRegressor`` for squared loss: candidate splits, least rows, weights of trees and
stopping. Targets are added up as whole numbers, so trees do not depend on how rows are dealt out.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.storage import delete, shared_folder

#: Most different values of a column that are told apart; columns with more are cut at so many quantiles of all rows.
LEVELS = 2048
#: Rows of a block, and most fits that share a job; these have so many columns together at most.
BLOCK_ROWS, FITS_TOGETHER, COLUMNS_TOGETHER = 16_384, 160, 3_000
#: Fits with so many columns together count the smaller of two children only and subtract; for fewer, that costs more than it saves.
HALVED_COLUMNS = 300
#: Rounds after which the lineage of the forecasts so far is cut by a checkpoint.
CHECKPOINT_ROUNDS = 20
ROOT = str(Path(__file__).resolve().parents[2])


@dataclass(frozen=True)
class Periods:
    """Rows of a fit: those up to ``upto`` train, those after ``after`` and up to ``until`` are held out."""

    upto: int
    after: int | None = None
    until: int | None = None


@dataclass
class Tree:
    """One tree in heap order (root 1, children 2k and 2k + 1): place of the feature in the fit or -1, and the last code that goes left."""

    feature: np.ndarray
    code: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    #: Rows, sum and sum of squares of what the tree was fitted to.
    rows: np.ndarray
    total: np.ndarray
    squares: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        zeros = lambda: np.zeros(n)
        return cls(np.full(n, -1), np.zeros(n, np.int64), zeros(), zeros(), zeros(), zeros(), zeros())

    def values(self) -> np.ndarray:
        return self.total / np.maximum(self.rows, 1)


@dataclass
class Moments:
    """Number, means and summed squares around them of targets and errors (forecast less target)."""

    n: int = 0
    mean: float = 0.0
    spread: float = 0.0
    error_mean: float = 0.0
    error_spread: float = 0.0

    @classmethod
    def of(cls, y: np.ndarray, forecast: np.ndarray) -> Moments:
        if not len(y):
            return cls()
        e = forecast - y
        my, me = y.mean(), e.mean()
        return cls(len(y), float(my), float(((y - my) ** 2).sum()), float(me), float(((e - me) ** 2).sum()))

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n = self.n + other.n
        share, cross = other.n / n, self.n * other.n / n
        dy, de = other.mean - self.mean, other.error_mean - self.error_mean
        return Moments(n, self.mean + dy * share, self.spread + other.spread + dy * dy * cross,
                       self.error_mean + de * share, self.error_spread + other.error_spread + de * de * cross)

    @property
    def squared_error(self) -> float:
        return self.error_spread / self.n + self.error_mean**2 if self.n else math.nan

    @property
    def r2(self) -> float | None:
        """1 - mean squared error / variance of the target."""
        return 1 - self.squared_error * self.n / self.spread if self.spread else None

    @property
    def variance_score(self) -> float | None:
        return 1 - self.error_spread / self.spread if self.spread else None


@dataclass
class Fit:
    """One fit asked for, and what has been found of it so far."""

    columns: list[int]
    periods: Periods
    rounds: int
    learning_rate: float
    min_rows: int
    depth: int
    max_bins: int
    tolerance: float
    trees: list[Tree] = field(default_factory=list)
    #: After every tree: moments of the training and of the held-out rows.
    moments: list[tuple[Moments, Moments]] = field(default_factory=list)
    best: int = 1
    best_error: float = math.nan
    done: bool = False

    @property
    def train(self) -> Moments:
        return self.moments[self.best - 1][0]

    @property
    def held(self) -> Moments:
        return self.moments[self.best - 1][1]

    def weight(self, tree: int) -> float:
        return 1.0 if tree == 0 else self.learning_rate

    def judge(self) -> None:
        """Stop where the last tree gains too little on the held-out rows, or after the last round."""
        made = len(self.moments)
        if self.periods.until is None:
            self.best = made
        elif made == 1:
            self.best_error = self.held.squared_error
        else:
            error = self.moments[-1][1].squared_error
            if self.best_error - error < self.tolerance * max(error, 0.01):
                self.done = True
            elif error < self.best_error:
                self.best, self.best_error = made, error
        self.done = self.done or made >= self.rounds


def candidate_splits(values: np.ndarray, counts: np.ndarray, max_bins: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds between neighbouring values that cut the rows evenly, and the last code below each.

    The rule of Spark's trees on all rows: every gap where there are few values, else the gap nearest to each stride. Where
    ``values`` are not all values of the column, a threshold is one of them, since others may lie in the gap.
    """
    seen = np.flatnonzero(counts)
    gaps, total = len(seen) - 1, counts.sum()
    splits = min(max_bins, int(total)) - 1
    if gaps <= 0:
        return np.empty(0), np.empty(0, np.int64)
    below = np.arange(gaps)
    if gaps > splits:
        stride, running = total / (splits + 1), np.cumsum(counts[seen])
        target, chosen = stride, []
        for i in range(1, len(seen)):
            if abs(running[i - 1] - target) < abs(running[i] - target):
                chosen.append(i - 1)
                target += stride
        below = np.array(chosen, np.int64)
    thresholds = (values[seen[below]] + values[seen[below + 1]]) / 2
    codes = np.searchsorted(values, thresholds, "right") - 1
    return thresholds if whole else values[codes], codes


def importable(spark: SparkSession) -> None:
    """Let Python workers that share this checkout import the package when it is not installed."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{ROOT}".strip(":")


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, one row per row."""
    column = batch.column("v")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _thinned(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the sorted values, evenly by rank, that stand for the values from the one before them."""
    if len(values) <= most:
        return values, counts
    running = np.cumsum(counts)
    last = np.unique(np.append(np.searchsorted(running, running[-1] * np.arange(1, most) / most), len(values) - 1))
    return values[last], np.diff(running[last], prepend=0)


def _merged(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)


def _levels(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The values of every column and their counts, thinned to four times ``most``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            for c, column in enumerate(np.ascontiguousarray(_vectors(batch).T)):
                parts = kept.setdefault(c, [])
                parts.append(np.unique(column, return_counts=True))
                if sum(len(v) for v, _ in parts) > 16 * most:
                    kept[c] = [_thinned(*_merged(parts), 4 * most)]
        for c, parts in kept.items():
            values, counts = _thinned(*_merged(parts), 4 * most)
            yield pa.RecordBatch.from_pydict({"c": pa.array([c], pa.int32()), "v": pa.array([values.tobytes()], pa.binary()),
                                              "n": pa.array([counts.astype(np.int64).tobytes()], pa.binary())})

    return count


def _whole(most: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """The levels of one column from those of all parts of the rows."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(v), np.frombuffer(n, np.int64)) for v, n in zip(rows["v"].to_pylist(), rows["n"].to_pylist(), strict=True)]
        values, counts = _merged(parts)
        kept, _ = _thinned(values, counts, most)
        cells = {"c": pa.array([key[0].as_py()], pa.int32()), "v": pa.array([kept.tobytes()], pa.binary())}
        return pa.table(cells | {"whole": pa.array([len(kept) == len(values)], pa.bool_())})

    return merge


def _encoder(levels: Sequence[np.ndarray], block_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns rows into blocks, sorted by period, with one row of codes per column."""

    def block(t: np.ndarray, y: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(t, kind="stable")
        cells = {"t": t[order], "y": y[order], "codes": np.ascontiguousarray(codes[:, order])}
        return pa.RecordBatch.from_pydict({"rows": pa.array([len(t)], pa.int32())} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in cells.items()})

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.ascontiguousarray(_vectors(batch).T)
            # A value beyond the last level, which thinning never leaves out, cannot be.
            codes = np.array([np.searchsorted(v, c) for v, c in zip(levels, columns, strict=True)], np.uint16)
            held.append((batch.column("t").to_numpy(), batch.column("y").to_numpy(), codes.reshape(len(levels), -1)))
            if sum(len(h[0]) for h in held) >= block_rows:
                yield block(*(np.concatenate(x, axis=-1) for x in zip(*held, strict=True)))
                held = []
        if held:
            yield block(*(np.concatenate(x, axis=-1) for x in zip(*held, strict=True)))

    return encode


def _each(rdd: RDD) -> RDD:
    """One element at a time between the JVM and Python, so that ``zip`` need not deal them anew."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


class Blocks:
    """The coded rows of a problem, kept by the executors for many fits."""

    def __init__(self, rows: DataFrame, vector: str, time: str, target: str, count: int):
        spark = self.spark = rows.sparkSession
        self.time, self.target = time, target
        importable(spark)
        shared_folder(spark)
        context = spark.sparkContext
        slim = rows.where(F.col(target).isNotNull() & F.col(time).isNotNull()).select(
            F.col(time).cast("int").alias("t"), F.col(target).cast("double").alias("y"), vector_to_array(vector).alias("v")
        )
        found = slim.mapInArrow(_levels(LEVELS), "c int, v binary, n binary").groupBy("c").applyInArrow(_whole(LEVELS), "c int, v binary, whole boolean")
        columns = sorted(found.collect(), key=lambda r: r["c"])
        self.levels, self.whole = [np.frombuffer(r["v"]) for r in columns], [r["whole"] for r in columns]
        width = len(self.levels)
        coded = slim.mapInArrow(_encoder(self.levels, BLOCK_ROWS), "rows int, t binary, y binary, codes binary").rdd

        def blocks(part: int, found: Iterator) -> Iterator[tuple]:
            for i, r in enumerate(found):
                codes = np.frombuffer(r["codes"], np.uint16).reshape(width, r["rows"])
                yield part + i, (np.frombuffer(r["t"], np.int32), np.frombuffer(r["y"]), codes, (part, i))

        parts = max(1, min(context.defaultParallelism, math.ceil(count / BLOCK_ROWS)))
        dealt = coded.mapPartitionsWithIndex(blocks).partitionBy(parts, lambda k: k % parts).values()
        self.base = _each(dealt).persist(StorageLevel.MEMORY_AND_DISK)
        # A part that is lost must come back in the same order, since forecasts are matched to rows by their place.
        self.base.checkpoint()
        sizes = self.base.map(lambda b: (len(b[0]), float(np.abs(b[1]).max()) if len(b[1]) else 0.0)).collect()
        self.rows = sum(n for n, _ in sizes)
        # Targets as whole numbers, so fine that sums of all rows stay exact.
        largest = max((y for _, y in sizes), default=0.0) or 1.0
        self.scale = 2.0 ** (52 - math.ceil(math.log2(8 * largest)) - math.ceil(math.log2(max(2, self.rows))))
        self._splits: dict[tuple[int, int], tuple[list, np.ndarray]] = {}
        self._lock = threading.Lock()

    def close(self) -> None:
        path = self.base.getCheckpointFile()
        self.base.unpersist()
        if path:
            delete(self.spark, path)

    def count(self, upto: int) -> int:
        """Rows with a target up to a period."""
        return self.base.map(lambda b: int(np.searchsorted(b[0], upto, "right"))).sum()

    def splits(self, upto: int, max_bins: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Candidate splits of all columns on the rows up to a period, and the bin of every code."""
        with self._lock:
            if (upto, max_bins) not in self._splits:
                width, most = len(self.levels), LEVELS

                def count(found: Iterator) -> Iterator[np.ndarray]:
                    total = np.zeros((width, most), np.int64)
                    for t, _, codes, _ in found:
                        n = np.searchsorted(t, upto, "right")
                        for c in range(width):
                            total[c] += np.bincount(codes[c, :n], minlength=most)
                    yield total

                counts = self.base.mapPartitions(count).treeReduce(np.add)
                made = [candidate_splits(v, n[: len(v)], max_bins, w) for v, n, w in zip(self.levels, counts, self.whole, strict=True)]
                bins = np.array([np.searchsorted(below, np.arange(most)) for _, below in made], np.uint16).reshape(width, most)
                self._splits[upto, max_bins] = made, bins.astype(np.uint8) if max_bins <= 256 else bins
            return self._splits[upto, max_bins]

    def fit(self, fits: Sequence[Fit]) -> None:
        """Grow the trees of all fits; as many as ``FITS_TOGETHER`` and ``COLUMNS_TOGETHER`` allow share their jobs."""
        batch: list[Fit] = []
        for fit in fits:
            if batch and (len(batch) == FITS_TOGETHER or sum(len(f.columns) for f in [*batch, fit]) > COLUMNS_TOGETHER):
                self._grow(batch)
                batch = []
            batch.append(fit)
        if batch:
            self._grow(batch)

    def _grow(self, fits: list[Fit]) -> None:
        context = self.spark.sparkContext
        cuts = {(f.periods.upto, f.max_bins): self.splits(f.periods.upto, f.max_bins) for f in fits}
        tables = context.broadcast({k: bins for k, (_, bins) in cuts.items()})
        asked = {k: (f.columns, f.periods, (f.periods.upto, f.max_bins)) for k, f in enumerate(fits)}
        gaps = {k: np.array([len(cuts[f.periods.upto, f.max_bins][0][c][1]) for c in f.columns]) for k, f in enumerate(fits)}
        least = {k: f.min_rows for k, f in enumerate(fits)}
        scale, state, old, saved, before = self.scale, None, [], [], None
        halved = sum(len(f.columns) for f in fits) >= HALVED_COLUMNS
        try:
            while True:
                active = [k for k, f in enumerate(fits) if not f.done]
                made = {k: len(fits[k].trees) for k in active}
                # The forecasts so far with the last tree in them.
                last = {k: (fits[k].trees[-1], fits[k].weight(made[k] - 1)) for k in active if fits[k].trees}
                if not active:
                    return
                if last:
                    state = self._moved(state, last, {k: asked[k] for k in active}, scale)
                    if made[active[0]] % CHECKPOINT_ROUNDS == 0:
                        state.checkpoint()
                        saved.append(state)
                    old.append(state)
                growing = [k for k in active if made[k] < fits[k].rounds]
                trees = {k: Tree.empty(fits[k].depth) for k in growing}
                nodes_before: dict[int, list[int]] = {}
                for level in range(max((fits[k].depth for k in growing), default=1)):
                    open_nodes = {
                        k: [n for n in range(1 << level, 2 << level) if level == 0 or trees[k].feature[n // 2] >= 0]
                        for k in growing if level < fits[k].depth
                    }
                    open_nodes = {k: n for k, n in open_nodes.items() if n}
                    if not open_nodes and (level or not last):
                        break
                    counted = {k: _smaller(trees[k], n) if halved else n for k, n in open_nodes.items()}
                    sums = self._level(state, counted, trees, asked, tables, scale, len(fits), moments=level == 0 and bool(last))
                    if halved:
                        if level:
                            sums = _completed(sums, before, trees, open_nodes, nodes_before)
                        sums = sums.persist(StorageLevel.MEMORY_AND_DISK)
                    found = self._splits_of(sums, least, gaps, scale)
                    if before is not None:
                        before.unpersist()
                    before, nodes_before = sums if halved else None, open_nodes
                    for k, (train, held, squares) in found.pop("moments", {}).items():
                        fits[k].trees[-1].squares[:] = squares
                        fits[k].moments.append((train, held))
                        fits[k].judge()
                    for k in [k for k in trees if fits[k].done]:
                        del trees[k]
                    growing = [k for k in growing if k in trees]
                    for k, splits in found.items():
                        if k in trees:
                            self._place(trees[k], fits[k], open_nodes[k], splits, cuts[asked[k][2]][0])
                for k, tree in trees.items():
                    fits[k].trees.append(tree)
                while len(old) > 1:
                    old.pop(0).unpersist()
                while len(saved) > 1:
                    delete(self.spark, saved.pop(0).getCheckpointFile())
        finally:
            tables.unpersist()
            for left in [*old, *([] if before is None else [before])]:
                left.unpersist()
            for left in saved:
                if left.getCheckpointFile():
                    delete(self.spark, left.getCheckpointFile())

    def _moved(self, state: RDD | None, last: dict, asked: dict, scale: float) -> RDD:
        """Forecasts of every block with the last tree of each fit added, and what is summed up over them."""

        first = state is None  # tasks must not hold the RDD itself

        def move(pair: tuple) -> tuple:
            (t, y, codes, place), before = pair if not first else (pair, ({}, None))
            if before[1] is not None and before[1] != place:
                raise ValueError("forecasts and rows do not belong together")
            after = {}
            for k, (tree, weight) in last.items():
                columns, periods, _ = asked[k]
                rows = _slices(t, periods)
                parts = []
                values = tree.values() * weight
                was = before[0][k][0] if k in before[0] else None
                squares = np.zeros(len(values))
                for role, (low, high) in enumerate(rows):
                    node = _nodes(tree, codes[:, low:high], columns)
                    forecast = values[node] if was is None else was[role] + values[node]
                    if role == 0:
                        r = y[low:high] if was is None else 2 * (y[low:high] - was[role])
                        r = np.rint(r * scale) / scale
                        squares += np.bincount(node, r * r, minlength=len(values))
                    parts.append(forecast)
                after[k] = (parts, [Moments.of(y[low:high], p) for (low, high), p in zip(rows, parts, strict=True)], squares)
            return after, place

        moved = self.base.map(move) if state is None else self.base.zip(state).map(move)
        return _each(moved).persist(StorageLevel.MEMORY_AND_DISK)

    def _level(self, state: RDD | None, counted: dict, trees: dict, asked: dict, tables: Any, scale: float, fits: int, moments: bool) -> RDD:
        """Histograms of the nodes of every fit that are to be counted; with ``moments`` also sums over the forecasts so far."""

        first = state is None

        def count(found: Iterator) -> Iterator[tuple]:
            bins, kept, sums = tables.value, {}, {}
            for pair in found:
                (t, y, codes, _), before = pair if not first else (pair, ({}, None))
                if moments:
                    for k, (_, (train, held), squares) in before[0].items():
                        was = sums.get(k)
                        sums[k] = (train, held, squares) if was is None else (was[0] + train, was[1] + held, was[2] + squares)
                cells: dict = {}
                for k, nodes in counted.items():
                    columns, periods, cut = asked[k]
                    table = bins[cut]
                    low, high = _slices(t, periods)[0]
                    r = y[low:high] if k not in before[0] else 2 * (y[low:high] - before[0][k][0][0])
                    r = np.rint(r * scale)
                    width = int(table.max()) + 1
                    if k not in kept:
                        kept[k] = np.zeros((2, len(nodes), len(columns), width))
                    slot, chosen = None, slice(None)
                    n = len(nodes) * width
                    if nodes[0] > 1:
                        slots = np.full(len(trees[k].feature), -1)
                        slots[nodes] = np.arange(len(nodes))
                        slot = slots[_nodes(trees[k], codes[:, low:high], columns)]
                        chosen = np.flatnonzero(slot >= 0)
                        slot, r = (slot[chosen] * width).astype(np.uint16 if n <= 1 << 16 else np.int64), r[chosen]
                    for i, c in enumerate(columns):
                        if (cut, c, high) not in cells:
                            # Every code has its place in the table; "clip" only leaves out the check.
                            cells[cut, c, high] = table[c].take(codes[c, low:high], mode="clip")
                        cell = cells[cut, c, high]
                        index = cell if slot is None else slot + cell[chosen]
                        kept[k][0, :, i] += np.bincount(index, minlength=n).reshape(-1, width)
                        kept[k][1, :, i] += np.bincount(index, r, minlength=n).reshape(-1, width)
            yield from kept.items()
            yield from ((-1 - k, v) for k, v in sums.items())

        def add(a: Any, b: Any) -> Any:
            if isinstance(a, np.ndarray):
                a += b
                return a
            return a[0] + b[0], a[1] + b[1], a[2] + b[2]

        source = self.base if first else self.base.zip(state)
        return source.mapPartitions(count).reduceByKey(add, self._dealt(fits))

    def _dealt(self, fits: int) -> int:
        return max(1, min(self.base.getNumPartitions(), fits))

    def _splits_of(self, sums: RDD, least: dict, gaps: dict, scale: float) -> dict:
        """The best splits by fit, and the sums over forecasts as ``moments``."""

        def best(item: tuple) -> tuple:
            k, found = item
            return item if k < 0 else (k, _best(found, least[k], gaps[k], scale))

        out: dict = {}
        for k, v in sums.map(best).collect():
            if k < 0:
                out.setdefault("moments", {})[-1 - k] = v
            else:
                out[k] = v
        return out

    def _place(self, tree: Tree, fit: Fit, nodes: list[int], splits: tuple, cuts: list) -> None:
        """Put the splits found for one level into a tree."""
        rows, total, feature, place, gain, left_rows, left_total = splits
        for i, n in enumerate(nodes):
            tree.rows[n], tree.total[n] = rows[i], total[i]
            if feature[i] < 0:
                continue
            thresholds, below = cuts[fit.columns[feature[i]]]
            tree.feature[n], tree.code[n] = feature[i], below[place[i]]
            tree.threshold[n], tree.gain[n] = thresholds[place[i]], gain[i]
            for child, r, s in ((2 * n, left_rows[i], left_total[i]), (2 * n + 1, rows[i] - left_rows[i], total[i] - left_total[i])):
                tree.rows[child], tree.total[child] = r, s


def _smaller(tree: Tree, nodes: list[int]) -> list[int]:
    """Of every two children the one with fewer rows; the other one is what is left of the parent."""
    return nodes if nodes == [1] else [n if tree.rows[n] <= tree.rows[n + 1] else n + 1 for n in nodes if n % 2 == 0]


def _completed(sums: RDD, before: RDD, trees: dict, open_nodes: dict, nodes_before: dict) -> RDD:
    """Histograms of all open nodes from those of the smaller children and of the level before."""
    plan = {
        k: ([nodes_before[k].index(n // 2) for n in nodes[::2]], [n == s for n, s in zip(nodes[::2], _smaller(trees[k], nodes), strict=True)])
        for k, nodes in open_nodes.items()
    }

    def complete(item: tuple) -> tuple:
        k, (small, parents) = item
        places, left = plan[k]
        rest = parents[:, places] - small
        whole = np.empty((2, 2 * len(places), *small.shape[2:]))
        for i, first in enumerate(left):
            whole[:, 2 * i], whole[:, 2 * i + 1] = (small[:, i], rest[:, i]) if first else (rest[:, i], small[:, i])
        return k, whole

    return sums.join(before, sums.getNumPartitions()).map(complete, preservesPartitioning=True)


def _slices(t: np.ndarray, periods: Periods) -> list[tuple[int, int]]:
    """Where the training and the held-out rows of a block lie; blocks are sorted by period."""
    train = (0, int(np.searchsorted(t, periods.upto, "right")))
    if periods.until is None:
        return [train, (0, 0)]
    low, high = np.searchsorted(t, [periods.after, periods.until], "right")
    return [train, (int(low), int(high))]


def _nodes(tree: Tree, codes: np.ndarray, columns: Sequence[int]) -> np.ndarray:
    """The node of every row, as deep as the tree has grown."""
    node = np.ones(codes.shape[1], np.int16)
    for n in np.flatnonzero(tree.feature >= 0):  # parents come before their children
        here = node == n
        right = codes[columns[tree.feature[n]]] > tree.code[n]
        node += here * np.int16(n)
        node += here & right
    return node


def _best(found: np.ndarray, least: int, gaps: np.ndarray, scale: float) -> tuple:
    """Rows and sums of nodes, and the first of their best splits: feature, place, gain, rows and sum of the left part."""
    count, total = found[0], found[1] / scale
    n, s = count[:, 0].sum(-1), total[:, 0].sum(-1)
    left, left_sum = count.cumsum(-1)[..., :-1], total.cumsum(-1)[..., :-1]
    right, right_sum = n[:, None, None] - left, s[:, None, None] - left_sum
    allowed = (left >= max(1, least)) & (right >= max(1, least)) & (np.arange(left.shape[-1]) < gaps[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        # What splitting takes off the variance: the spread between the two parts.
        shift = left_sum / left - right_sum / right
        gain = left * right * shift * shift / (n * n)[:, None, None]
    gain = np.where(allowed, gain, -1.0).reshape(len(n), -1)
    if not gain.shape[1]:
        none = np.full(len(n), -1)
        return n, s, none, none, np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
    place = gain.argmax(-1)
    top = gain[np.arange(len(n)), place]
    feature, cut = np.divmod(place, left.shape[-1])
    at = (np.arange(len(n)), feature, cut)
    noise = 1e-15 * (1 + (s / np.maximum(n, 1)) ** 2)
    return n, s, np.where(top > noise, feature, -1), cut, top, left[at], left_sum[at]


def spark_model(spark: SparkSession, fit: Fit, features: int) -> GBTRegressionModel:
    """The trees of a fit as Spark's own model, which predicts, explains and saves itself."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    tree_package = jvm.org.apache.spark.ml.tree

    def node(tree: Tree, n: int) -> Any:
        rows, total, squares = float(tree.rows[n]), float(tree.total[n]), float(_squares(tree, n))
        stats = gateway.new_array(jvm.double, 3)
        stats[0], stats[1], stats[2] = rows, total, squares
        impurity = max(0.0, squares / rows - (total / rows) ** 2) if rows else 0.0
        known = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, int(rows))
        value = total / rows if rows else 0.0
        if tree.feature[n] < 0:
            return tree_package.LeafNode(value, impurity, known)
        split = tree_package.ContinuousSplit(int(tree.feature[n]), float(tree.threshold[n]))
        return tree_package.InternalNode(value, impurity, float(tree.gain[n]), node(tree, 2 * n), node(tree, 2 * n + 1), split, known)

    kept = fit.trees[: fit.best]
    regression = jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(regression.DecisionTreeRegressionModel, len(kept))
    weights = gateway.new_array(jvm.double, len(kept))
    for i, tree in enumerate(kept):
        trees[i] = regression.DecisionTreeRegressionModel(f"dtr_{i}", node(tree, 1), features)
        weights[i] = fit.weight(i)
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("GBTRegressionModel")
    model = GBTRegressionModel(regression.GBTRegressionModel(uid, trees, weights, features))
    return model.setFeaturesCol("_features").setPredictionCol("_prediction")


def _squares(tree: Tree, n: int) -> float:
    """Sum of squares below a node; leaves have theirs."""
    return tree.squares[n] if tree.feature[n] < 0 else _squares(tree, 2 * n) + _squares(tree, 2 * n + 1)


class Gathering:
    """Fits of threads that run together wait here until all of these threads do; then they share their jobs."""

    def __init__(self) -> None:
        self.ready, self.running, self.waiting = threading.Condition(), 0, []

    def count(self, more: int) -> None:
        with self.ready:
            self.running += more
            self.ready.notify_all()

    def fit(self, blocks: Blocks, asked: Fit) -> None:
        box: dict[str, Any] = {}
        with self.ready:
            self.waiting.append((blocks, asked, box))
            self.ready.notify_all()
            while "over" not in box:
                if len(self.waiting) >= self.running and any(w[2] is box for w in self.waiting):
                    break
                self.ready.wait()
            mine, self.waiting = ([], self.waiting) if "over" in box else (self.waiting, [])
        try:
            for found in {id(b): b for b, _, _ in mine}.values():
                found.fit([f for b, f, _ in mine if b is found])
        except BaseException as error:
            for _, _, other in mine:
                other["error"] = error
        with self.ready:
            for _, _, other in mine:
                other["over"] = True
            self.ready.notify_all()
        if "error" in box:
            raise box["error"]


GATHERING: ContextVar[Gathering | None] = ContextVar("gathering", default=None)


@contextmanager
def away(gathering: Gathering | None) -> Iterator[None]:
    """A thread that waits for others of its gathering asks for no fit meanwhile."""
    if gathering is None:
        yield
        return
    gathering.count(-1)
    try:
        yield
    finally:
        gathering.count(1)


def fit_shared(blocks: Blocks, asked: Fit) -> None:
    """Grow the trees of one fit, together with those that other threads of the gathering ask for."""
    gathering = GATHERING.get()
    if gathering is None:
        blocks.fit([asked])
    else:
        gathering.fit(blocks, asked)
