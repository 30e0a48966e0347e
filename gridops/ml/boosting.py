"""Leaf-wise gradient boosting on second-order histograms.

Rows stay on the executors. Every level of a tree needs the sums of gradients and hessians per (node, feature,
bin) of all rows: a pass sums them inside a task, then over tasks. Rows that one task goes through in a pass
anyway (``ROWS_PER_TASK``) stay in that task for all passes and trees, one job; beyond that every level is a
job over arrays of rows held on the executors. Both give the same trees. What reaches the driver is bounded by the
parameters (at most ``2 ** (depth - 2) * features * bins`` sums of each of ``PARTS_TOLD`` tasks a pass), and the model.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridops.session import scratch_path

#: Sums are of whole numbers of this part of a unit, so that they do not depend on the order of the rows.
UNIT = 1 << 24
#: Rows that a task goes through in one pass. Up to so many, one task is done with all trees before the jobs of all levels
#: have merely been started (about 0.1 s each), and needs some 150 bytes a row.
ROWS_PER_TASK = 2_000_000
#: Rows that are worth a task of their own where cores are free.
ROWS_WORTH_A_TASK = 50_000
#: Rows of one block of arrays.
ROWS_PER_BLOCK = 100_000
#: Tasks whose sums the driver adds up itself; those of more tasks are added on the executors first.
PARTS_TOLD = 32
#: Fixed multiplier and modulus of the draw that picks the rows of a tree.
DRAW, DRAWS = 1_103_515_245, 1 << 31


@dataclass(frozen=True)
class Settings:
    """Fixed values of the model: rounds, rate, leaves, depth, rows of a leaf, sampling, L1 and L2 penalty of the leaves."""

    rounds: int = 300
    rate: float = 0.03
    leaves: int = 31
    depth: int = 6
    leaf_rows: int = 50
    row_share: float = 0.85
    column_share: float = 0.85
    l1: float = 0.1
    l2: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes in arrays; a node without a feature (-1) is a leaf. Rows of a bin up to ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    weight: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    level: list[int] = field(default_factory=lambda: [0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> int:
        """Number of the left one of two new leaves below ``node``; the right one is the next."""
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut, at, gain
        for _ in range(2):
            for values, value in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.gain, 0.0), (self.weight, 0.0), (self.rows, 0), (self.level, self.level[node] + 1)):
                values.append(value)
        return at

    def step(self, at: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """Where rows of ``bins`` (rows x features) that stand at these nodes stand one level below; in a leaf they stay."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        f = feature[at]
        return np.where(f >= 0, left[at] + (bins[np.arange(len(bins)), f] > cut[at]), at)

    def places(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of each row of ``bins`` (rows x features)."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(max(self.level)):
            at = self.step(at, bins)
        return at


def sampled_columns(names: list[str], tree: int, settings: Settings) -> list[int]:
    rng = np.random.default_rng((settings.seed, tree))
    return sorted(rng.permutation(len(names))[: max(1, int(len(names) * settings.column_share))].tolist())


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    """Gradient sums shrunk towards 0 by the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def _worth(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    return _soft(g, s.l1) ** 2 / (h + s.l2)


def best_split(sums: np.ndarray, columns: list[int], s: Settings) -> tuple[float, int, int] | None:
    """``gain, feature, cut`` of the best split of one node (``sums``: features x bins x gradient, hessian, rows).

    The lowest feature and cut win a tie; None if no split leaves ``leaf_rows`` on both sides and gains.
    """
    left = sums.cumsum(axis=1)
    whole = left[:, -1:, :]
    right = whole - left
    gains = _worth(left[..., 0], left[..., 1], s) + _worth(right[..., 0], right[..., 1], s) - _worth(whole[..., 0], whole[..., 1], s)
    ok = (left[..., 2] >= s.leaf_rows) & (right[..., 2] >= s.leaf_rows)
    ok[[f for f in range(len(ok)) if f not in columns]] = False
    gains = np.where(ok, gains, -np.inf)
    at = int(gains.argmax())
    gain = float(gains.flat[at])
    return (gain, *divmod(at, gains.shape[1])) if gain > 1e-9 else None


def leaf_wise(root: int, expand: dict[int, tuple], s: Settings) -> list[int]:
    """Nodes to split, best gain first, until there are ``leaves`` leaves.

    ``expand`` has ``gain, feature, cut, left child`` of every node that has a split; a
    node may be split once its parent is.
    """
    chosen, heap = [], []
    if root in expand:
        heap = [(-expand[root][0], root)]
    while heap and len(chosen) + 1 < s.leaves:
        _, node = heapq.heappop(heap)
        chosen.append(node)
        for child in (expand[node][3], expand[node][3] + 1):
            if child in expand:
                heapq.heappush(heap, (-expand[child][0], child))
    return chosen


def _raw(bins: np.ndarray, base: np.ndarray, trees: list[Tree]) -> np.ndarray:
    for tree in trees:
        base = base + np.array(tree.weight)[tree.places(bins)]
    return base


def bins_of(columns: list[np.ndarray], borders: list[list[float]]) -> np.ndarray:
    """Bin of each value (rows x features): how many borders are below it; a missing value is in bin 0."""
    return np.stack([np.where(np.isnan(x), 0, np.searchsorted(b, x)) for x, b in zip(columns, borders, strict=True)], axis=1)


def descended(tree: Tree, bins: Mapping[int, np.ndarray] | np.ndarray, rows: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The numbers of the rows that stand at each node, followed down to where the tree ends; ``bins`` by feature."""
    rows = dict(rows)
    for node, (f, cut, left) in enumerate(zip(tree.feature, tree.cut, tree.left, strict=True)):  # children follow their parents
        if f >= 0 and node in rows:
            own = rows.pop(node)
            up = bins[f][own] > cut
            rows[left], rows[left + 1] = own[~up], own[up]
    return rows


@dataclass
class Block:
    """Training rows in arrays: bins (features x rows), target, weight, draw, raw score so far."""

    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    draw: np.ndarray
    raw: np.ndarray

    def drawn(self, number: int, columns: list[int], s: Settings) -> tuple[dict[int, np.ndarray], list[np.ndarray]]:
        """Bins by feature of the rows drawn for a tree, their gradients and hessians in whole numbers of ``UNIT``."""
        factor = DRAW * (2 * number + 1) % DRAWS
        mine = np.flatnonzero((self.draw * factor & (DRAWS - 1)) // 65_536 % 100 < round(s.row_share * 100))
        y, w = self.y[mine], self.w[mine]
        p = 1 / (1 + np.exp(-self.raw[mine]))
        return {f: self.bins[f][mine] for f in columns}, [np.rint(w * (p - y) * UNIT), np.rint(w * p * (1 - p) * UNIT)]

    def advanced(self, tree: Tree) -> Block:
        """The rows with a tree added to their raw scores."""
        raw = self.raw.copy()
        for leaf, own in descended(tree, self.bins, {0: np.arange(len(raw))}).items():
            raw[own] += tree.weight[leaf]
        return Block(self.bins, self.y, self.w, self.draw, raw)


def blocks(batches: Iterable[pa.RecordBatch], borders: list[list[float]], start: float, bins: int, most: int | None) -> Iterator[Block]:
    """Blocks of at most ``most`` rows, or one of all rows, from batches of what ``learned`` selects."""
    found, rows = [], 0
    kind = np.uint8 if bins <= 256 else np.uint16

    def joined() -> Block:
        bins, y, w, draw = zip(*found, strict=True) if found else [[np.zeros((len(borders), 0), kind)], [np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)]]
        y = np.concatenate(y)
        return Block(np.concatenate(bins, axis=1), y, np.concatenate(w), np.concatenate(draw), np.full(len(y), start))

    for batch in batches:
        for at in range(0, batch.num_rows, most or max(batch.num_rows, 1)):
            part = batch.slice(at, most)
            if found and most and rows + part.num_rows > most:
                yield joined()
                found, rows = [], 0
            features = [part[f"x{i}"].to_numpy(zero_copy_only=False) for i in range(len(borders))]
            found.append((bins_of(features, borders).astype(kind).T, *(part[c].to_numpy() for c in ("y", "w", "draw"))))
            rows += part.num_rows
    yield joined()


def _sums(rows: dict[int, np.ndarray], nodes: list[int], bins: dict[int, np.ndarray], parts: list[np.ndarray], s: Settings) -> np.ndarray:
    """Sums of gradient, hessian and rows in whole numbers: nodes x sampled columns x bins x 3."""
    out = np.zeros((len(nodes), len(bins), s.bins, 3), np.int64)
    # Sums below 2 ** 53 are exact in floating point, whatever their order.
    exact = [np.abs(p).sum() < 1 << 52 for p in parts]
    for sums, node in zip(out, nodes, strict=True):
        here = rows.get(node, np.zeros(0, np.int64))
        own = [p[here] for p in parts]
        for told, column in zip(sums, bins.values(), strict=True):
            cell = column[here].astype(np.int64)
            for k, part in enumerate(own):
                if exact[k]:
                    told[:, k] = np.bincount(cell, part, s.bins)
                else:
                    np.add.at(told[:, k], cell, part.astype(np.int64))
            told[:, 2] = np.bincount(cell, minlength=s.bins)
    return out


def _histogram(counted: Callable[[Tree, list[int]], np.ndarray], columns: list[int], n: int, s: Settings) -> Callable[[Tree, list[int]], np.ndarray]:
    """Sums of gradient, hessian and rows of nodes of one tree: nodes x features x bins x 3.

    ``counted`` gives those of some nodes and the sampled columns by going through the rows. Of two sides the
    smaller one is counted, the other one is what its parent has more.
    """
    known: dict[int, np.ndarray] = {}

    def histogram(growing: Tree, nodes: list[int]) -> np.ndarray:
        above = {left: k for k, (f, left) in enumerate(zip(growing.feature, growing.left, strict=True)) if f >= 0}
        smaller, rest = [], {}
        for left in sorted({x if x in above else x - 1 for x in nodes}) if nodes != [0] else []:
            whole = known[above[left]]
            sides = whole[growing.feature[above[left]], :, 2].cumsum()
            less = 2 * sides[growing.cut[above[left]]] <= sides[-1]
            smaller.append(left if less else left + 1)
            rest[left + 1 if less else left] = (whole, smaller[-1])
        smaller = smaller or [0]
        for x, found in zip(smaller, counted(growing, smaller), strict=True):
            known[x] = np.zeros((n, s.bins, 3), np.int64)
            known[x][columns] = found
        for x, (whole, other) in rest.items():
            known[x] = whole - known[other]
        return np.stack([known[x] for x in nodes]) / np.array([UNIT, UNIT, 1])

    return histogram


def grow_tree(histogram: Callable[[Tree, list[int]], np.ndarray], number: int, names: list[str], s: Settings) -> Tree:
    """The next tree: candidates are split level by level, then the best leaves are kept as long as there may be more.

    ``histogram`` gives the sums of nodes of a growing tree (see ``_histogram``), of the sampled columns at least.
    """
    columns = sampled_columns(names, number, s)
    full, expand, stats = Tree(), {}, {}
    nodes = [0]
    for _ in range(s.depth):
        sums = histogram(full, nodes)
        following = []
        for node, own in zip(nodes, sums, strict=True):
            stats[node] = own[columns[0]].sum(axis=0)
            found = best_split(own, columns, s)
            if found:
                gain, feature, cut = found
                left = full.split(node, feature, cut, gain)
                expand[node] = (gain, feature, cut, left)
                stats[left] = own[feature, : cut + 1].sum(axis=0)
                stats[left + 1] = own[feature, cut + 1 :].sum(axis=0)
                following += [c for c in (left, left + 1) if stats[c][2] >= 2 * s.leaf_rows]
        nodes = following
        if not nodes:
            break
    out, place = Tree(), {0: 0}
    for node in leaf_wise(0, expand, s):
        gain, feature, cut, left = expand[node]
        at = out.split(place[node], feature, cut, gain)
        place |= {left: at, left + 1: at + 1}
    for node, at in place.items():
        g, h, count = stats[node]
        out.weight[at] = float(-_soft(np.array(g), s.l1) / (h + s.l2) * s.rate)
        out.rows[at] = int(count)
    return out


def _tree_of(block: Block, number: int, names: list[str], s: Settings) -> Tree:
    """The next tree of a training set that is one block."""
    columns = sampled_columns(names, number, s)
    bins, parts = block.drawn(number, columns, s)
    rows = {0: np.arange(len(parts[0]))}

    def counted(growing: Tree, nodes: list[int]) -> np.ndarray:
        nonlocal rows
        rows = descended(growing, bins, rows)
        return _sums(rows, nodes, bins, parts, s)

    return grow_tree(_histogram(counted, columns, len(names), s), number, names, s)


def _grown_at_once(rows: DataFrame, names: list[str], borders: list[list[float]], start: float, s: Settings) -> list[Tree]:
    """All trees, by one task that keeps the few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (block,), trees = blocks(batches, borders, start, s.bins, None), []
        for number in range(s.rounds):
            tree = _tree_of(block, number, names, s)
            block = block.advanced(tree)
            trees.append(json.dumps(asdict(tree)))
        yield pa.record_batch([pa.array(range(len(trees)), pa.int32()), pa.array(trees, pa.string())], ["tree", "value"])

    told = rows.repartition(1).mapInArrow(run, "tree int, value string").collect()
    return [Tree(**json.loads(r["value"])) for r in sorted(told)]


def _counted(kept: RDD, growing: Tree, nodes: list[int], number: int, columns: list[int], s: Settings) -> np.ndarray:
    """What ``_sums`` says of all blocks, one job."""

    def run(found: Iterator[Block]) -> Iterator[np.ndarray]:
        sums = np.zeros((len(nodes), len(columns), s.bins, 3), np.int64)
        for block in found:
            bins, parts = block.drawn(number, columns, s)
            sums += _sums(descended(growing, bins, {0: np.arange(len(parts[0]))}), nodes, bins, parts, s)
        yield sums

    sums = kept.mapPartitions(run)
    return sums.treeReduce(np.add) if kept.getNumPartitions() > PARTS_TOLD else sum(sums.collect())


def _grown_by_level(rows: DataFrame, names: list[str], borders: list[list[float]], start: float, s: Settings, parts: int, every: int) -> list[Tree]:
    """All trees, a job a level over blocks that are kept in memory with their raw scores.

    The blocks of a tree follow from those of the tree before; what is lost is computed anew, from blocks
    that are written first and after ``every`` trees.
    """
    context, bins = rows.sparkSession.sparkContext, s.bins

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, borders, start, bins, ROWS_PER_BLOCK):
            yield pa.record_batch([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    def written(some: RDD) -> RDD:
        path = scratch_path(rows.sparkSession, "boosting")
        some.saveAsPickleFile(path, 1)
        return context.pickleFile(path, 1)

    keep = lambda some: some.persist(StorageLevel.MEMORY_AND_DISK)
    kept = [keep(written(rows.repartition(parts).mapInArrow(packed, "block binary").rdd.map(lambda r: pickle.loads(r["block"]))))]
    trees: list[Tree] = []
    try:
        for number in range(s.rounds):
            columns = sampled_columns(names, number, s)
            counted = lambda growing, nodes: _counted(kept[-1], growing, nodes, number, columns, s)  # noqa: E731, B023
            trees.append(grow_tree(_histogram(counted, columns, len(names), s), number, names, s))
            while len(kept) > 1:  # by now the last ones are in memory
                kept.pop(0).unpersist()
            if len(trees) < s.rounds:
                following = kept[-1].map(lambda block, tree=trees[-1]: block.advanced(tree))
                kept.append(keep(following if len(trees) % every else written(following)))
    finally:
        for some in kept:
            some.unpersist()
    return trees


@dataclass
class BoostedModel:
    """Trees, the bin borders of the features and the score that all rows start from."""

    names: list[str]
    borders: list[list[float]]
    start: float
    trees: list[Tree]
    settings: Settings

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        return bins_of(columns, self.borders)

    def risk(self) -> Column:
        """Probability of class 1 of the rows of a frame that has the features."""
        model = self

        @F.pandas_udf("double")
        def probability(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                bins = model.bins([c.to_numpy(float, na_value=np.nan) for c in columns])
                yield pd.Series(1 / (1 + np.exp(-_raw(bins, np.full(len(bins), model.start), model.trees))))

        return probability(*(F.col(c).cast("double") for c in self.names))

    def importances(self) -> list[float]:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(len(self.names))
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain, strict=True):
                total[f] += gain if f >= 0 else 0
        return (total / total.sum() if total.any() else total).tolist()

    def nodes(self, spark: SparkSession) -> DataFrame:
        """``tree, node, level, feature, border, gain, weight, left, rows`` of all trees; leaves have no feature."""
        rows = []
        for i, t in enumerate(self.trees):
            for k, f in enumerate(t.feature):
                named = (self.names[f], self.borders[f][t.cut[k]]) if f >= 0 else (None, None)
                rows.append((i, k, t.level[k], *named, t.gain[k] if f >= 0 else None, t.weight[k], t.left[k] if f >= 0 else None, t.rows[k]))
        return spark.createDataFrame(rows, "tree int, node int, level int, feature string, border double, gain double, weight double, left int, rows bigint")

    def save(self, spark: SparkSession, path: str) -> None:
        trees = [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)]
        head = {"names": self.names, "borders": self.borders, "start": self.start, "settings": asdict(self.settings)}
        spark.createDataFrame([(-1, json.dumps(head)), *trees], "tree int, value string").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        rows = {r["tree"]: json.loads(r["value"]) for r in spark.read.parquet(path).collect()}
        head = rows.pop(-1)
        return BoostedModel(head["names"], head["borders"], head["start"], [Tree(**rows[i]) for i in sorted(rows)], Settings(**head["settings"]))


def bin_borders(rows: DataFrame, names: list[str], bins: int) -> list[list[float]]:
    """Distinct quantiles of each feature, ``bins - 1`` at most, from bounded sketches (exact up to 10,000 values).

    A quantile that is not a number is above no value and is no border.
    """
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(F.col(c).cast("double"), shares).alias(c) for c in names)).first()
    return [sorted({x for x in found[c] or [] if not math.isnan(x)}) for c in names]


def learned(rows: DataFrame, names: list[str], target: str, weight: str | None, key: Column | None) -> DataFrame:
    """What is learned from a row: its features, target, weight and draw."""
    key = F.xxhash64(*names, target) if key is None else key
    return rows.select(
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)),
        F.col(target).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
        F.pmod(key.cast("bigint"), F.lit(DRAWS).cast("bigint")).alias("draw"),
    )


def boost(train: DataFrame, names: list[str], target: str = "target", weight: str | None = "weight", key: Column | None = None, settings: Settings | None = None, block: int = 25) -> BoostedModel:
    """Fit a binary classifier on ``train``.

    Trees start from the weighted log-odds. Each tree sees ``column_share`` of the features and the rows
    whose ``key`` (a whole number; by default a hash of the features) is drawn for it, so the same rows
    give the same model however they are dealt out. Up to ``ROWS_PER_TASK`` rows the
    trees are one job, else a job a level; then the rows are written after every ``block`` trees,
    so a lost task computes as many trees' scores anew at most. An empty table, or one of a single
    class, gives a model without trees.
    """
    s = settings or Settings()
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    told = train.agg(F.sum(F.when(F.col(target) == 1, w).otherwise(0.0)).alias("one"), F.sum(F.when(F.col(target) == 1, 0.0).otherwise(w)).alias("zero"), F.count("*").alias("n")).first()
    one, zero = told["one"] or 0.0, told["zero"] or 0.0
    if not one or not zero:
        return BoostedModel(list(names), [[] for _ in names], math.inf if one else -math.inf, [], s)
    start, borders = math.log(one / zero), bin_borders(train, names, s.bins)
    rows = learned(train, names, target, weight, key)
    if told["n"] <= ROWS_PER_TASK:
        trees = _grown_at_once(rows, list(names), borders, start, s)
    else:
        free = min(rows.sparkSession.sparkContext.defaultParallelism, -(-told["n"] // ROWS_WORTH_A_TASK))
        trees = _grown_by_level(rows, list(names), borders, start, s, max(free, -(-told["n"] // ROWS_PER_TASK)), block)
    return BoostedModel(list(names), borders, start, trees, s)
