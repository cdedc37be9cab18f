"""Gradient boosting of a 0/1 label: log loss, trees on the residuals, one Newton step a leaf.

Columns are cut into ``BINS`` at their quantiles. Residuals and curvatures are whole multiples of 1 / ``ONE``, so
their sums are exact and a fit does not depend on how its rows lie. A table of up to ``CELLS`` codes, one byte each,
is grown in one task, all steps in one job; fits of folds and of several learners fill the cluster beside each
other. A larger table stays in its partitions and takes a job a level, and the margins are written again every
``REFRESH`` steps. Both ways give the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.operators.forest import BINS, LEAF, ForestVote, Tree, bin_bounds
from stratascore.session import materialize, release

ONE = 1 << 32
CELLS = 1 << 26  # codes of the rows that one task holds
CHUNK = 1 << 20  # codes counted at once
REFRESH = 10
ADDERS = 8  # tasks that add the sums of a pass
LEAST_SHARE = 1e-12  # of positives, so that one class has a margin


def taken(hashes: np.ndarray, step: int, share: float) -> np.ndarray:
    """Which rows a step sees: a draw of the row's own hash (splitmix64), so any layout repeats it."""
    if share >= 1.0:
        return np.ones(len(hashes), bool)
    z = hashes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(step + 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53 < share


def pulls(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residual and curvature of the log loss of each row, in whole multiples of 1 / ``ONE``."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((y - p) * ONE), np.rint(p * (1 - p) * ONE)


def totals(slots: np.ndarray, residual: np.ndarray, curvature: np.ndarray, nodes: int) -> np.ndarray:
    """Rows, residuals and curvatures per open node; rows of slot -1 are in none."""
    at = slots + 1
    return np.stack([np.bincount(at, w, nodes + 1)[1:] for w in (None, residual, curvature)], axis=1)


def histograms(codes: np.ndarray, slots: np.ndarray, residual: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """Rows and residuals per (open node, column, bin)."""
    width = codes.shape[1]
    out = np.zeros((2, nodes * width * bins))
    mine = np.flatnonzero(slots >= 0)
    offset = np.arange(width, dtype=np.int64) * bins
    step = max(1, CHUNK // max(1, width))
    for start in range(0, len(mine), step):
        rows = mine[start : start + step]
        cells = (codes[rows] + offset + (slots[rows] * (width * bins))[:, None]).ravel()
        out[0] += np.bincount(cells, minlength=out.shape[1])
        out[1] += np.bincount(cells, np.repeat(residual[rows], width), out.shape[1])
    return np.moveaxis(out.reshape(2, nodes, width, bins), 0, -1)


def best_cut(cells: np.ndarray) -> tuple[int, int] | None:
    """Column and last bin of the left side with the largest decrease of the residuals' variance; the first of equal ones."""
    left = cells.cumsum(axis=1)
    total = left[:, -1:]
    left = left[:, :-1]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - total[..., 1] ** 2 / total[..., 0]
    gain = np.where((left[..., 0] > 0) & (right[..., 0] > 0), gain / ONE**2, -np.inf)
    if not gain.size:
        return None
    place = int(gain.argmax())
    f, last = divmod(place, gain.shape[1])
    return (f, last) if gain[f, last] > 1e-12 else None


def empty_tree() -> Tree:
    return Tree([LEAF], [0.0], [0], [0], [0.0], [0])


def settle(tree: Tree, open_nodes: Sequence[int], sums: np.ndarray) -> None:
    """Give each open node the Newton step of its rows."""
    for node, (_, residual, curvature) in zip(open_nodes, sums.tolist()):
        tree.share[node] = residual / curvature if curvature > 0 else 0.0


def split(tree: Tree, open_nodes: Sequence[int], cells: np.ndarray) -> list[int]:
    """Split the open nodes where something is gained; their children, in code space, are open next."""
    children: list[int] = []
    for node, own in zip(open_nodes, cells):
        found = best_cut(own)
        if found is None:
            continue
        tree.feature[node], tree.bound[node] = found[0], float(found[1])
        for side in (tree.left, tree.right):
            side[node] = len(tree.feature)
            children.append(len(tree.feature))
            for column, value in ((tree.feature, LEAF), (tree.bound, 0.0), (tree.left, 0), (tree.right, 0), (tree.share, 0.0), (tree.depth, tree.depth[node] + 1)):
                column.append(value)
    return children


def slots_of(places: np.ndarray, open_nodes: Sequence[int], nodes: int) -> np.ndarray:
    """Position of each row's node among the open ones, -1 for others."""
    found = np.full(nodes, -1, np.int64)
    found[list(open_nodes)] = np.arange(len(open_nodes))
    return found[places]


def grow_in_memory(codes: np.ndarray, y: np.ndarray, hashes: np.ndarray, start: float, steps: int, depth: int, rate: float,
                   share: float, bins: int) -> Iterator[Tree]:
    margin = np.full(len(y), start)
    for step in range(steps):
        residual, curvature = pulls(margin, y)
        seen = taken(hashes, step, share)
        tree, open_nodes, cells = empty_tree(), [0], np.zeros(0)
        places = np.zeros(len(y), np.int64)
        for level in range(depth + 1):
            slots = np.where(seen, slots_of(places, open_nodes, len(tree.feature)), -1)
            sums = totals(slots, residual, curvature, len(open_nodes))
            settle(tree, open_nodes, sums)
            if level == depth:
                break
            if level == 0:
                cells = histograms(codes, slots, residual, 1, bins)
            else:  # children come in pairs: the smaller one is counted, the other is the rest of their parent
                small = np.where(sums[0::2, 0] <= sums[1::2, 0], 0, 1) + np.arange(0, len(open_nodes), 2)
                counted = np.full(len(open_nodes) + 1, -1, np.int64)
                counted[small] = np.arange(len(small))
                part = histograms(codes, counted[slots], residual, len(small), bins)
                parents = cells[[i for i, node in enumerate(before) if tree.feature[node] != LEAF]]
                cells = np.empty((len(open_nodes), *part.shape[1:]))
                cells[small], cells[small ^ 1] = part, parents - part
            before = open_nodes
            open_nodes = split(tree, open_nodes, cells)
            if not open_nodes:
                break
            feature, bound, left, right = (np.asarray(v) for v in (tree.feature, tree.bound, tree.left, tree.right))
            moving = np.flatnonzero((feature[places] != LEAF) & (left[places] >= open_nodes[0]))
            at = places[moving]
            places[moving] = np.where(codes[moving, feature[at]] <= bound[at], left[at], right[at])
        margin = margin + rate * np.asarray(tree.share)[places]
        yield tree


def fit_boosting(df: DataFrame, vector: str, n: int, width: int, steps: int = 100, depth: int = 3, rate: float = 0.1, share: float = 1.0,
                 key: str = "id", label: str = "label", seed: int = 42, bins: int = BINS) -> tuple[list[Tree], float]:
    """The trees and the margin they start from. ``share`` below 1 lets each step see so many of the rows, by hash of the key."""
    if not n:
        raise ValueError("no rows to train on")
    rows = df.select(vector_to_array(F.col(vector)).alias("x"), F.col(label).cast("int").alias("y"), F.xxhash64(F.col(key), F.lit(seed)).alias("h"))
    bounds = bin_bounds(rows, width, bins)
    positive = min(max(rows.agg(F.avg("y")).first()[0], LEAST_SHARE), 1 - LEAST_SHARE)
    start = math.log(positive / (1 - positive))
    most = max(map(len, bounds)) + 1
    grow = _grow_in_one_task if n * width <= CELLS else _grow_by_passes
    trees = grow(rows, bounds, start, steps, depth, rate, share, most)
    for tree in trees:  # from bins to the values at their ends
        tree.bound = [0.0 if f == LEAF else float(bounds[f][int(b)]) for f, b in zip(tree.feature, tree.bound)]
    return trees, start


def _coder(bounds: list[np.ndarray]) -> Callable[[pa.RecordBatch], np.ndarray]:
    def codes(batch: pa.RecordBatch) -> np.ndarray:
        x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
        return np.stack([np.searchsorted(b, x[:, i], side="left") for i, b in enumerate(bounds)], axis=1).astype(np.uint8)

    return codes


TREE = "step bigint, feature array<bigint>, bound array<double>, `left` array<bigint>, `right` array<bigint>, share array<double>, depth array<bigint>"


def _grow_in_one_task(rows: DataFrame, bounds: list[np.ndarray], start: float, steps: int, depth: int, rate: float, share: float,
                      bins: int) -> list[Tree]:
    coded = _coder(bounds)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(coded(b), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches if b.num_rows]
        if parts:
            codes, y, hashes = (np.concatenate(column) for column in zip(*parts))
            parts.clear()
            trees = list(grow_in_memory(codes, y, hashes, start, steps, depth, rate, share, bins))
            columns = [[getattr(t, name) for t in trees] for name in ("feature", "bound", "left", "right", "share", "depth")]
            kinds = [pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            lists = [pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(trees)), pa.int64()), *lists], ["step", "feature", "bound", "left", "right", "share", "depth"])

    found = rows.coalesce(1).mapInArrow(grow, TREE).collect()  # a row a step
    return [Tree(*(list(v) for v in row[1:])) for row in sorted(found, key=lambda row: row[0])]


def _grow_by_passes(rows: DataFrame, bounds: list[np.ndarray], start: float, steps: int, depth: int, rate: float, share: float,
                    bins: int) -> list[Tree]:
    coded, width = _coder(bounds), len(bounds)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = [row.tobytes() for row in coded(batch)]
                yield pa.RecordBatch.from_arrays([pa.array(codes), batch.column(1), batch.column(2), pa.array(np.full(batch.num_rows, start))], ["codes", "y", "h", "margin"])

    held = "codes binary, y int, h bigint, margin double"

    def columns(batch: pa.RecordBatch, since: list[Tree]) -> tuple[np.ndarray, ...]:
        codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, width)
        margin = batch.column(3).to_numpy()
        for tree in since:
            margin = margin + rate * np.asarray(tree.share)[tree.places(codes)]
        return codes, batch.column(1).to_numpy(), batch.column(2).to_numpy(), margin

    def sums_of(table: DataFrame, since: list[Tree], step: int, tree: Tree, open_nodes: list[int], cut: bool) -> tuple[np.ndarray, np.ndarray]:
        nodes = len(open_nodes)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = np.zeros((nodes, 3 + (2 * width * bins if cut else 0)), np.int64)
            for batch in batches:
                if not batch.num_rows:
                    continue
                codes, y, hashes, margin = columns(batch, since)
                residual, curvature = pulls(margin, y)
                slots = np.where(taken(hashes, step, share), slots_of(tree.places(codes), open_nodes, len(tree.feature)), -1)
                whole[:, :3] += totals(slots, residual, curvature, nodes).astype(np.int64)
                if cut:
                    whole[:, 3:] += histograms(codes, slots, residual, nodes, bins).reshape(nodes, -1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(range(nodes), pa.int64()), pa.array(list(whole), pa.list_(pa.int64()))], ["slot", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole: dict[int, np.ndarray] = {}
            for batch in batches:
                for slot, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                    part = row.values.to_numpy()
                    whole[slot] = whole[slot] + part if slot in whole else part
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array(list(whole), pa.int64()), pa.array(list(whole.values()), pa.list_(pa.int64()))], ["slot", "sums"])

        kind = "slot bigint, sums array<bigint>"
        found = table.mapInArrow(count, kind).repartition(ADDERS, "slot").mapInArrow(add, kind).collect()  # a row an open node
        out = np.array([row[1] for row in sorted(found)], float)
        return out[:, :3], out[:, 3:].reshape(nodes, width, -1, 2) if cut else out

    def refreshed(table: DataFrame, since: list[Tree]) -> DataFrame:
        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(columns(batch, since)[3])], ["codes", "y", "h", "margin"])

        return materialize(table.mapInArrow(move, held), "boosting")

    table = materialize(rows.mapInArrow(encode, held), "boosting")
    trees: list[Tree] = []
    since: list[Tree] = []
    for step in range(steps):
        tree, open_nodes = empty_tree(), [0]
        for level in range(depth + 1):
            sums, cells = sums_of(table, since, step, tree, open_nodes, level < depth)
            settle(tree, open_nodes, sums)
            open_nodes = split(tree, open_nodes, cells) if level < depth else []
            if not open_nodes:
                break
        trees.append(tree)
        since.append(tree)
        if len(since) == REFRESH and step + 1 < steps:
            moved = refreshed(table, since)
            release(table)
            table, since = moved, []
    release(table)
    return trees


class BoostedVote(ForestVote):
    """P(1) from the margin the trees add up to; their ``share`` is the step of a leaf."""

    start = Param(Params._dummy(), "start", "margin before the first tree", TypeConverters.toFloat)
    rate = Param(Params._dummy(), "rate", "share of each tree that is taken", TypeConverters.toFloat)

    def __init__(self, source: str | None = None, target: str | None = None, trees: Sequence[Tree] | None = None,
                 start: float | None = None, rate: float | None = None):
        super().__init__(source, target, trees)
        self._set(**{k: v for k, v in (("start", start), ("rate", rate)) if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, start, rate = self.trees(), self.get("start"), self.get("rate")

        @F.pandas_udf("double")
        def vote(vectors: pd.Series) -> pd.Series:
            x = np.array(vectors.tolist(), float).reshape(len(vectors), -1)
            margin = np.full(len(x), start)
            for tree in trees:
                margin = margin + rate * np.asarray(tree.share)[tree.places(x)]
            return pd.Series(1 / (1 + np.exp(-margin)))

        return df.withColumn(self.get("target"), vote(vector_to_array(F.col(self.get("source")))))
