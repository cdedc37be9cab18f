"""Random forest whose class weights are balanced in every bootstrap sample of its own.

A bag is a Poisson(1) count per row and tree, drawn from a hash of the row's key, so any engine with md5
can repeat it. The class weights of a bag come from one aggregate of those counts. Trees grow level by
level, all trees together: a pass sends every row down the trees as they are and counts copies per (open node,
feature drawn for it, bin, class); where they are added the split is picked too, and the driver gets that alone. Nothing is kept
between passes but the table, so a lost executor costs its part of one pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.operators.transform import _Stage
from stratascore.session import kept_between_passes

BINS = 32
MOST_COPIES = 9  # a Poisson(1) count is larger once in a million draws; such a draw counts as this
PER_HASH = 4  # draws of 32 bits in one md5
AT_ONCE = 1 << 22  # class counts of one pass: more open nodes take turns
ROWS_PER_TASK = 256
SLOTS_AT_ONCE = 1024  # open nodes in one batch of counts
JUDGES = 16  # tasks that add the counts of a pass
UNLIMITED = 30
LEAF = -1


def poisson_limits() -> list[int]:
    """A 32-bit draw gives as many copies as limits it reaches."""
    chances = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(MOST_COPIES)])
    return [int(c * (1 << 32)) for c in chances]


def bag_counts(key: Column, trees: int, seed: int) -> Column:
    """Array of each tree's copies of the row."""
    hashes = [F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(f"bag{i}")).cast("binary")) for i in range(-(-trees // PER_HASH))]
    draws = F.array(*[F.conv(F.substring(h, 8 * part + 1, 8), 16, 10).cast("bigint") for h in hashes for part in range(PER_HASH)][:trees])
    return F.transform(draws, lambda u: F.size(F.filter(F.lit(poisson_limits()), lambda limit: limit <= u)))


def bag_counts_sql(key: str, trees: int, seed: int) -> str:
    """The same for DuckDB: a table expression ``(key, tree, copies)`` is left to the caller; this gives one tree's draw."""
    steps = " + ".join(f"(u >= {limit})::INT" for limit in poisson_limits())
    return (f"(SELECT {steps} FROM (SELECT ('0x' || md5({key}::VARCHAR || ':{seed}:bag' || (tree // {PER_HASH})::VARCHAR)"
            f"[8 * (tree % {PER_HASH}) + 1 : 8 * (tree % {PER_HASH}) + 8])::BIGINT AS u))")


def bag_weights(df: DataFrame, trees: int, key: str = "id", label: str = "label", seed: int = 42) -> DataFrame:
    """``tree, label, n, weight``: copies of each class in each bag, and the weight that gives the classes of a bag equal totals.

    A class without a copy in a bag has no row there.
    """
    copies = df.select(F.col(label).cast("int").alias("label"), F.posexplode(bag_counts(F.col(key), trees, seed)).alias("tree", "copies"))
    counts = copies.groupBy("tree", "label").agg(F.sum("copies").cast("bigint").alias("n")).where("n > 0")
    totals = counts.groupBy("tree").agg(F.sum("n").alias("all"), F.count("*").alias("classes"))
    return counts.join(totals, "tree").select("tree", "label", "n", (F.col("all") / (F.col("classes") * F.col("n"))).alias("weight"))


@dataclass
class Tree:
    """Nodes as columns: the feature asked (``LEAF`` for none), rows at or below ``bound`` go left, ``share`` is P(1)."""

    feature: list[int]
    bound: list[float]
    left: list[int]
    right: list[int]
    share: list[float]
    depth: list[int]

    def places(self, x: np.ndarray) -> np.ndarray:
        feature, bound, left, right = (np.asarray(v) for v in (self.feature, self.bound, self.left, self.right))
        at = np.zeros(len(x), int)
        for _ in range(max(self.depth) + 1):
            asked = feature[at]
            inner = asked != LEAF
            if not inner.any():
                break
            low = x[np.arange(len(x)), np.where(inner, asked, 0)] <= bound[at]
            at = np.where(inner, np.where(low, left[at], right[at]), at)
        return at


def features_drawn(seed: int, tree: int, node: int, width: int) -> np.ndarray:
    """The features a node may split on: the square root of all, drawn anew for each node."""
    return np.sort(np.random.default_rng([seed, tree, node]).choice(width, max(1, int(math.sqrt(width))), replace=False))


def best_split(counts: np.ndarray) -> tuple[float, int, int] | None:
    """``counts`` by (feature drawn, bin, class): weighted Gini decrease, place of the feature, last bin of the left side.

    The first of equally good splits wins; None if nothing is gained.
    """
    left = counts.cumsum(axis=1)[:, :-1]
    total = counts.sum(axis=1)[:, None]
    right = total - left
    n_left, n_right, n = left.sum(axis=2), right.sum(axis=2), total.sum(axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        after = n_left - (left**2).sum(axis=2) / n_left + n_right - (right**2).sum(axis=2) / n_right
        gain = (n - (total**2).sum(axis=2) / n) - after
    gain = np.where((n_left > 0) & (n_right > 0), gain, -np.inf)
    place = int(gain.argmax())
    f, b = divmod(place, gain.shape[1])
    return (float(gain[f, b]), f, b) if gain[f, b] > 1e-12 * float(n[f, 0]) else None


def bin_bounds(rows: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Split points per feature: quantiles of the column, each once; one aggregate."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    one = rows.agg(*[F.percentile_approx(F.get("x", F.lit(i)), shares, 10_000).alias(f"q{i}") for i in range(width)]).first()
    return [np.unique(one[f"q{i}"] or []) for i in range(width)]


def _splits(table: DataFrame, trees: list[Tree], weights: np.ndarray, open_nodes: list[tuple[int, int, np.ndarray]],
            bounds: list[np.ndarray], tasks: int) -> list[tuple[np.ndarray, tuple[int, int] | None]]:
    """Per open node the weighted count of each class and its best split: place of the feature and last bin of the left side.

    Tasks return copies of each class per (open node, feature drawn, bin). They are added, weighted and judged where
    they meet, so the driver gets five numbers a node.
    """
    drawn = len(open_nodes[0][2])
    bins = max(map(len, bounds)) + 1
    shape = (len(open_nodes), drawn, bins, 2)
    by_tree: dict[int, list[tuple[int, int, np.ndarray]]] = {}
    for slot, (tree, node, features) in enumerate(open_nodes):
        by_tree.setdefault(tree, []).append((slot, node, features))
    grown = {t: trees[t] for t in by_tree}
    own_weights = weights[[tree for tree, _, _ in open_nodes]]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(shape, np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            any_rows = True
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            y = batch.column(1).to_numpy()
            copies = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            codes = np.stack([np.searchsorted(b, x[:, i], side="left") for i, b in enumerate(bounds)], axis=1)
            for tree, nodes in by_tree.items():
                drawn_rows = np.flatnonzero(copies[:, tree] > 0)
                at = grown[tree].places(x[drawn_rows])
                by = np.argsort(at, kind="stable")
                drawn_rows, at = drawn_rows[by], at[by]
                for slot, node, features in nodes:
                    mine = drawn_rows[np.searchsorted(at, node) : np.searchsorted(at, node, side="right")]
                    for place, f in enumerate(features):
                        cells = np.bincount(codes[mine, f] * 2 + y[mine], weights=copies[mine, tree], minlength=2 * bins)
                        total[slot, place] += cells.astype(np.int64).reshape(bins, 2)
        if any_rows:
            met = np.flatnonzero(total.any(axis=(1, 2, 3)))
            flat = total[met].reshape(len(met), -1)
            for start in range(0, len(met), SLOTS_AT_ONCE):
                part = flat[start : start + SLOTS_AT_ONCE]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, part.size + 1, part.shape[1], dtype=np.int32)), pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(met[start : start + SLOTS_AT_ONCE]), lists], ["slot", "counts"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            for slot, row in zip(batch.column(0).to_numpy().tolist(), rows):
                held[slot] = held[slot] + row if slot in held else row.copy()
        out = []
        for slot, row in held.items():
            counts = row.reshape(shape[1:]) * own_weights[slot]
            classes = counts[0].sum(axis=0)
            found = best_split(counts)
            out.append((slot, float(classes[0]), float(classes[1]), *(found[1:] if found else (-1, -1))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["slot", "n0", "n1", "place", "last"])

    counted = table.mapInArrow(count, "slot bigint, counts array<bigint>").repartition(max(1, min(tasks, JUDGES)), "slot")
    found: list[tuple[np.ndarray, tuple[int, int] | None]] = [(np.zeros(2), None)] * len(open_nodes)
    for row in counted.mapInArrow(judge, "slot bigint, n0 double, n1 double, place bigint, last bigint").toArrow().to_pylist():
        found[row["slot"]] = (np.array([row["n0"], row["n1"]]), None if row["place"] < 0 else (row["place"], row["last"]))
    return found


def fit_forest(df: DataFrame, vector: str, trees: int = 100, depth: int = 0, key: str = "id", label: str = "label",
               seed: int = 42, bins: int = BINS) -> list[Tree]:
    """Trees on Poisson bags, both classes of a bag of equal weight; ``depth`` 0 grows to ``UNLIMITED``.

    Labels are 0 and 1. A bag without rows is a tree of one leaf with share 0. Rows of one key have the
    same copies. What a task holds is bounded by ``AT_ONCE``; open nodes beyond it take another pass.
    """
    rows = df.select(vector_to_array(F.col(vector)).alias("x"), F.col(label).cast("int").alias("y"), bag_counts(F.col(key), trees, seed).alias("copies"))
    weights = np.zeros((trees, 2))
    for row in bag_weights(df, trees, key, label, seed).collect():  # two a tree
        weights[row["tree"], row["label"]] = row["weight"]
    with kept_between_passes(rows) as table:
        facts = table.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("width")).first()
        if not facts["n"]:
            raise ValueError("no rows to train on")
        width = facts["width"]
        tasks = max(1, min(table.rdd.getNumPartitions(), facts["n"] // ROWS_PER_TASK))
        table = table.coalesce(tasks)
        bounds = bin_bounds(table, width, bins)
        grown = [Tree([LEAF], [0.0], [0], [0], [0.0], [0]) for _ in range(trees)]
        level = [(t, 0) for t in range(trees)]
        drawn = max(1, int(math.sqrt(width)))
        turn = max(1, AT_ONCE // (drawn * (max(map(len, bounds)) + 1) * 2))
        for _ in range((depth or UNLIMITED) + 1):
            following: list[tuple[int, int]] = []
            for start in range(0, len(level), turn):
                part = [(t, node, features_drawn(seed, t, node, width)) for t, node in level[start : start + turn]]
                for (t, node, features), (classes, found) in zip(part, _splits(table, grown, weights, part, bounds, tasks)):
                    following += _grow(grown[t], t, node, features, classes, found, bounds, depth or UNLIMITED)
            level = following
            if not level:
                break
    return grown


def _grow(tree: Tree, number: int, node: int, features: np.ndarray, classes: np.ndarray, found: tuple[int, int] | None,
          bounds: list[np.ndarray], depth: int) -> list[tuple[int, int]]:
    """Close the node or split it; gives its children."""
    total = classes.sum()
    tree.share[node] = float(classes[1] / total) if total > 0 else 0.0
    if tree.depth[node] >= depth or min(classes) <= 0:
        return []
    if found is None:
        return []
    place, last = found
    f = int(features[place])
    tree.feature[node], tree.bound[node] = f, float(bounds[f][last])
    children = []
    for side in (tree.left, tree.right):
        side[node] = len(tree.feature)
        children.append((number, len(tree.feature)))
        for column, value in ((tree.feature, LEAF), (tree.bound, 0.0), (tree.left, 0), (tree.right, 0), (tree.share, 0.0), (tree.depth, tree.depth[node] + 1)):
            column.append(value)
    return children


class ForestVote(_Stage, Transformer):
    """Mean share of the leaves a row falls into; the trees are params, so the stage saves and loads with any pipeline."""

    source = Param(Params._dummy(), "source", "vector column", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "new column", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "nodes per tree", TypeConverters.toListInt)
    nodes = Param(Params._dummy(), "nodes", "feature, bound, left, right, share and depth of every node", TypeConverters.toListFloat)

    def __init__(self, source: str | None = None, target: str | None = None, trees: Sequence[Tree] | None = None):
        flat = None if trees is None else [float(v) for t in trees for node in zip(t.feature, t.bound, t.left, t.right, t.share, t.depth) for v in node]
        super().__init__(source=source, target=target, sizes=None if trees is None else [len(t.feature) for t in trees], nodes=flat)

    def trees(self) -> list[Tree]:
        table = np.array(self.get("nodes")).reshape(-1, 6)
        out = []
        for part in np.split(table, np.cumsum(self.get("sizes"))[:-1]):
            feature, bound, left, right, share, depth = part.T
            out.append(Tree(feature.astype(int).tolist(), bound.tolist(), left.astype(int).tolist(), right.astype(int).tolist(),
                            share.tolist(), depth.astype(int).tolist()))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        trees = self.trees()

        @F.pandas_udf("double")
        def vote(vectors: pd.Series) -> pd.Series:
            x = np.array(vectors.tolist(), float).reshape(len(vectors), -1)
            total = np.zeros(len(x))
            for tree in trees:
                total += np.asarray(tree.share)[tree.places(x)]
            return pd.Series(total / len(trees))

        return df.withColumn(self.get("target"), vote(vector_to_array(F.col(self.get("source")))))
