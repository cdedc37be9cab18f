"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Vectors get one more component, the root of (largest norm squared - own norm squared), which turns the
largest inner product into the smallest angle. The trees are cut on a bounded sample of ``SAMPLE``
vectors (each node splits at the median along the line through two of its vectors); every row is then
sent down every tree. A query walks all trees through one shared priority queue, best margin first,
until the leaves it took hold enough rows, and every row of those leaves is compared exactly.

How many rows are enough is measured, not guessed: for ``PROBES`` sampled vectors the true neighbours
are found by comparing them with all rows, and the budget is the least that would have found
``TARGET`` of them. Vectors without structure need most of the table, clustered ones little of it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratascore.session import materialize

TREES = 4
SAMPLE = 16_384
LEAF_ROWS = 512
SAMPLE_PER_LEAF = 8
PROBES = 64
TARGET = 0.96
GROUP_ROWS = 32_768  # rows of neighbouring leaves that one unit of work compares
UNIT_QUERIES = 1_024
WALKS_PER_TASK = 256
STRIP = 64


class Forest:
    """Flat trees: node i splits by ``normals[i]`` at ``cuts[i]``; children < 0 are leaves ``-1 - child``."""

    def __init__(self, sample: np.ndarray, largest: float, leaves: int, trees: int = TREES, seed: int = 7):
        self.largest, rng = largest, np.random.RandomState(seed)
        points = self.lifted(sample)
        normals, cuts, kids, self.roots, self.n_leaves = [], [], [], [], 0

        def grow(rows: np.ndarray, want: int) -> int:
            if want > 1 and len(rows) > 1:
                a, b = points[rng.choice(rows, 2, replace=False)]
                line = a - b if np.any(a != b) else rng.normal(size=points.shape[1])
                along = points[rows] @ line
                cut = float(np.median(along))
                low, high = rows[along <= cut], rows[along > cut]
                if len(low) and len(high):
                    node = len(cuts)
                    normals.append(line / np.linalg.norm(line))
                    cuts.append(cut / np.linalg.norm(line))
                    kids.append(None)
                    kids[node] = (grow(low, want // 2), grow(high, want - want // 2))
                    return node
            self.n_leaves += 1
            return -self.n_leaves

        for _ in range(trees):
            self.roots.append(grow(np.arange(len(points)), leaves))
        width = points.shape[1]
        self.normals, self.cuts = np.array(normals).reshape(-1, width), np.array(cuts)
        self.kids = np.array(kids, np.int64).reshape(-1, 2)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        gap = np.sqrt(np.maximum(self.largest**2 - (vectors * vectors).sum(axis=1), 0.0))
        return np.hstack([vectors, gap[:, None]])

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree, rows x trees."""
        points, out = self.lifted(vectors), []
        for root in self.roots:
            at = np.full(len(points), root)
            while (inner := np.nonzero(at >= 0)[0]).size:
                node = at[inner]
                high = (points[inner] * self.normals[node]).sum(axis=1) > self.cuts[node]
                at[inner] = self.kids[node, high.astype(np.int64)]
            out.append(-1 - at)
        return np.stack(out, axis=1)

    def margins(self, queries: np.ndarray) -> np.ndarray:
        return queries @ self.normals[:, :-1].T - self.cuts if len(self.cuts) else np.zeros((len(queries), 0))

    def walk(self, margins: np.ndarray) -> Iterator[int]:
        """Leaves of all trees, best first: a leaf's worth is the worst margin on its way."""
        queue = [(-math.inf, root) for root in self.roots]
        heapq.heapify(queue)
        while queue:
            cost, node = heapq.heappop(queue)
            if node < 0:
                yield -1 - node
                continue
            low, high = self.kids[node].tolist()
            heapq.heappush(queue, (max(cost, float(margins[node])), low))
            heapq.heappush(queue, (max(cost, -float(margins[node])), high))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _best(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of each query, equal scores to the smaller id."""
    ordered = frame.drop_duplicates(["query", "rep"]).sort_values(["query", "score", "rep"], ascending=[True, False, True])
    return ordered.groupby("query", sort=False).head(k)


def _usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Finite, non-zero vectors of the commonest length, one row per key and vector."""
    sound = F.expr("size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf')) AND exists(v, x -> x <> 0)")
    rows = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(sound)
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    width = widths.orderBy(F.desc("n"), "width").first()
    return rows.where(F.size("v") == (width.width if width else 0)).dropDuplicates(["id", "v"])


def _budget(points: DataFrame, forest: Forest, sizes: np.ndarray, k: int) -> int:
    """Rows a query must compare for ``TARGET`` of the true neighbours, measured on ``PROBES`` vectors."""
    probes = points.orderBy(F.xxhash64(F.lit("probe"), "rep"), "rep").limit(PROBES).toPandas()
    asked, names = _matrix(probes["v"]), probes["rep"].to_numpy()

    def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = None
        for frame in frames:
            if not len(frame):
                continue
            scores = asked @ _matrix(frame["v"]).T
            scores[names[:, None] == frame["rep"].to_numpy()[None, :]] = -np.inf
            top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            part = pd.DataFrame({"query": np.repeat(np.arange(len(names)), top.shape[1]), "score": np.take_along_axis(scores, top, 1).ravel(),
                                 "rep": frame["rep"].to_numpy()[top].ravel(), "at": top.ravel()})
            part["v"] = frame["v"].to_numpy()[part.pop("at").to_numpy()]
            best = _best(part if best is None else pd.concat([best, part]), k)
        if best is not None:
            yield best[["query", "rep", "score", "v"]]

    found = points.mapInPandas(nearest, "query int, rep bigint, score double, v array<double>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    true = found.where(F.col("score") > float("-inf")).withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).toPandas()
    total = int(sizes.sum()) + 1
    if true.empty:
        return total
    homes, needs = forest.leaves_of(_matrix(true["v"])), []
    margins = forest.margins(asked)
    for query, part in true.groupby("query"):
        wanted, rows = homes[part.index], 0
        first = np.full(len(part), float(total))
        for leaf in forest.walk(margins[query]):
            rows += int(sizes[leaf])
            hit = (wanted == leaf).any(axis=1)
            first[hit] = np.minimum(first[hit], rows)
            if (first < total).all():
                break
        needs.extend(first)
    return int(np.quantile(needs, TARGET, method="higher"))


def nearest_vectors(rows: DataFrame, queries: str = "vec_id % 20 = 0", k: int = 20, key: str = "vec_id",
                    vector: str = "embedding", trees: int = TREES) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that the SQL condition ``queries`` names.

    The score is the inner product in double precision on the original vectors; equal scores go to the
    smaller id, a query never finds its own id, and with fewer than ``k`` candidates all come back. Equal
    vectors are one point with its ``k + 1`` smallest ids, which is all that a list of ``k`` can show, so
    a vector that fills a third of the table is one row of the index. Null, zero and non-finite vectors,
    null ids and vectors of another length than most take no part; repeated rows count once. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    usable = _usable(rows, key, vector)
    by_id = Window.partitionBy("v").orderBy("id")
    few = usable.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1)
    points = materialize(few.groupBy("v").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids")), "ann-points")
    facts = points.agg(F.count("*").alias("n"), F.max(F.expr("sqrt(aggregate(v, 0D, (s, x) -> s + x * x))")).alias("largest")).first()
    if not facts.n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    share = min(1.0, SAMPLE / facts.n)
    sample = points.where(F.pmod(F.xxhash64(F.lit("forest"), "rep"), F.lit(1 << 30)) <= share * (1 << 30)).limit(2 * SAMPLE)
    sample = _matrix(sample.orderBy("rep").toPandas()["v"])
    forest = Forest(sample, facts.largest, max(1, min(-(-facts.n // LEAF_ROWS), len(sample) // SAMPLE_PER_LEAF)), trees)
    shared = spark.sparkContext.broadcast(forest.__dict__)  # at most 2 x SAMPLE / SAMPLE_PER_LEAF nodes a tree

    def load() -> Forest:
        own = object.__new__(Forest)
        own.__dict__ = shared.value
        return own

    def send_down(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = load()
        for frame in frames:
            if len(frame):
                for column in own.leaves_of(_matrix(frame["v"])).T:
                    yield pd.DataFrame({"leaf": column, "rep": frame["rep"], "v": frame["v"]})

    laid = materialize(points.select("rep", "v").mapInPandas(send_down, "leaf bigint, rep bigint, v array<double>"), "ann-leaves")
    sizes = np.zeros(forest.n_leaves, np.int64)
    for r in laid.groupBy("leaf").agg(F.count("*").alias("n")).collect():  # one row per leaf of the forest
        sizes[r.leaf] = r.n
    group_of = (np.cumsum(sizes) - sizes) // GROUP_ROWS
    budget = _budget(points.select("rep", "v"), forest, sizes, k)

    asked = usable.where(F.expr(queries.replace(key, "id"))).join(points.select("v", "rep"), "v")
    asked = materialize(asked.select("id", "rep", "v"), "ann-queries")
    once = asked.groupBy("rep").agg(F.first("v").alias("v"))

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = load()
        for frame in frames:
            margins = own.margins(_matrix(frame["v"])) if len(frame) else ()
            for at, query in enumerate(frame["rep"]):
                taken, held = [], 0
                for leaf in own.walk(margins[at]):
                    taken.append(leaf)
                    held += int(sizes[leaf])
                    if held >= budget:
                        break
                groups = group_of[taken]
                yield pd.DataFrame([(g, query, frame["v"].iloc[at], np.array(taken)[groups == g]) for g in np.unique(groups)],
                                   columns=["g", "query", "q", "leaves"])

    n_asked = once.count()
    parts = max(1, -(-n_asked // UNIT_QUERIES))
    spread = once.repartition(max(1, -(-n_asked // WALKS_PER_TASK)), "rep")
    visits = spread.mapInPandas(visit, "g bigint, query bigint, q array<double>, leaves array<bigint>")
    visits = visits.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    # a leaf above GROUP_ROWS is cut by hash, so no unit outgrows its bound
    cuts = np.maximum(1, -(-sizes // GROUP_ROWS))
    crowded = {int(i): int(n) for i, n in enumerate(cuts) if n > 1}
    n_cuts = F.coalesce(*[F.when(F.col("leaf") == i, F.lit(n)) for i, n in crowded.items()], F.lit(1))
    most = int(cuts.max())
    group_list = F.lit(group_of.tolist())
    laid = laid.select(F.element_at(group_list, (F.col("leaf") + 1).cast("int")).cast("bigint").alias("g"), "leaf", "rep", "v",
                       F.pmod(F.xxhash64("rep"), n_cuts).cast("int").alias("cut"),
                       F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    visits = visits.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))

    def compare(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query": [], "rep": [], "score": []})
        vectors, reps = _matrix(held["v"]), held["rep"].to_numpy()
        leaves, place = np.unique(held["leaf"].to_numpy(), return_inverse=True)
        out, take = [], min(len(reps), (k + 1) * trees)
        for at in range(0, len(asked), STRIP):
            strip = asked.iloc[at : at + STRIP]
            own = _matrix(strip["q"])
            open_leaf = np.stack([np.isin(leaves, x) for x in strip["leaves"]])
            scores = np.where(open_leaf[:, place], own @ vectors.T, -np.inf)
            top = np.argpartition(-scores, take - 1, axis=1)[:, :take]
            exact = (own[:, None, :] * vectors[top]).sum(axis=2)  # one order of summation for every pair
            seen = np.take_along_axis(scores, top, 1) > -np.inf
            found = pd.DataFrame({"query": np.repeat(strip["query"].to_numpy(), take), "rep": reps[top].ravel(), "score": exact.ravel()})
            out.append(_best(found[seen.ravel()], k + 1))
        return pd.concat(out)

    unit = ["g", "cut", "part"]
    near = visits.groupBy(*unit).cogroup(laid.groupBy(*unit)).applyInPandas(compare, "query bigint, rep bigint, score double")
    near = near.groupBy("query", "rep").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
    near = near.join(points.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
    answers = asked.select(F.col("id").alias("query_id"), F.col("rep").alias("query")).join(near, "query").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
