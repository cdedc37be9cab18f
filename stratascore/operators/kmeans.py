"""KMeans with restarts, all of them in one scan a step.

A task holds the centres of every restart that still moves and returns, per restart and centre, a count,
a sum and a cost; the sums of all tasks meet in one aggregate. So 20 restarts take as many passes as the
longest of them. Seeding shares its passes in the same way: each pass draws candidates by distance from
those before (k-means||, Bahmani et al. 2012), and the driver picks the centres among the weighted
candidates, a few dozen per restart.

Equal rows are merged first, and all draws are hashes of the row, so no result depends on how the table
is cut. Sums are added as whole numbers (fixed point), so neither does their order matter. The merged rows
are kept as packed blocks, as each of the hundreds of passes reads them all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratascore.session import kept_between_passes

ADDERS = 4  # tasks that add the sums of a pass
BLOCK = 64  # entries of a sum in one row of the aggregate
ROWS = 4096  # rows of a packed block
COMPARED = 1 << 18  # distances that a task has at once
PART_BYTES = 1 << 26  # packed rows of a task, which reach Python in one batch
HALF = 31  # bits of the lower part of a sum
ROWS_PER_TASK = 512  # at least; a task of fewer rows would send more than it reads
DRAW_ROUNDS = 2
PER_ROUND = 2  # candidates a round, in multiples of k
MOST_SUMS = 1 << 22  # sums of one task
AT_DRIVER = 1 << 14  # sums of all tasks that the driver adds itself; a fit has hundreds of passes
ROWS_AT_DRIVER = 1 << 12  # rows that hold them


@dataclass
class KMeansFit:
    centers: np.ndarray
    sizes: list[int]
    inertia: float
    iterations: int
    converged: bool


@dataclass
class _Table:
    """Merged rows in blocks ``x, w, h`` of their bytes, with what all passes need to know of them."""

    rows: DataFrame
    n: int
    width: int
    largest: float
    variance: float
    tasks: int

    @property
    def scale(self) -> float:
        """Power of two by which entries become whole numbers whose sum over all rows fits 62 bits."""
        return 2.0 ** np.floor(min(52, 61 - np.log2(self.n)) - np.log2(self.largest or 1.0))

    @property
    def cost_scale(self) -> float:
        return 2.0 ** np.floor(61 - np.log2(self.n) - np.log2(4 * self.width * (self.largest or 1.0) ** 2))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``x, w, h`` as blocks of at most ``ROWS``, each column as its bytes."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            columns = batch.slice(start, ROWS).columns
            values = [columns[0].flatten().to_numpy(), *(c.to_numpy() for c in columns[1:])]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], ["x", "w", "h"])


def _blocks(batches: Iterator[pa.RecordBatch], width: int, centers: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of the blocks, small enough to be compared with so many centres; rows that are not packed yet are packed first."""
    step = min(ROWS, max(64, COMPARED // max(1, centers)))
    for batch in (b for given in batches for b in ([given] if pa.types.is_binary(given.schema.field(0).type) else _packed([given]))):
        for i in range(batch.num_rows):
            x, w, h = (np.frombuffer(c[i].as_buffer(), t) for c, t in zip(batch.columns, (np.float64, np.int64, np.uint64)))
            for start in range(0, len(w), step):
                part = slice(start, start + step)
                yield x.reshape(-1, width)[part], w[part], h[part]


def _nearest(x: np.ndarray, centers: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per set of centres: which one is nearest to each row (the first on a tie), as centres x rows, and the squared distance."""
    square = np.einsum("ij,ij->i", x, x)
    stacked = np.concatenate(centers)
    apart = np.einsum("ij,ij->i", stacked, stacked)[:, None] - 2 * (stacked @ x.T)
    at = 0
    for own in centers:
        part = apart[at : at + len(own)]
        least = part.min(axis=0)
        hit = part == least
        if np.count_nonzero(hit) > len(x):
            hit &= np.cumsum(hit, axis=0) == 1
        yield hit, np.maximum(least + square, 0.0)
        at += len(own)


def _uniform(hashes: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes and a salt (the finishing steps of splitmix64)."""
    with np.errstate(over="ignore"):
        z = hashes.copy()
        for s in salt:
            z += np.uint64(0x9E3779B97F4A7C15) * np.uint64(s + 1)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def _sums(table: _Table, centers: dict[int, np.ndarray], sums: bool = True) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Rows per centre, sum per centre and cost, per restart, over the whole table in one job."""
    order, width, scale, cost_scale = sorted(centers), table.width, table.scale, table.cost_scale
    asked = [centers[r] for r in order]
    sizes, block = [len(c) for c in asked], max(1, min(BLOCK, width))
    ends, blocks = np.cumsum(sizes), -(-width // block) if sums else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(ends[-1], np.int64), np.zeros((ends[-1], width if sums else 0), np.int64)
        costs, any_rows = [0] * len(asked), False
        for x, w, _ in _blocks(batches, width, ends[-1]):
            any_rows = True
            hit = np.empty((ends[-1], len(x)))
            for r, (own, far) in enumerate(_nearest(x, asked)):
                costs[r] += int(np.rint(far * cost_scale).astype(np.int64) @ w)
                hit[ends[r] - sizes[r] : ends[r]] = own
            n += (hit @ w.astype(float)).astype(np.int64)
            if sums:
                # two halves of each number, whose sums over a block are exact in double precision
                whole = np.rint(x * scale).astype(np.int64) * w[:, None]
                high, low = ((hit @ half.astype(float)).astype(np.int64) for half in (whole >> HALF, whole & ((1 << HALF) - 1)))
                total += (high << HALF) + low
        if any_rows:
            own = np.repeat(np.arange(len(asked)), sizes)
            first = np.concatenate([np.arange(size) for size in sizes])
            paid = np.where(first == 0, np.array(costs)[own], 0)
            wide = np.zeros((len(n), blocks * block), np.int64)
            if sums:
                wide[:, :width] = total
            parts = pa.ListArray.from_arrays(pa.array(np.arange(0, wide.size + 1, block, dtype=np.int32)), pa.array(wide.ravel()))
            at = np.arange(len(n) * blocks)
            head = at % blocks == 0
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.where(head, n[at // blocks], 0)), pa.array(np.where(head, paid[at // blocks], 0)), parts],
                                             ["at", "n", "cost", "part"])

    found = table.rows.mapInArrow(run, "at bigint, n bigint, cost bigint, part array<bigint>")
    sent = table.tasks * sum(sizes) * blocks
    if sent > ROWS_AT_DRIVER or sent * block > AT_DRIVER:  # else the sums of all tasks are few enough to be added here
        each = [F.sum(F.get("part", F.lit(i))).alias(f"s{i}") for i in range(block)]
        found = found.repartition(ADDERS, "at").groupBy("at").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *each)
        found = found.select("at", "n", "cost", F.array(*[f"s{i}" for i in range(block)]).alias("part"))
    met = found.toArrow().combine_chunks()
    at, rows = met["at"].to_numpy(), sum(sizes) * blocks
    n, cost, total = (np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros((rows, block), np.int64))
    np.add.at(n, at, met["n"].to_numpy())
    np.add.at(cost, at, met["cost"].to_numpy())
    np.add.at(total, at, met["part"].combine_chunks().flatten().to_numpy().reshape(-1, block))
    total = total.reshape(-1, blocks * block)[:, :width] / scale
    n, cost = n.reshape(-1, blocks)[:, 0], cost.reshape(-1, blocks)[:, 0]
    return {r: (n[e - size : e], total[e - size : e], float(cost[e - size]) / cost_scale) for r, e, size in zip(order, ends, sizes)}


def _drawn(table: _Table, candidates: dict[int, np.ndarray], round_: int, seed: int, wanted: int) -> dict[int, np.ndarray]:
    """Per restart ``wanted`` rows without replacement, by weight times squared distance from its candidates.

    The rows with the largest log(u) / weight are such a sample (Efraimidis and Spirakis 2006), so each
    task sends its own best ones and no total needs to be known first.
    """
    order, width = sorted(candidates), table.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros((0, width))) for _ in order]
        for x, w, h in _blocks(batches, width, sum(map(len, candidates.values()))):
            near = _nearest(x, [candidates[r] for r in order]) if round_ else ((None, np.ones(len(x))) for _ in order)
            for i, (_, far) in enumerate(near):
                weight = far * w
                with np.errstate(divide="ignore"):
                    score = np.where(weight > 0, np.log(_uniform(h, seed, order[i], round_)) / weight, -np.inf)
                scores, rows = np.concatenate([best[i][0], score]), np.concatenate([best[i][1], x])
                top = np.argsort(-scores, kind="stable")[:wanted]
                top = top[np.isfinite(scores[top])]
                best[i] = (scores[top], rows[top])
        rows = [(r, float(s), v.tolist()) for r, (scores, found) in zip(order, best) for s, v in zip(scores, found)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], ["r", "score", "x"])

    found = table.rows.mapInArrow(run, "r bigint, score double, x array<double>")
    place = F.row_number().over(Window.partitionBy("r").orderBy(F.desc("score"), "x"))
    drawn = found.withColumn("place", place).where(F.col("place") <= wanted).orderBy("r", "place").collect()
    return {r: np.array([row["x"] for row in drawn if row["r"] == r]).reshape(-1, width) for r in order}


def _local_centers(points: np.ndarray, weights: np.ndarray, k: int, draw: np.random.Generator, steps: int = 30) -> np.ndarray:
    """Weighted k-means++ and some Lloyd steps over the few candidates of a restart."""
    chosen = [int(draw.choice(len(points), p=weights / weights.sum()))]
    far = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and (far * weights).sum() > 0:
        chosen.append(int(draw.choice(len(points), p=far * weights / (far * weights).sum())))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    centers = points[chosen]
    for _ in range(steps):
        label = next(_nearest(points, [centers]))[0].argmax(axis=0)
        moved = np.array([np.average(points[label == c], axis=0, weights=weights[label == c]) if weights[label == c].sum() else centers[c]
                          for c in range(len(centers))])
        if np.array_equal(moved, centers):
            break
        centers = moved
    return centers


def _in_turns(asked: dict[int, np.ndarray], job: Callable[[dict[int, np.ndarray]], dict]) -> dict:
    """``job`` on as many restarts at once as one pass may hold sums for."""
    found, part = {}, {}
    for r, centers in asked.items():
        if part and sum(c.size for c in part.values()) + centers.size > MOST_SUMS:
            found |= job(part)
            part = {}
        part[r] = centers
    return found | job(part) if part else found


def fit_kmeans(df: DataFrame, vector: str, k: int, restarts: int = 20, max_iter: int = 500, tol: float = 1e-4,
               seed: int = 42) -> list[KMeansFit]:
    """All restarts, the best first. A vector column without nulls; fewer than k different rows give as many centres.

    A restart has converged when its centres together moved, squared, by no more than ``tol`` times the
    mean variance of a feature. A centre that loses its rows stays where it is.
    """
    merged = df.select(vector_to_array(F.col(vector)).alias("x")).groupBy("x").agg(F.count("*").alias("w"))
    with _table(merged.withColumn("h", F.xxhash64("x"))) as table:
        if table is None:
            raise ValueError("no rows to segment")
        start = {r: np.zeros((0, table.width)) for r in range(restarts)}
        candidates = _in_turns(start, lambda part: _drawn(table, part, 0, seed, 1))
        for round_ in range(1, DRAW_ROUNDS + 1):
            more = _in_turns(candidates, lambda part, t=round_: _drawn(table, part, t, seed, PER_ROUND * k))
            candidates = {r: np.concatenate([c, more[r]]) for r, c in candidates.items()}
        weights = _in_turns(candidates, lambda part: _sums(table, part, sums=False))
        centers = {r: _local_centers(c, weights[r][0].astype(float), k, np.random.default_rng([seed, r])) for r, c in candidates.items()}
        taken = dict.fromkeys(centers, 0)
        moving = dict(centers)
        for step in range(1, max_iter + 1):
            for r, (n, total, _) in _in_turns(moving, lambda part: _sums(table, part)).items():
                moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers[r])
                if ((moved - centers[r]) ** 2).sum() <= tol * table.variance:
                    del moving[r]
                else:
                    moving[r] = moved
                centers[r], taken[r] = moved, step
            if not moving:
                break
        ends = _in_turns(centers, lambda part: _sums(table, part, sums=False))
    fits = [KMeansFit(centers[r], ends[r][0].tolist(), float(ends[r][2]), taken[r], r not in moving) for r in sorted(centers)]
    return sorted(fits, key=lambda f: f.inertia)


@contextmanager
def _table(merged: DataFrame) -> Iterator[_Table | None]:
    """The packed rows with their count, width, largest entry and mean variance; None for an empty table."""
    packed = None
    try:
        with kept_between_passes(merged) as rows:
            one = rows.agg(F.sum("w").alias("n"), F.count("*").alias("held"), F.max(F.size("x")).alias("width"), F.max(F.array_max(F.transform("x", F.abs))).alias("largest")).first()
            if one["n"]:
                cores = rows.sparkSession.sparkContext.defaultParallelism
                tasks = max(1, min(cores, one["held"] // ROWS_PER_TASK), -(-one["held"] * (one["width"] + 2) * 8 // PART_BYTES))
                spread = rows.coalesce(tasks) if tasks <= rows.rdd.getNumPartitions() else rows.repartition(tasks)
                packed = spread.mapInArrow(_packed, "x binary, w binary, h binary").persist(StorageLevel.MEMORY_AND_DISK)
                packed.count()
        if packed is None:
            yield None
            return
        table = _Table(packed, one["n"], one["width"], one["largest"], 0.0, tasks)
        mean = _sums(table, {0: np.zeros((1, table.width))})[0]
        centre = mean[1] / table.n
        table.variance = _sums(table, {0: centre}, sums=False)[0][2] / table.width / max(table.n - 1, 1)
        yield table
    finally:
        if packed is not None:
            packed.unpersist()
