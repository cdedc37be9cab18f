"""Exact k nearest neighbours by Euclidean distance, ties by key.

Two ways, same result:

* few points (row count and width are checked): they are broadcast as one array and every task
  ranks its own query rows against it, without a shuffle;
* many points: both sides are cut into cells around pivot points. A query visits only the cells that
  can hold one of its k nearest rows, by the triangle inequality. Near cells share a block, large ones
  are split into several, and query groups are salted, so no group outgrows a task, whatever share of
  the rows a cell holds. A query is first searched in the block of its own cell; the nearest rows there
  bound what the others can give, and it travels once a block that is still worth a visit. In many
  dimensions that is nearly every block: the work is then that of all pairs, as matrix products.
  Copies are merged first: of equal points only the lowest keys can be among the nearest, and equal
  queries have the same answer, so a row that fills a third of the table is searched once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.functions.columns import quoted
from stratascore.operators.split import sample_n
from stratascore.session import materialize, release

BROADCAST_BYTES = 8 << 20
TILE_CELLS = 2_000_000
CHUNK_ROWS = 20_000
MOST_BLOCKS = 64  # blocks hold more than ``chunk_rows`` points rather than be more than this, up to ``CHUNK_ROWS``
MOST_GROUP_PARTS = 500
SLACK = 1 + 1e-9  # keeps a cell whose bound equals the k-th distance up to rounding
ROUNDING = 8 * np.finfo(float).eps


def _as_vectors(df: DataFrame, features: Sequence[str], key: str, value: str | None) -> DataFrame:
    vec = F.array(*[quoted(f).cast("double") for f in features]).alias("vec")
    carried = F.lit(None).cast("double") if value is None else quoted(value).cast("double")
    return df.select(quoted(key).alias("key"), vec, carried.alias("value"))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances, summed feature by feature so that equal rows give equal sums."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        out += (a[:, j, None] - b[None, :, j]) ** 2
    return out


def _nearest(qkeys, queries, pkeys, points, k: int, exclude_self: bool):
    """Row and point positions of the k nearest points of each query; points come sorted by key."""
    tile = max(1, TILE_CELLS // max(len(points), 1))
    rows, cols, dist = [], [], []
    for start in range(0, len(queries), tile):
        d = _squared(queries[start : start + tile], points)
        if exclude_self:
            d[qkeys[start : start + tile, None] == pkeys[None, :]] = np.inf
        if d.shape[1] > k:
            limit = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
            i, j = np.nonzero((d <= limit) & np.isfinite(d))
        else:
            i, j = np.nonzero(np.isfinite(d))
        v = d[i, j]
        order = np.lexsort((j, v, i))
        i, j, v = i[order], j[order], v[order]
        first = np.searchsorted(i, i, side="left")
        keep = np.arange(len(i)) - first < k
        rows.append(i[keep] + start)
        cols.append(j[keep])
        dist.append(v[keep])
    if not rows:
        empty = np.array([], dtype=int)
        return empty, empty, np.array([])
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


def _stack(vectors) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=float) if len(vectors) else np.zeros((0, 1))


def _places(rows: np.ndarray) -> np.ndarray:
    """1, 2, ... within each run of equal row numbers."""
    return np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1


def _broadcast_join(queries: DataFrame, points: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    local = points.toPandas().sort_values("key", kind="stable")  # size checked by the caller
    shared = queries.sparkSession.sparkContext.broadcast(
        (local["key"].to_numpy(), _stack(local["vec"]), local["value"].to_numpy(dtype=float)))
    kind, own = (t.schema["key"].dataType.simpleString() for t in (points, queries))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, matrix, values = shared.value
        for q in batches:
            rows, cols, d2 = _nearest(q["key"].to_numpy(), _stack(q["vec"]), keys, matrix, k, exclude_self)
            yield pd.DataFrame({
                "key": q["key"].to_numpy()[rows], "place": _places(rows).astype("int32"), "neighbor": keys[cols],
                "d2": d2, "value": values[cols], "to": list(matrix[cols]),
            })

    schema = f"key {own}, place int, neighbor {kind}, d2 double, value double, to array<double>"
    return queries.select("key", "vec").mapInPandas(search, schema)


def _cell_order(pivots: np.ndarray) -> np.ndarray:
    """Numbers of the cells so that near ones follow each other: halves along the widest dimension, again and again."""
    done, todo = [], [np.arange(len(pivots))]
    while todo:
        own = todo.pop()
        if len(own) < 2:
            done.append(own)
            continue
        wide = np.ptp(pivots[own], axis=0).argmax()
        own = own[np.argsort(pivots[own, wide], kind="stable")]
        todo += [own[len(own) // 2 :], own[: len(own) // 2]]
    return np.concatenate(done)


def _packed(sizes: np.ndarray, order: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell: a large cell has several, small ones share one of up to ``rows`` points."""
    first, count = np.zeros(len(sizes), int), np.ones(len(sizes), int)
    block, held = 0, 0
    for c in order:
        if held and held + sizes[c] > rows:
            block, held = block + 1, 0
        first[c], count[c] = block, max(1, math.ceil(sizes[c] / rows))
        held += sizes[c]
        if count[c] > 1:
            block, held = block + count[c], 0
    return first, count


def _bounds(far: np.ndarray, home: np.ndarray, near: np.ndarray, pivots: np.ndarray, cells: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """No point of a cell is closer to a query than this: ``far`` holds the distances of the queries from the pivots of ``cells``,
    ``near`` those from their own one, ``home``.

    Every row of a cell is within its radius, and on its side of the plane between its pivot and the query's own one.
    """
    used, at = np.unique(home, return_inverse=True)
    apart = np.sqrt(_squared(pivots[used], pivots[cells]))[at]
    squares = far**2, near[:, None] ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (squares[0] - squares[1]) / (2 * apart) - ROUNDING * pivots.shape[1] * (squares[0] + squares[1]) / apart
    return np.maximum(far - radius[cells][None, :], np.where(apart > 0, plane, 0.0))


def _pair_squares(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, summed in the order of ``_squared``; rows come transposed."""
    out = np.zeros(len(i))
    for x, y in zip(a, b):
        out += (x[i] - y[j]) ** 2
    return out


class _Best:
    """The nearest points of each query so far: flat rows (query, point, squared distance), and what a better one must not exceed."""

    def __init__(self, bounds: np.ndarray, reach: int):
        self.bounds, self.reach = bounds, reach
        self.rows = np.zeros(0, int), np.zeros(0, int), np.zeros(0)

    def add(self, i: np.ndarray, j: np.ndarray, d2: np.ndarray) -> None:
        """Points come sorted by key, so a lower number wins a tie."""
        mine = np.zeros(len(self.bounds), bool)
        mine[i] = True
        touched = mine[self.rows[0]]
        own = [np.concatenate([x[touched], y]) for x, y in zip(self.rows, (i, j, d2))]
        order = np.lexsort((own[1], own[2], own[0]))
        own = [x[order] for x in own]
        place = _places(own[0])
        last = place == self.reach
        self.bounds[own[0][last]] = np.minimum(self.bounds[own[0][last]], own[2][last])
        self.rows = tuple(np.concatenate([x[~touched], y[place <= self.reach]]) for x, y in zip(self.rows, own))


def _search_cell(best: _Best, queries: np.ndarray, asked: np.ndarray, points: np.ndarray, mine: np.ndarray, pivot: np.ndarray) -> None:
    """Hold the queries ``asked`` against the points ``mine``: one matrix product a tile, then the pairs within the bounds exactly."""
    y = points[:, mine].T - pivot
    square = np.einsum("ij,ij->i", y, y)
    for start in range(0, len(asked), max(1, TILE_CELLS // len(mine))):
        part = asked[start : start + max(1, TILE_CELLS // len(mine))]
        x = queries[:, part].T - pivot
        own = np.einsum("ij,ij->i", x, x)
        # |x - y|^2 less what rounding can add; the pair itself is measured exactly below
        room = best.bounds[part] * SLACK + ROUNDING * (len(pivot) + 4) * (np.sqrt(own) + math.sqrt(square.max())) ** 2
        i, j = np.nonzero(square[None, :] - 2 * (x @ y.T) <= (room - own)[:, None])
        for at in range(0, len(i), TILE_CELLS):
            q, p = part[i[at : at + TILE_CELLS]], mine[j[at : at + TILE_CELLS]]
            d2 = _pair_squares(queries, q, points, p)
            fits = d2 <= best.bounds[q]
            best.add(q[fits], p[fits], d2[fits])


def _search_block(vectors: np.ndarray, home: np.ndarray, near: np.ndarray, bounds: np.ndarray, points: np.ndarray, cell: np.ndarray,
                  pivots: np.ndarray, radius: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, point and squared distance of the nearest points of a block that do not exceed the bounds.

    A query is held against its own cell first, then against those that can hold a nearer point.
    """
    best = _Best(bounds.copy(), reach)
    across, up = np.ascontiguousarray(vectors.T), np.ascontiguousarray(points.T)
    by = np.argsort(cell, kind="stable")
    cells, first = np.unique(cell[by], return_index=True)
    members = np.split(by, first[1:])
    for c, mine in zip(cells, members):
        own = np.flatnonzero(home == c)
        if len(own):
            _search_cell(best, across, own, up, mine, pivots[c])
    lower = _bounds(np.sqrt(_squared(vectors, pivots[cells])), home, near, pivots, cells, radius)
    for at, (c, mine) in enumerate(zip(cells, members)):
        other = np.flatnonzero((lower[:, at] <= np.sqrt(best.bounds) * SLACK + 1e-12) & (home != c))
        if len(other):
            _search_cell(best, across, other, up, mine, pivots[c])
    return best.rows


def _cell_join(queries: DataFrame, points: DataFrame, n_points: int, k: int, exclude_self: bool,
               chunk_rows: int) -> DataFrame:
    spark = queries.sparkSession
    kind = points.schema["key"].dataType.simpleString()
    reach = k + 1 if exclude_self else k  # one more, since a row may find itself

    # of equal points the lowest keys win; row_number with a limit is cut before the shuffle
    copies = Window.partitionBy("vec").orderBy("key")
    points = points.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= reach).drop("copy")
    points = materialize(points, "knn-distinct")

    # with the square root of the rows, choosing a cell and searching it cost about the same
    n_pivots = int(max(16, reach + 1, math.ceil(math.sqrt(n_points))))
    chosen = sample_n(points, n_pivots, key="key", seed=7).toPandas().sort_values("key", kind="stable")
    shared = spark.sparkContext.broadcast(_stack(chosen["vec"]))

    def to_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = shared.value
        for b in _cut(batches, len(pivots)):
            d = _squared(_stack(b["vec"]), pivots)
            b["cell"] = d.argmin(axis=1).astype("int32")
            b["radius"] = np.sqrt(d.min(axis=1))
            yield b

    celled = materialize(
        points.mapInPandas(to_cell, f"key {kind}, vec array<double>, value double, cell int, radius double"),
        "knn-points")
    release(points)
    radius, sizes = np.full(len(chosen), -1.0), np.zeros(len(chosen), int)  # -1: nobody lives there
    for c in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("radius").alias("r")).collect():
        radius[c["cell"]], sizes[c["cell"]] = c["r"], c["n"]
    # a block holds what one group may; of many points it holds more, so that a query meets no more than ``MOST_BLOCKS``
    block_rows = max(chunk_rows, min(CHUNK_ROWS, math.ceil(n_points / MOST_BLOCKS)))
    first, chunks = _packed(sizes, _cell_order(shared.value), block_rows)
    n_blocks = int((first + chunks).max())
    salt_rows = chunk_rows if n_points <= MOST_BLOCKS * chunk_rows else max(chunk_rows, CHUNK_ROWS)
    blocks_of = spark.sparkContext.broadcast((radius, first, chunks))

    def to_home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, (_, first, chunks) = shared.value, blocks_of.value
        for b in _cut(batches, len(pivots)):
            d = _squared(_stack(b["vec"]), pivots)
            home, q = d.argmin(axis=1), b["q"].to_numpy()
            # pivots are points, so the k-th nearest pivot bounds the k-th neighbour from above
            upper = np.partition(d, reach - 1, axis=1)[:, reach - 1] if d.shape[1] >= reach else np.full(len(b), np.inf)
            yield pd.DataFrame({"q": q, "vec": b["vec"], "home": home.astype("int32"), "near": np.sqrt(d.min(axis=1)), "upper": upper,
                                "block": (first[home] + q % chunks[home]).astype("int32")})

    asked = queries.select("vec").dropDuplicates(["vec"]).withColumn("q", F.monotonically_increasing_id())
    asked = materialize(materialize(asked, "knn-asked").mapInPandas(
        to_home, "q bigint, vec array<double>, home int, near double, upper double, block int"), "knn-queries")

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, (radius, first, chunks) = shared.value, blocks_of.value
        lived = np.flatnonzero(radius >= 0)
        for b in _cut(batches, len(pivots)):
            vectors = _stack(b["vec"])
            lower = _bounds(np.sqrt(_squared(vectors, pivots[lived])), b["home"].to_numpy(), b["near"].to_numpy(), pivots, lived, radius)
            i, c = np.nonzero(lower <= np.sqrt(b["upper"].to_numpy())[:, None] * SLACK + 1e-12)
            met = np.zeros((len(b), n_blocks), bool)
            for more in range(chunks.max()):
                has = chunks[lived[c]] > more
                met[i[has], first[lived[c[has]]] + more] = True
            met[np.arange(len(b)), b["block"].to_numpy()] = False  # the first search was there
            b["blocks"] = [np.flatnonzero(m).astype("int32") for m in met]
            yield b[["q", "vec", "home", "near", "upper", "blocks"]]

    def search(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("q", "neighbor", "d2", "value", "to")})
        p = p.sort_values("key", kind="stable")
        matrix = _stack(p["vec"])
        rows, cols, d2 = _search_block(_stack(q["vec"]), q["home"].to_numpy(), q["near"].to_numpy(), q["upper"].to_numpy(), matrix,
                                       p["cell"].to_numpy(), shared.value, blocks_of.value[0], reach)
        return pd.DataFrame({"q": q["q"].to_numpy()[rows], "neighbor": p["key"].to_numpy()[cols], "d2": d2,
                             "value": p["value"].to_numpy(dtype=float)[cols], "to": pd.Series(list(matrix[cols]), dtype=object)})

    def searched(left: DataFrame) -> DataFrame:
        """The nearest of each query in each block it goes to; queries of one block are salted."""
        load = {r["block"]: r["n"] for r in left.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
        salts = [max(1, math.ceil(load.get(c, 0) / salt_rows)) for c in range(n_blocks)]
        n_salts = F.array(*[F.lit(int(s)) for s in salts])[F.col("block")]
        left = left.withColumn("salt", F.pmod(F.xxhash64("q", F.lit(1)), n_salts).cast("int"))
        begin, many = (F.array(*[F.lit(int(x)) for x in own])[F.col("cell")] for own in (first, chunks))
        right = celled.withColumn("block", begin + F.pmod(F.xxhash64("key", F.lit(2)), many).cast("int")).withColumn(
            "salt", F.explode(F.sequence(F.lit(0), n_salts - 1)))
        group, parts = ["block", "salt"], max(1, min(MOST_GROUP_PARTS, sum(salts)))
        schema = f"q bigint, neighbor {kind}, d2 double, value double, to array<double>"
        left, right = (t.repartition(parts, *group).groupBy(*group) for t in (left, right))
        return left.cogroup(right).applyInPandas(search, schema)

    begun = materialize(searched(asked), "knn-home")
    bounds = begun.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("d2")).filter(F.col("n") == reach)
    tighter = asked.join(bounds.select("q", "d2"), "q", "left").withColumn("upper", F.least("upper", "d2")).drop("d2")
    going_on = materialize(tighter.mapInPandas(
        visits, "q bigint, vec array<double>, home int, near double, upper double, blocks array<int>"), "knn-visits")
    near = begun.unionByName(searched(going_on.withColumn("block", F.explode("blocks")).drop("blocks")))
    # at most (blocks visited x reach) rows per query vector, cut to the nearest before they are listed
    best = Window.partitionBy("q").orderBy("d2", "neighbor")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= reach)
    found = F.array_sort(F.collect_list(F.struct("rank", "neighbor", "d2", "value", "to")))
    answers = ranked.groupBy("q").agg(found.alias("found")).join(asked.select("q", "vec"), "q").drop("q")
    own = queries.select("key", "vec").join(answers, "vec")
    others = F.filter("found", lambda f: f["neighbor"] != F.col("key")) if exclude_self else F.col("found")
    listed = own.select("key", F.posexplode(F.slice(others, 1, k)).alias("at", "f"))
    return listed.select("key", (F.col("at") + 1).alias("place"), "f.neighbor", "f.d2", "f.value", "f.to")


def _cut(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Non-empty pieces of so many rows that a table of them by ``width`` numbers stays within a tile."""
    rows = max(1, TILE_CELLS // max(width, 1))
    for b in batches:
        for start in range(0, len(b), rows):
            yield b.iloc[start : start + rows].reset_index(drop=True)


def knn_join(queries: DataFrame, points: DataFrame, k: int, features: Sequence[str], key: str = "id",
             value: str | None = None, exclude_self: bool = False, with_vector: bool = False,
             broadcast_bytes: int = BROADCAST_BYTES, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(key, neighbor, place, distance, value)``: for each query row its k nearest points.

    ``value`` names a numeric column of the points to bring along; ``with_vector`` adds the features
    of the neighbour as an array ``to``. A query gets fewer than k rows only if there are fewer than
    k points.
    """
    q = _as_vectors(queries, features, key, None)
    p = _as_vectors(points, features, key, value)
    near = _near(q, p, k, len(features), exclude_self, broadcast_bytes, chunk_rows)
    return near.select(
        F.col("key").alias(key), "neighbor", "place", F.sqrt("d2").alias("distance"), "value",
        *(["to"] if with_vector else []))


def _near(q: DataFrame, p: DataFrame, k: int, width: int, exclude_self: bool, broadcast_bytes: int, chunk_rows: int) -> DataFrame:
    n_points = p.count()
    # beyond ``CHUNK_ROWS`` points it costs less to visit cells than to rank them all for every query
    if n_points <= CHUNK_ROWS and n_points * (width + 2) * 8 <= broadcast_bytes:
        return _broadcast_join(q, p, k, exclude_self)
    return _cell_join(q, p, n_points, k, exclude_self, chunk_rows)


def vote_by_vector(vectors: DataFrame, points: DataFrame, k: int, width: int, broadcast_bytes: int | None = None,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``(vec, probability)`` per distinct vector of a one-column table; ``points`` has ``key, vec, value``."""
    asked = vectors.toDF("vec").dropDuplicates(["vec"]).where("vec IS NOT NULL").select(F.col("vec").alias("key"), "vec")
    near = _near(asked, points, k, width, False, BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes, chunk_rows)
    return near.groupBy(F.col("key").alias("vec")).agg(F.avg("value").alias("probability"))


def knn_vote(queries: DataFrame, points: DataFrame, k: int, features: Sequence[str], key: str = "id",
             label: str = "label", **options) -> DataFrame:
    """``(key, probability)``: the share of positives among the k nearest training rows."""
    near = knn_join(queries, points, k, features, key, value=label, **options)
    return near.groupBy(key).agg(F.avg("value").alias("probability"))
