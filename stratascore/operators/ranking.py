"""Exact order statistics and ranks that never put one feature's values into one task.

Quantiles narrow a bracket around the wanted ranks with mergeable sketches until few distinct
values are left, so the data is scanned a few times and hardly shuffled. Rank sums range-partition
the distinct values and combine per-partition sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratascore.functions.columns import name_at, to_long

SKETCH_ACCURACY = 10_000
SMALL_GROUP = 1_000_000


def _sketches(long: DataFrame, intervals: list[tuple[int, float, float]]) -> dict[tuple, list[float]]:
    """A thousand cuts of the values of each feature inside each interval."""
    plan = long.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(intervals)], "at int, pos int, lo double, hi double")
    cuts = F.percentile_approx("value", [i / 1000 for i in range(1001)], SKETCH_ACCURACY)
    inside = long.join(F.broadcast(plan), "pos").filter((F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    return {intervals[row["at"]]: row["cuts"] for row in inside.groupBy("at").agg(cuts.alias("cuts")).collect()}


def _counts_at(long: DataFrame, edges: dict[int, list[float]]) -> dict[int, list[tuple[int, int]]]:
    """Rows below each edge and up to it, per feature. A row is counted once, under the edges around it."""
    plan = long.sparkSession.createDataFrame([(p, e) for p, e in edges.items()], "pos int, edges array<double>")
    v = F.col("value")
    under, upto = (F.size(F.filter("edges", test)) for test in (lambda e: e < v, lambda e: e <= v))
    rows = long.join(F.broadcast(plan), "pos").groupBy("pos", under.alias("under"), upto.alias("upto")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    out = {p: [[0, 0] for _ in e] for p, e in edges.items()}
    for row in rows:
        for i, both in enumerate(out[row["pos"]]):
            both[0] += row["n"] if row["upto"] <= i else 0
            both[1] += row["n"] if row["under"] <= i else 0
    return {p: [(low, high) for low, high in found] for p, found in out.items()}


def _order_statistics(long: DataFrame, wanted: dict[int, list[int]], sizes: dict[int, int],
                      small: int) -> dict[tuple[int, int], float]:
    """The value at each 0-based rank: ``{(pos, rank): value}``.

    A bracket is cut down by a sketch of what it holds and then split at the sketch's best guess, which
    leaves the bracket. So a value that fills most of it is either the answer or gone.
    """
    spark = long.sparkSession
    v, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    # (pos, rank) -> bracket that holds the rank: low, high, rows below it, rows inside it
    brackets = {(p, r): (-math.inf, math.inf, 0, sizes[p]) for p, ranks in wanted.items() for r in ranks}
    margin, found = dict.fromkeys(brackets, 1), {}
    while wide := {k: b for k, b in brackets.items() if k not in found and b[3] > small}:
        sketches = _sketches(long, sorted({(p, b[0], b[1]) for (p, _), b in wide.items()}))
        tried = {}
        for key, b in wide.items():
            cuts = sketches[key[0], b[0], b[1]]
            at = (key[1] - b[2]) / max(b[3] - 1, 1) * 1000
            left, right = max(math.floor(at) - margin[key], 0), min(math.ceil(at) + margin[key], 1000)
            tried[key] = (b[0] if left == 0 else cuts[left], cuts[round(at)], b[1] if right == 1000 else cuts[right])
        edges: dict[int, list[float]] = {}
        for key, cut in tried.items():
            edges[key[0]] = sorted({*edges.get(key[0], []), *cut})
        counts = _counts_at(long, edges)
        for key, (low, mid, high) in tried.items():
            (below, _), (under, through), (_, upto) = (counts[key[0]][edges[key[0]].index(e)] for e in (low, mid, high))
            if not below <= key[1] < upto:
                margin[key] *= 10  # outside the sketch's error bound: try again with a wider cut
            elif under <= key[1] < through:
                found[key] = mid
            elif key[1] < under:
                brackets[key] = (low, math.nextafter(mid, -math.inf), below, under - below)
            else:
                brackets[key] = (math.nextafter(mid, math.inf), high, through, upto - through)

    # few rows are left in each bracket: count the distinct values, run along them
    rest = {k: b for k, b in brackets.items() if k not in found}
    if rest:
        plan = spark.createDataFrame([(p, r, b[0], b[1], r - b[2]) for (p, r), b in rest.items()],
                                     "pos int, rank bigint, lo double, hi double, target bigint")
        inside = long.join(F.broadcast(plan), "pos").filter((v >= lo) & (v <= hi))
        counted = inside.groupBy("pos", "rank", "target", "value").agg(F.count(F.lit(1)).alias("n"))
        ends = counted.withColumn("end", F.sum("n").over(Window.partitionBy("pos", "rank").orderBy("value")))
        hits = ends.filter((F.col("end") > F.col("target")) & (F.col("end") - F.col("n") <= F.col("target")))
        found.update({(row["pos"], row["rank"]): row["value"] for row in hits.collect()})
    return found


def exact_quantiles(df: DataFrame, features: Sequence[str], probs: Sequence[float],
                    small: int = SMALL_GROUP, sizes: dict[str, int] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per feature, columns ``q25`` and so on.

    ``sizes`` are the known rows per feature, if the caller has counted them already.
    """
    spark = df.sparkSession
    long = to_long(df, features).filter(F.col("value").isNotNull())
    if sizes is None:
        counted = long.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).collect()
        at_pos = {r["pos"]: r["n"] for r in counted}
    else:
        at_pos = {i: sizes[f] for i, f in enumerate(features) if sizes[f]}
    spots = {(p, q): (n - 1) * q for p, n in at_pos.items() for q in probs}
    wanted = {
        p: sorted({f(spots[p, q]) for q in probs for f in (math.floor, math.ceil)}) for p in at_pos
    }
    at = _order_statistics(long, wanted, at_pos, small)

    def value(p: int, q: float) -> float | None:
        if p not in at_pos:
            return None
        spot = spots[p, q]
        lo, hi = at[p, math.floor(spot)], at[p, math.ceil(spot)]
        return lo + (hi - lo) * (spot - math.floor(spot))

    names = [f"q{round(q * 100)}" for q in probs]
    rows = [(f, *[value(i, q) for q in probs]) for i, f in enumerate(features)]
    schema = "feature string, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, schema)


def normal_two_sided(z: Column) -> Column:
    """Two-sided normal p-value. One row per feature goes through it, so Arrow cost is nil."""

    @F.pandas_udf(T.DoubleType())
    def tail(s: pd.Series) -> pd.Series:
        return s.map(lambda x: min(1.0, math.erfc(abs(x) / math.sqrt(2))) if x == x else 1.0)

    return tail(z)


def exact_two_sided(u: float, n0: int, n1: int) -> float:
    """Two-sided p of U without ties, by counting: how many orders of the rows give each U."""
    few, many = sorted((n0, n1))
    ways = np.zeros(n0 * n1 + 1)
    ways[0] = 1.0
    for i in range(1, few + 1):  # the product of (1 - x^(many + i)) / (1 - x^i), term by term
        top = ways.copy()
        top[many + i:] -= ways[: len(ways) - many - i]
        for at in range(i, len(top)):
            top[at] += top[at - i]
        ways = top
    far = max(u, n0 * n1 - u)
    return float(min(1.0, 2 * ways[math.ceil(far - 1e-9):].sum() / ways.sum()))


def mann_whitney_exact(df: DataFrame, features: Sequence[str], label: str = "label", small: int = 8) -> DataFrame:
    """As ``mann_whitney``, with the exact p where a class has at most ``small`` rows and no value repeats."""
    out = mann_whitney(df, features, label)
    long = to_long(df, features, [label]).filter(F.col("value").isNotNull())
    facts = long.groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 0).alias("n0")).groupBy("pos").agg(
        F.max("n").alias("most"), F.sum("n0").cast("bigint").alias("n0"), (F.sum("n") - F.sum("n0")).cast("bigint").alias("n1"))
    facts = facts.select(name_at(features, F.col("pos")).alias("feature"), "most", "n0", "n1")

    @F.pandas_udf(T.DoubleType())
    def exact(u: pd.Series, n0: pd.Series, n1: pd.Series) -> pd.Series:
        return pd.Series([exact_two_sided(*x) for x in zip(u, n0, n1)], dtype=float)

    fits = (F.col("most") == 1) & (F.least("n0", "n1") <= small) & (F.least("n0", "n1") > 0)
    both = out.join(facts, "feature")
    asked = both.withColumn("exact_p", F.when(fits, exact("u", F.when(fits, F.col("n0")).otherwise(0), F.when(fits, F.col("n1")).otherwise(0))))
    p = F.coalesce("exact_p", "p_value")
    return asked.select("feature", "u", "z", fits.alias("exact"), p.alias("p_value"), (-F.log10(F.greatest(p, F.lit(1e-300)))).alias("neg_log10_p"))


def mann_whitney(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """U of the negative class, tie- and continuity-corrected z, two-sided p per feature.

    Rows are first merged to (feature, value): a value that holds a third of the table is one row
    from then on. The merged values are range partitioned; inside a range a running count gives the
    ranks, and one row per range carries what the next ranges need.
    """
    counts = (
        to_long(df, features, [label])
        .filter(F.col("value").isNotNull())
        .groupBy("pos", "value")
        .agg(
            F.count_if(F.col(label) == 0).cast("double").alias("c0"),
            F.count(F.lit(1)).cast("double").alias("c"),
        )
    )
    ranged = counts.repartitionByRange(F.col("pos"), F.col("value")).withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("pos", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    local_rank = F.sum("c").over(inside) - F.col("c") + (F.col("c") + 1) / 2
    parts = (
        ranged.withColumn("rank", local_rank)
        .groupBy("pos", "part")
        .agg(
            F.min("value").alias("first"),
            F.sum("c").alias("n"),
            F.sum("c0").alias("n0"),
            F.sum(F.col("c0") * F.col("rank")).alias("rank_sum"),
            F.sum(F.pow("c", F.lit(3)) - F.col("c")).alias("ties"),
        )
    )
    # one row per (feature, range) from here on
    before = Window.partitionBy("pos").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0.0))
    total = parts.withColumn("rank_sum", F.col("rank_sum") + F.col("n0") * offset).groupBy("pos").agg(
        *[F.sum(c).alias(c) for c in ("n", "n0", "rank_sum", "ties")]
    )
    n, n0 = F.col("n"), F.col("n0")
    n1 = n - n0
    u = F.col("rank_sum") - n0 * (n0 + 1) / 2
    sd = F.sqrt(n0 * n1 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    u_far = F.greatest(F.col("u"), n0 * n1 - F.col("u"))
    z = F.when(sd > 0, F.greatest((u_far - n0 * n1 / 2 - 0.5) / sd, F.lit(0.0)))
    out = total.withColumn("u", u).withColumn("z", z)
    p = F.when(F.col("z").isNull(), F.lit(1.0)).otherwise(normal_two_sided(F.coalesce("z", F.lit(0.0))))
    out = out.withColumn("p_value", p)
    return out.select(
        name_at(features, F.col("pos")).alias("feature"), "u", "z", "p_value",
        (-F.log10(F.greatest("p_value", F.lit(1e-300)))).alias("neg_log10_p"),
    )
