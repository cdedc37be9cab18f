"""Class weights and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.functions.columns import quoted
from stratascore.functions.hashing import hash_u32, uniform
from stratascore.operators.neighbors import knn_join
from stratascore.operators.profile import class_counts
from stratascore.operators.split import _after, hash_cuts


def add_class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Balanced weight ``n / (classes * n_class)``, from one count per class."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    weight = F.lit(None).cast("double")
    for cls, n in counts.items():
        weight = F.when(F.col(label) == cls, F.lit(total / (len(counts) * n))).otherwise(weight)
    return df.withColumn(out, weight)


def smote_counts(df: DataFrame, ratio: float, label: str = "label") -> tuple[int, int, int]:
    """Negatives, positives and how many positives to add."""
    counts = class_counts(df, label)
    n_neg, n_pos = counts.get(0, 0), counts.get(1, 0)
    return n_neg, n_pos, int(ratio * n_neg + 1e-9) - n_pos


def smote(df: DataFrame, features: Sequence[str], ratio: float, k: int = 1, key: str = "id",
          label: str = "label", seed: int = 42, **knn_options) -> DataFrame:
    """The table plus synthetic positives, until positives = floor(ratio * negatives).

    Each positive row makes the same number of draws, the first ones in hash order one more. A draw
    picks one of the k nearest positives and a point on the line to it, both by hash of
    (key, draw, seed). Column ``draw`` is 0 for real rows, so (key, draw) stays unique; the other
    columns of a synthetic row come from the row it was drawn from.
    """
    n_neg, n_pos, n_new = smote_counts(df, ratio, label)
    if n_new <= 0:
        raise ValueError(f"{n_pos} positives for {n_neg} negatives already meet the ratio {ratio}")
    if n_pos <= k:
        raise ValueError(f"{n_pos} positives are too few for {k} neighbours")
    minority = df.filter(F.col(label) == 1)
    # the neighbour's features come with it, so a row that is everyone's neighbour needs no join
    near = knn_join(minority, minority, k, features, key, exclude_self=True, with_vector=True, **knn_options)
    base, extra = divmod(n_new, n_pos)
    draws = F.lit(base)
    if extra:
        cut = hash_cuts(minority, {None: [extra]}, key, seed)[None, extra]
        draws = draws + (~_after(cut, key, seed)).cast("int")
    drawn = minority.withColumn("draw", F.explode(F.sequence(F.lit(1), F.greatest(draws, F.lit(1)))))
    if base == 0:
        drawn = drawn.filter(~_after(cut, key, seed))
    pick = (F.pmod(hash_u32(key, F.col("draw"), "pick", seed), F.lit(k)) + 1).cast("int")
    drawn = drawn.withColumn("place", pick).withColumn("u", uniform(key, F.col("draw"), "step", seed))
    moved = drawn.join(near.select(key, "place", "to"), [key, "place"])
    step = {
        f: (quoted(f) + F.col("u") * (F.col("to")[i] - quoted(f))).alias(f) for i, f in enumerate(features)
    }
    made = moved.select(*[step.get(c, quoted(c)) for c in df.columns], "draw")
    real = df.select(
        *[quoted(c).cast("double").alias(c) if c in step else quoted(c) for c in df.columns],
        F.lit(0).alias("draw"))
    return real.unionByName(made)


def resampling_check(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    """Rows per class before and after."""

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(label).agg(F.count(F.lit(1)).alias(name))

    return count(before, "n_before").join(count(after, "n_after"), label)
