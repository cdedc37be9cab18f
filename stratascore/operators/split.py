"""Folds, hold-outs and samples by hash order.

The order of the rows is (hash of key and seed, key). A fold or a sample is a stretch of that order,
so it is fixed by a few cut points per class. Finding them takes counts only; applying them is a
column expression. No wide row is shuffled or sorted, and any engine repeats the same split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.functions.hashing import hash_u32

SMALL_BUCKET = 1_000_000
MAX_CLASSES = 1000


def _class_sizes(df: DataFrame, by: str | None) -> dict:
    if by is None:
        return {None: df.count()}
    rows = df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{by} has more than {MAX_CLASSES} values; it is not a class label")
    return {r[by]: r["n"] for r in rows}


def _in_class(by: str | None, cls) -> Column:
    if by is None:
        return F.lit(True)
    return F.col(by).isNull() if cls is None else F.col(by) == F.lit(cls)


def hash_cuts(df: DataFrame, wanted: dict, key: str = "id", seed: int = 42, by: str | None = None,
              small: int = SMALL_BUCKET) -> dict:
    """The (hash, key) pair at given 1-based ranks of the hash order: ``{(class, rank): (h, key)}``.

    First the rows per 16-bit hash prefix are counted and the prefix that holds each rank is found;
    then only rows with that prefix (1 in 65,536) are ranked. A prefix with more than ``small``
    rows is narrowed once more by the full hash, which again has at most 65,536 values.
    """
    spark = df.sparkSession
    cls = F.lit(None).cast("string") if by is None else F.col(by)
    hashed = df.select(cls.alias("cls"), F.col(key).alias("k"), hash_u32(key, seed).alias("h"))
    hashed = hashed.withColumn("part", F.shiftright("h", 16))
    cls_type = hashed.schema["cls"].dataType.simpleString()
    targets = [(c, int(r)) for c, ranks in wanted.items() for r in ranks]
    if not targets:
        return {}

    def holding(counts: DataFrame, group: Sequence[str], step: str, ranks: list[tuple]) -> list:
        """Which ``step`` of each group holds the rank, rows before it, rows in it."""
        run = Window.partitionBy(*group).orderBy(step)
        ends = counts.withColumn("end", F.sum("n").over(run))
        plan = spark.createDataFrame(ranks, "t_cls " + cls_type + ", t_part bigint, rank bigint, goal bigint")
        same = F.col("cls").eqNullSafe(F.col("t_cls"))
        if "part" in group:
            same = same & (F.col("part") == F.col("t_part"))
        hit = (F.col("end") >= F.col("goal")) & (F.col("end") - F.col("n") < F.col("goal"))
        return ends.join(F.broadcast(plan), same & hit).collect()

    by_part = hashed.groupBy("cls", "part").agg(F.count(F.lit(1)).alias("n"))
    level = holding(by_part, ["cls"], "part", [(c, None, r, r) for c, r in targets])
    spots = {(row["t_cls"], row["rank"]): (row["part"], row["goal"] - (row["end"] - row["n"]), row["n"])
             for row in level}

    big = {t: s for t, s in spots.items() if s[2] > small}
    narrowed: dict = {}
    if big:
        plan = [(c, s[0], r, s[1]) for (c, r), s in big.items()]
        parts = sorted({s[0] for s in big.values()})
        by_hash = hashed.filter(F.col("part").isin(parts)).groupBy("cls", "part", "h").agg(
            F.count(F.lit(1)).alias("n"))
        for row in holding(by_hash, ["cls", "part"], "h", plan):
            narrowed[row["t_cls"], row["rank"]] = (row["h"], row["goal"] - (row["end"] - row["n"]))

    found: dict = {}
    for col, group in (("part", {t: (s[0], s[1]) for t, s in spots.items() if t not in big}), ("h", narrowed)):
        if not group:
            continue
        near = hashed.filter(F.col(col).isin(sorted({g[0] for g in group.values()})))
        order = Window.partitionBy("cls", col).orderBy("h", "k")
        ranked = near.withColumn("place", F.row_number().over(order))
        plan = spark.createDataFrame(
            [(c, r, int(g[0]), int(g[1])) for (c, r), g in group.items()],
            f"t_cls {cls_type}, rank bigint, spot bigint, goal bigint")
        match = (F.col("cls").eqNullSafe(F.col("t_cls"))) & (F.col(col) == F.col("spot")) & (F.col("place") == F.col("goal"))
        for row in ranked.join(F.broadcast(plan), match).collect():
            found[row["t_cls"], row["rank"]] = (row["h"], row["k"])
    missing = [t for t in targets if t not in found]
    if missing:
        raise ValueError(f"ranks outside the table: {missing}")
    return found


def _after(cut: tuple, key: str, seed: int) -> Column:
    """Does the row come after the cut in hash order?"""
    h = hash_u32(key, seed)
    return (h > F.lit(cut[0])) | ((h == F.lit(cut[0])) & (F.col(key) > F.lit(cut[1])))


def _stretch_index(df: DataFrame, sizes: dict, ends: dict, key: str, seed: int, by: str | None) -> Column:
    """0 for rows up to the first end rank of their class, 1 up to the second, and so on."""
    inner = {c: sorted({e for e in ends[c] if 0 < e < sizes[c]}) for c in sizes}
    cuts = hash_cuts(df, inner, key, seed, by)
    out = F.lit(None).cast("int")
    for c in sizes:
        index = F.lit(0)
        for e in ends[c]:
            if e <= 0:
                index = index + 1
            elif e < sizes[c]:
                index = index + _after(cuts[c, e], key, seed).cast("int")
        out = F.when(_in_class(by, c), index).otherwise(out)
    return out


def assign_folds(df: DataFrame, k: int, key: str = "id", seed: int = 42, by: str | None = "label",
                 fold: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1; stratified by a class column, or plain if ``by`` is None.

    Fold sizes differ by at most one row per class. A class with fewer rows than folds leaves
    folds without it.
    """
    sizes = _class_sizes(df, by)
    # the first rank of fold j is the least i with i * k // n >= j, so fold j - 1 ends there
    ends = {c: [-(-j * n // k) for j in range(1, k)] for c, n in sizes.items()}
    return df.withColumn(fold, _stretch_index(df, sizes, ends, key, seed, by))


def assign_folds_in_order(df: DataFrame, k: int, key: str = "id", by: str = "label", fold: str = "fold") -> DataFrame:
    """Stratified folds without shuffling: row r of its class in key order goes to fold ``r % k``.

    Every fold gets its share of each class, and neighbours in key order part. The running number
    inside a class is counted in key ranges, so no class is sorted in one task.
    """
    ranged = df.select(F.col(key).alias("_k"), F.col(by).alias("_c")).repartitionByRange(F.col("_k")).withColumn("_part", F.spark_partition_id())
    ranged = ranged.sortWithinPartitions("_k")
    inside = Window.partitionBy("_c", "_part").orderBy("_k")
    numbered = ranged.withColumn("_row", F.row_number().over(inside))
    parts = ranged.groupBy("_c", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = [numbered["_c"].eqNullSafe(parts["_c"]), numbered["_part"] == parts["_part"]]
    placed = numbered.join(parts, same).select(numbered["_k"], ((F.col("_before") + F.col("_row") - 1) % k).cast("int").alias(fold))
    return df.join(placed, df[key] == placed["_k"]).drop("_k")


def assign_folds_by_hash(df: DataFrame, k: int, key: str = "id", seed: int = 42, fold: str = "fold") -> DataFrame:
    """Fold = hash mod k: no pass over the data at all, sizes equal only in expectation."""
    return df.withColumn(fold, F.pmod(hash_u32(key, seed), F.lit(k)).cast("int"))


def leave_one_out(df: DataFrame, key: str = "id", max_rows: int = 200, fold: str = "fold") -> DataFrame:
    """Every row its own fold; only for tiny tables, because each fold is a set of fits."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"leave-one-out needs one fit per row; the table has more than {max_rows}")
    order = Window.partitionBy(F.lit(1)).orderBy(key)  # at most max_rows rows, checked above
    return df.withColumn(fold, F.row_number().over(order) - 1)


def stratified_split(df: DataFrame, test_share: float = 0.2, key: str = "id", seed: int = 42,
                     by: str | None = "label", flag: str = "is_test") -> DataFrame:
    """Mark the first ``floor(share * class size)`` rows of each class in hash order as test rows."""
    sizes = _class_sizes(df, by)
    ends = {c: [int(test_share * n + 1e-9)] for c, n in sizes.items()}
    return df.withColumn(flag, _stretch_index(df, sizes, ends, key, seed, by) == 0)


def sample_n(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the first n in hash order."""
    size = df.count()
    if size <= n:
        return df
    cut = hash_cuts(df, {None: [n]}, key, seed)[None, n]
    return df.filter(~_after(cut, key, seed))
