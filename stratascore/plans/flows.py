"""The three jobs end to end: segment a table, train a model per segment, score new rows."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratascore.operators import segment as G
from stratascore.operators.models import fit_router, route
from stratascore.operators.profile import collect_stats
from stratascore.operators.redundancy import redundant_features
from stratascore.operators.reduce import PrincipalComponents, component_names
from stratascore.operators.transform import ColumnDropper, YeoJohnson
from stratascore.plans.recipes import FittedRecipe, Recipe, fit_recipe, load_recipe, save_recipe
from stratascore.session import materialize, release


def fit_preparation(df: DataFrame, features: Sequence[str], eps: float = 1e-6, above: float = 0.95,
                    keep: float = 0.95, max_components: int = 0) -> tuple[PipelineModel, list[str]]:
    """Drop flat and redundant columns, power transform and standardize, principal components.

    Returns the fitted pipeline (raw columns in, ``pc1..pck`` out) and the raw features that are
    left after the drops. All components that the share of variance needs are kept, unless
    ``max_components`` says otherwise; ``feature_count_check`` reports their number.
    """
    stats = collect_stats(df, features)
    flat = [f for f in features if (stats[f]["var"] or 0.0) < eps]
    live = [f for f in features if f not in flat]
    twins = redundant_features(df, live, above)
    kept = [f for f in live if f not in twins]
    drop = ColumnDropper([*flat, *twins])
    power = YeoJohnson(kept).fit(df)
    powered = power.transform(drop.transform(df)).select(*[F.col("`" + f + "`") for f in kept])
    reducer = PrincipalComponents(kept, keep=keep, max_components=max_components).fit(powered)
    return PipelineModel([drop, power, reducer]), kept


def feature_count_check(preparation: PipelineModel, n_rows: int, limit: int = 50) -> dict:
    """Components kept, rows per component, and whether their number stays within the advised limit."""
    n = len(preparation_components(preparation))
    return {"n_components": n, "advised": limit, "within": n <= limit, "rows_per_component": n_rows / n}


def preparation_components(preparation: PipelineModel) -> list[str]:
    return component_names(preparation.stages[-1])


@dataclass
class Segmentation:
    """Two ways to assign a segment: from prepared columns (KMeans) and from raw ones (router)."""

    preparation: PipelineModel
    segments: PipelineModel
    router: PipelineModel
    features: list[str]
    report: dict

    def assign(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        """``df`` plus the KMeans segment. The raw row rides along as one struct, so nothing is joined."""
        names = preparation_components(self.preparation)
        rows = df.select(F.struct("*").alias("_row"), "*")
        prepared = self.preparation.transform(rows).select("_row", *names)
        vectors = VectorAssembler(inputCols=names, outputCol="_pc").transform(prepared)
        found = self.segments.transform(vectors)
        return found.select("_row.*", F.col("cluster").alias(out))

    def route(self, df: DataFrame) -> DataFrame:
        return route(df, self.router)


def fit_segmentation(df: DataFrame, features: Sequence[str], k: int = 8, restarts: int = 20,
                     max_iter: int = 500) -> tuple[Segmentation, DataFrame]:
    """Prepare, segment, attach the segment to the raw rows, train the router on them."""
    preparation, kept = fit_preparation(df, features)
    names = preparation_components(preparation)
    rows = preparation.transform(df.select(F.struct("*").alias("_row"), "*")).select("_row", *names)
    staged = materialize(VectorAssembler(inputCols=names, outputCol="_pc").transform(rows).select("_row", "_pc"), "prepared")
    segments, report = G.fit_segments(staged, k, restarts, max_iter, vector="_pc")
    # by segment, so that each segment's trainer reads its own folder
    raw = materialize(segments.transform(staged).select("_row.*", "cluster"), "segmented", partition_by="cluster")
    release(staged)
    stats = collect_stats(raw, features)
    live = [f for f in features if (stats[f]["var"] or 0.0) >= 1e-6]
    router = fit_router(raw, live)
    return Segmentation(preparation, segments, router, live, report), raw


def train_segments(df: DataFrame, features: Sequence[str], recipes: dict[int, Recipe], key: str = "id",
                   label: str = "label", segment: str = "cluster", threads: int = 2) -> dict[int, FittedRecipe]:
    """One model per segment. The segments are independent, so their jobs overlap."""

    def one(item: tuple[int, Recipe]) -> tuple[int, FittedRecipe]:
        number, recipe = item
        return number, fit_recipe(recipe, df.filter(F.col(segment) == number), features, key, label)

    with ThreadPoolExecutor(threads) as pool:
        return dict(pool.map(one, recipes.items()))


class SegmentScorer:
    """Routes rows and sends each segment to its own model.

    The routed rows are written once, partitioned by segment, with only the columns some model
    needs. Each model then reads its own partition: the table is read once, not once per model.
    """

    def __init__(self, router: PipelineModel, models: dict[int, FittedRecipe]):
        self.router, self.models = router, dict(models)

    def transform(self, df: DataFrame, key: str = "id") -> DataFrame:
        """``(key, cluster, probability, prediction)``, one row per input row.

        The result reads the routed copy; ``write`` deletes that copy when the rows are written.
        """
        return self._score(df, key)[0]

    def write(self, df: DataFrame, path: str, key: str = "id") -> None:
        """Score into ``path`` and leave nothing else behind."""
        scored, staged = self._score(df, key)
        scored.write.mode("overwrite").parquet(path)
        release(staged)

    def _score(self, df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        used = sorted({f for m in self.models.values() for f in m.features})
        # a row with a missing feature has no route and no score, but it keeps its place
        inputs = sorted({*used, *self.router.stages[0].get("columns")})
        whole = reduce(lambda a, b: a & b, [F.col("`" + f + "`").cast("double").isNotNull() for f in inputs])
        routed = route(df.filter(whole), self.router).select(key, "cluster", *[F.col("`" + f + "`") for f in used])
        missing = df.filter(~whole).select(key, F.lit(None).cast("int").alias("cluster"), *[F.col("`" + f + "`") for f in used])
        staged = materialize(routed.unionByName(missing), "routed", partition_by="cluster")
        parts = []
        for number, model in sorted(self.models.items()):
            mine = staged.filter(F.col("cluster") == number)
            parts.append(model.transform(mine).select(key, "cluster", "probability", "prediction"))
        others = staged.filter(F.col("cluster").isNull() | ~F.col("cluster").isin(list(self.models)))
        parts.append(others.select(  # a segment without a model keeps its rows, unflagged and visible
            key, "cluster", F.lit(None).cast("double").alias("probability"), F.lit(None).cast("int").alias("prediction")))
        return reduce(DataFrame.unionByName, parts), staged

    def save(self, spark: SparkSession, path: str) -> None:
        self.router.write().overwrite().save(f"{path}/router")
        for number, model in self.models.items():
            save_recipe(model, spark, f"{path}/segment-{number}")
        spark.createDataFrame([(n,) for n in self.models], "segment int").coalesce(1).write.mode("overwrite").json(
            f"{path}/segments")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "SegmentScorer":
        numbers = [r[0] for r in spark.read.schema("segment int").json(f"{path}/segments").collect()]
        return SegmentScorer(PipelineModel.load(f"{path}/router"),
                             {n: load_recipe(spark, f"{path}/segment-{n}") for n in numbers})
