"""The per-segment training recipes as data, and the code that fits any of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.operators import evaluate
from stratascore.operators.models import ConstantModel, Learner
from stratascore.operators.profile import class_counts, constant_columns
from stratascore.operators.reduce import PrincipalComponents, component_names, l1_select
from stratascore.operators.schema import select_features
from stratascore.operators.stack import StackSpec, fit_stack, nested_out_of_fold
from stratascore.operators.transform import ColumnDropper, MinMaxSelected, VarianceFilter
from stratascore.session import materialize, release

# The columns chosen by hand for three segments of the company table, and in ``_reference``
# the published sizes, folds, strengths and thresholds of each segment's recipe.
C0_COLUMNS = [
    "Tax rate (A)",
    "Cash Flow to Liability",
    "ROA(A) before interest and % after tax",
    "Retained Earnings to Total Assets",
    "Net Income to Total Assets",
    "Cash Flow to Total Assets",
    "CFO to Assets",
    "Operating Funds to Liability",
    "Current Liabilities/Liability",
    "Total expense/Assets",
]
C4_COLUMNS = ["Interest Coverage Ratio (Interest expense to EBIT)"]
C6_COLUMNS = [
    "ROA(A) before interest and % after tax",
    "Working Capital to Total Assets",
    "Current Liability to Current Assets",
    "Retained Earnings to Total Assets",
    "Current Liability to Assets",
]
DROPPED_COLUMNS = ["Index", "Liability-Assets Flag", "Net Income Flag", "Cluster"]


@dataclass(frozen=True)
class Recipe:
    """Preparation, stack and threshold rule of one segment."""

    name: str
    stack: StackSpec | None
    columns: tuple[str, ...] | None = None  # chosen by hand; None for all features
    drop: tuple[str, ...] = ()
    drop_constants: bool = False
    l1_c: float | None = None
    minmax: bool = False
    variance_above: float | None = None
    components: int | None = None
    threshold: float = 0.5
    sweep: tuple[int, int, int] | None = None  # first, last, step in percent
    flag_cap: float = 1.0
    outer_folds: int = 5
    constant: int | None = None
    note: str = ""


def _lr(c: float = 1.0, balanced: bool = True, name: str = "lr") -> Learner:
    return Learner(name, "lr", {"c": c}, balanced)


def _rf(trees: int, depth: int | None, per_bag: bool = False) -> Learner:
    return Learner("rf", "rf", {"trees": trees, "depth": depth}, per_bag=per_bag)


def _gbt(steps: int, depth: int, rate: float, rows: float = 1.0) -> Learner:
    return Learner("gbt", "gbt", {"steps": steps, "depth": depth, "rate": rate, "rows": rows}, balanced=False)


def _reference() -> dict[str, Recipe]:
    wide_bases = (
        _gbt(100, 5, 0.1, 0.8), Learner("svc", "rbf_svc", {"c": 10.0}), _rf(100, 10, per_bag=True), _lr(1.0),
    )
    l1_bases = (_lr(1.0), _rf(200, 8), _gbt(200, 3, 0.05))
    l1 = dict(drop_constants=True, l1_c=0.01, note="L1 selection, LR + RF + GBT, LR meta, tuned threshold")
    return {
        "c0": Recipe(
            "c0",
            StackSpec((_lr(0.5), _rf(200, 5), _gbt(200, 3, 0.05), Learner("svc", "rbf_svc", {"c": 1.0})),
                      folds=4, smote_ratio=0.3, smote_k=1),
            columns=tuple(C0_COLUMNS), threshold=0.49, outer_folds=4,
            note="scale, SMOTE 0.3, LR + RF + GBT + SVC, LR meta, fixed threshold"),
        "c1": Recipe("c1", StackSpec(l1_bases, folds=5), sweep=(20, 80, 5), flag_cap=0.10, **l1),
        "c2": Recipe("c2", StackSpec(wide_bases, folds=10, scale=False), drop=tuple(DROPPED_COLUMNS), minmax=True,
                     variance_above=0.1, components=1, note="min-max, variance filter, one component"),
        "c3": Recipe("c3", StackSpec(wide_bases, folds=6, scale=False), drop=tuple(DROPPED_COLUMNS), minmax=True,
                     components=15, note="min-max, fifteen components"),
        "c4": Recipe(
            "c4",
            StackSpec((Learner("svm", "poly_svc", {"c": 1.0}), Learner("knn", "knn", {"k": 3}), _rf(100, None)),
                      folds=2, smote_ratio=0.8, smote_k=1, smote_first=True),
            columns=tuple(C4_COLUMNS), note="SMOTE 0.8, scale, SVC + KNN + RF, LR meta"),
        "c5": Recipe("c5", StackSpec(l1_bases, folds=5), sweep=(20, 60, 5), flag_cap=0.25, **l1),
        "c6": Recipe(
            "c6",
            StackSpec((_lr(0.1, balanced=False), Learner("dt", "stump", balanced=False), Learner("knn", "knn", {"k": 1})),
                      folds=2, meta_balanced=False),
            columns=tuple(C6_COLUMNS), note="scale, LR + stump + 1-NN, LR meta"),
        "c7": Recipe("c7", None, constant=0, note="no positives: constant"),
    }


def recipes() -> dict[str, Recipe]:
    """The eight recipes at their published sizes."""
    return _reference()


@dataclass
class FittedRecipe:
    """A fitted recipe: one pipeline that adds ``probability`` and ``prediction``, and its facts."""

    name: str
    model: PipelineModel | None
    features: list[str]
    threshold: float
    n_train: int
    n_pos: int
    note: str = ""
    constant: int | None = None
    n_inputs: int = 0  # columns the stack reads after the preparation
    folds: int = 0
    partitions: int = 0  # layout of the fits, part of the result like a seed
    extra: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """All input columns, the base probabilities, ``probability`` and ``prediction``."""
        if self.model is None:
            return ConstantModel(self.constant).transform(df)
        # preparation replaces columns, so the raw row rides along as one struct
        rows = df.select(F.struct("*").alias("_row"), *[F.col("`" + f + "`") for f in self.features])
        scored = self.model.transform(rows)
        bases = [c for c in scored.columns if c.startswith("p_")]
        return scored.select("_row.*", *bases, "probability", "prediction")

    def score(self, df: DataFrame, key: str = "id") -> DataFrame:
        """Key, probability and prediction only."""
        return self.transform(df).select(key, "probability", "prediction")

    def facts(self) -> tuple:
        return (self.name, self.features, self.threshold, self.n_train, self.n_pos, self.note, self.constant,
                self.n_inputs, self.folds, self.partitions)


FACTS = ("name string, features array<string>, threshold double, n_train bigint, n_pos bigint, "
         "note string, constant int, n_inputs int, folds int, partitions int")


def metadata(spark, fitted: Sequence[FittedRecipe]) -> DataFrame:
    """One row per recipe: what it uses and what it was trained on."""
    df = spark.createDataFrame([f.facts() for f in fitted], FACTS)
    return df.withColumn("n_features", F.size("features"))


def prepare(recipe: Recipe, df: DataFrame, features: Sequence[str], key: str = "id",
            label: str = "label") -> tuple[list, DataFrame, list[str], list[str]]:
    """Fit the preparation. Returns its stages, the prepared table, the raw and the prepared names."""
    names = [f for f in (recipe.columns or features) if f not in recipe.drop]
    if recipe.drop_constants:
        constant = {r["feature"] for r in constant_columns(df, names, include_all_null=True).collect()}
        names = [f for f in names if f not in constant]
    rows = select_features(df, names, keep=(key, label))
    if recipe.l1_c:
        names = [f for f, _ in l1_select(rows, names, recipe.l1_c, label)]
        _not_empty(recipe, names, f"the L1 penalty at c = {recipe.l1_c}")
        rows = select_features(rows, names, keep=(key, label))
    used, stages = list(names), []
    if recipe.minmax:
        stages.append(MinMaxSelected(names).fit(rows))
        rows = stages[-1].transform(rows)
    if recipe.variance_above is not None:
        dropper: ColumnDropper = VarianceFilter(names, recipe.variance_above).fit(rows)
        gone = set(dropper.get("columns"))
        names = [f for f in names if f not in gone]
        _not_empty(recipe, names, f"the variance filter at {recipe.variance_above}")
        stages.append(dropper)
        rows = dropper.transform(rows)
    if recipe.components:
        if recipe.components > len(names):
            raise ValueError(f"recipe {recipe.name} wants {recipe.components} components of {len(names)} columns")
        reducer = PrincipalComponents(names, k=recipe.components).fit(rows)
        stages.append(reducer)
        rows = reducer.transform(rows)
        names = component_names(reducer)
    return stages, rows, used, names


def _not_empty(recipe: Recipe, names: Sequence[str], stage: str) -> None:
    if not names:
        raise ValueError(f"recipe {recipe.name}: {stage} leaves no column; choose another setting for this table")


def fit_recipe(recipe: Recipe, df: DataFrame, features: Sequence[str], key: str = "id",
               label: str = "label") -> FittedRecipe:
    """Prepare, stack, pick the threshold under the flag cap, refit on all rows."""
    counts = class_counts(df, label)
    n, n_pos = sum(counts.values()), counts.get(1, 0)
    constant = recipe.constant
    if constant is None and len(counts) == 1:
        constant = int(n_pos > 0)  # one class only: nothing to learn
    if constant is not None:
        return FittedRecipe(recipe.name, None, [], 0.5, n, n_pos, recipe.note, constant)
    train = materialize(df.select(key, label, *[F.col("`" + f + "`") for f in (recipe.columns or features)]), "train")
    stages, rows, used, names = prepare(recipe, train, features, key, label)
    threshold, extra = recipe.threshold, {}
    if recipe.sweep:
        oof = nested_out_of_fold(rows, names, recipe.stack, recipe.outer_folds, key, label)
        folds = evaluate.outer_fold_report(oof, label=label)
        extra["outer_folds"] = [tuple(r) for r in folds.collect()]  # one row per fold
        sweep = evaluate.threshold_sweep(oof, evaluate.percent_steps(*recipe.sweep), label=label)
        picked = evaluate.threshold_pick(sweep, recipe.flag_cap).head()
        threshold = picked["threshold"]
        extra["oof_recall"] = picked["recall"]
        release(oof)
    stack = fit_stack(rows, names, recipe.stack, threshold, key, label)
    release(train)
    return FittedRecipe(recipe.name, PipelineModel([*stages, stack]), used, threshold, n, n_pos, recipe.note, None,
                        len(names), recipe.stack.folds, recipe.stack.partitions, extra)


def save_recipe(fitted: FittedRecipe, spark, path: str) -> None:
    """The pipeline and, beside it, a one-row table of facts."""
    spark.createDataFrame([fitted.facts()], FACTS).coalesce(1).write.mode("overwrite").json(f"{path}/facts")
    if fitted.model is not None:
        fitted.model.write().overwrite().save(f"{path}/model")


def load_recipe(spark, path: str) -> FittedRecipe:
    row = spark.read.schema(FACTS).json(f"{path}/facts").head()
    model = PipelineModel.load(f"{path}/model") if row["constant"] is None else None
    return FittedRecipe(row["name"], model, list(row["features"] or []), row["threshold"], row["n_train"],
                        row["n_pos"], row["note"], row["constant"], row["n_inputs"], row["folds"], row["partitions"])
