"""Two-stage delay models: forests and boosting on the binned table, linear models on ``pyspark.ml``."""

from __future__ import annotations

import itertools
import random
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from slotwise.functions.rules import logistic
from slotwise.operators.ranks import dense_index, median
from slotwise.plans.binned_trees import BinnedModel, Settings, Unit, bin_rows, fit_binning, fit_units, fold_scores
from slotwise.plans.cleaning import FeatureSet
from slotwise.plans.evaluate import (
    best_threshold, classifier_metrics, min_max_scores, ranking_metrics, regression_metrics, threshold_sweep,
)
from slotwise.plans.fills import ExactFills
from slotwise.plans.splits import expanding_folds, positional_split
from slotwise.schemas import DELAY_THRESHOLD_MINUTES, TARGET_CLASS, TARGET_MINUTES, TIME_COLUMN
from slotwise.session import persist_table

MIN_DELAYED_TRAIN_ROWS = 100

# Settings of the published models, in MLlib terms (fixed values).
CLASSIFIER_DEFAULTS = {
    "numTrees": 500, "maxDepth": 6, "minInstancesPerNode": 2, "featureSubsetStrategy": "all", "seed": 42,
}
REGRESSOR_DEFAULTS = {
    "numTrees": 500, "maxDepth": 15, "minInstancesPerNode": 5, "featureSubsetStrategy": "log2", "seed": 42,
}
# The same models on the binned table (fixed values).
CLASSIFIER = Settings("forest", "log", 500, depth=6, least_leaf=2, balanced=True)
REGRESSOR = Settings("forest", "squared", 500, depth=15, least_leaf=5, least_split=5, features="log2")
# Settings of the baselines and search spaces (fixed values).
BASELINE_FOREST = {"kind": "forest", "trees": 300, "least_leaf": 2}
BASELINE_BOOSTING = {"kind": "boosting", "trees": 200, "rate": 0.05, "leaves": 31, "least_leaf": 20}
FOREST_SPACE = {
    "trees": [200, 300, 500],
    "depth": [None, 6, 10, 15, 20],
    "least_leaf": [1, 2, 5, 10],
    "least_split": [2, 5, 10],
    "features": ["sqrt", "log2", "all"],
}
BOOSTING_SPACE = {
    "trees": [100, 200, 300],
    "rate": [0.03, 0.05, 0.08, 0.10],
    "leaves": [15, 31, 63],
    "least_leaf": [10, 20, 50],
    "l2": [0.0, 0.01, 0.1, 1.0],
}
CLASS_WEIGHTS = {"balanced": [False, True]}
LOGISTIC_C = [10.0 ** (i * 5 / 11 - 3) for i in range(12)]
SEARCHED = {"classifier": 20, "regressor": 14}
FOLDS = 4


@dataclass
class ModelFrame:
    """Rows ready for fitting: features, ``y``, ``minutes``, ``weight``, and a total
    order (``order``, ``tie``)."""

    rows: DataFrame
    numeric: list[str]
    categorical: list[str]

    def on(self, rows: DataFrame) -> ModelFrame:
        return ModelFrame(rows, self.numeric, self.categorical)


def model_frame(features: FeatureSet) -> ModelFrame:
    rows = features.rows
    names = features.features
    return ModelFrame(
        rows.select(
            *[F.col(c).cast("double").alias(c) for c in features.numeric],
            *features.categorical,
            F.col(TARGET_CLASS).cast("int").alias("y"),
            F.col(TARGET_MINUTES).cast("double").alias("minutes"),
            F.unix_micros(F.col(TIME_COLUMN).cast("timestamp")).alias("order"),
            F.xxhash64(TARGET_MINUTES, *names).alias("tie"),
        ),
        features.numeric,
        features.categorical,
    )


def preprocessing(frame: ModelFrame) -> list:
    """Median and mode imputation, scaling, one-hot with unknown values as zeros.

    All of it is fitted with the pipeline; everything ends in ``features``.
    """
    stages, parts = [ExactFills(numeric=frame.numeric, categorical=frame.categorical)], []
    if frame.numeric:
        stages += [
            VectorAssembler(inputCols=[f"{c}__num" for c in frame.numeric], outputCol="_numeric"),
            StandardScaler(withMean=True, inputCol="_numeric", outputCol="_scaled"),
        ]
        parts.append("_scaled")
    if frame.categorical:
        stages += [
            StringIndexer(
                inputCols=[f"{c}__cat" for c in frame.categorical],
                outputCols=[f"{c}__idx" for c in frame.categorical],
                handleInvalid="keep",
            ),
            OneHotEncoder(
                inputCols=[f"{c}__idx" for c in frame.categorical],
                outputCols=[f"{c}__hot" for c in frame.categorical],
                dropLast=True,
            ),
        ]
        parts += [f"{c}__hot" for c in frame.categorical]
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


Model = PipelineModel | BinnedModel


def target_of(settings: Settings) -> str:
    return "y" if settings.loss == "log" else "log_minutes"


def fit(frame: ModelFrame, estimator: Estimator | Settings) -> Model:
    return fit_all(frame, {"": estimator})[""]


def fit_all(frame: ModelFrame, estimators: dict[str, Estimator | Settings]) -> dict[str, Model]:
    """Fitted models by name; all trees come from one binned table and shared passes."""
    found = {n: Pipeline(stages=[*preprocessing(frame), e]).fit(frame.rows) for n, e in estimators.items() if not isinstance(e, Settings)}
    trees = {n: e for n, e in estimators.items() if isinstance(e, Settings)}
    if trees:
        binning = fit_binning(frame.rows, frame.numeric, frame.categorical)
        for target in sorted({target_of(e) for e in trees.values()}):
            names = [n for n, e in trees.items() if target_of(e) == target]
            table = bin_rows(frame.rows, binning, target)
            found |= dict(zip(names, fit_units(table, [Unit(trees[n]) for n in names])))
    return {n: found[n] for n in estimators}


def balanced(rows: DataFrame) -> DataFrame:
    """Column ``weight`` = rows / (2 * rows of the class)."""
    n = rows.groupBy("y").count().collect()
    total = sum(r["count"] for r in n)
    weight = F.lit(1.0)
    for r in n:
        weight = F.when(F.col("y") == r["y"], total / (2.0 * r["count"])).otherwise(weight)
    return rows.withColumn("weight", weight)


def forest_classifier(**params) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="y", featuresCol="features", weightCol="weight", **{**CLASSIFIER_DEFAULTS, **params}
    )


def forest_regressor(**params) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol="log_minutes", featuresCol="features", **{**REGRESSOR_DEFAULTS, **params}
    )


def _transformed(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``model.transform(rows)``. A fitted stage goes to the tasks that score with it, and its training summary, which
    holds the session, may not be sendable, so copies without summaries do it."""
    if isinstance(model, PipelineModel):
        model = model.copy()
        for stage in model.stages:
            if getattr(stage, "hasSummary", False):
                stage._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model.transform(rows)


def with_probability(model: Model, rows: DataFrame, scaled: bool = False) -> DataFrame:
    """Scored rows with ``p``; working columns are dropped.

    The margin of a model without probabilities goes through the logistic function, or
    with ``scaled`` is spread over the range of the margins of all ``rows``. A model
    with neither gives its prediction.
    """
    if isinstance(model, BinnedModel):
        return model.score(rows, "p")
    scored = _transformed(model, rows)
    if "probability" in scored.columns:
        return scored.select(*rows.columns, vector_to_array("probability")[1].alias("p"))
    if "rawPrediction" not in scored.columns:
        return scored.select(*rows.columns, F.col("prediction").cast("double").alias("p"))
    margin = vector_to_array("rawPrediction")[1]
    if not scaled:
        return scored.select(*rows.columns, logistic(margin).alias("p"))
    margins = persist_table(scored.select(*rows.columns, margin.alias("_margin")), "margins")
    return min_max_scores(margins, "_margin").drop("_margin")


def with_minutes(model: Model, rows: DataFrame) -> DataFrame:
    """Rows with ``pred_min``, back from the log scale and never negative."""
    if isinstance(model, BinnedModel):
        scored = model.score(rows, "pred_min")
        return scored.withColumn("pred_min", F.greatest(F.expm1("pred_min"), F.lit(0.0)))
    scored = _transformed(model, rows)
    return scored.select(
        *rows.columns, F.greatest(F.expm1("prediction"), F.lit(0.0)).alias("pred_min")
    )


def delayed_rows(frame: ModelFrame, minimum: int = MIN_DELAYED_TRAIN_ROWS) -> ModelFrame:
    late = frame.rows.where(F.col("minutes") > DELAY_THRESHOLD_MINUTES).withColumn(
        "log_minutes", F.log1p("minutes")
    )
    n = late.count()
    if n < minimum:
        raise ValueError(f"too few delayed rows for regression: {n}")
    return frame.on(late)


def tune_threshold(frame: ModelFrame, estimator: Estimator | Settings, **limits: float) -> tuple[dict, DataFrame]:
    """Fit on the first 80 % of the rows, pick the threshold on the last 20 %."""
    early, late = positional_split(frame.rows, "order", "tie", 0.8)
    model = fit(frame.on(early), estimator)
    sweep = threshold_sweep(with_probability(model, late, scaled=True).select("y", "p"))
    return best_threshold(sweep, **limits), sweep


# ------------------------------------------------------------------ baselines
def logistic_penalty(c: float, rows: int) -> float:
    """MLlib averages the loss that ``c`` weighs as a sum, so the penalty falls with the rows."""
    return 1 / (c * max(rows, 1))


def logistic_space(rows: int) -> dict[str, list]:
    return {"regParam": [logistic_penalty(c, rows) for c in LOGISTIC_C]}


def baseline_classifiers(rows: int) -> dict[str, Estimator | Settings]:
    """Baseline estimators for that many training rows."""
    return {
        "Logistic Regression": LogisticRegression(
            labelCol="y", featuresCol="features", maxIter=3000, regParam=logistic_penalty(1.0, rows), standardization=False,
        ),
        "Random Forest": Settings(loss="log", **BASELINE_FOREST, features="sqrt"),
        "HistGradientBoosting": Settings(loss="log", **BASELINE_BOOSTING),
    }


def baseline_regressors(rows: int) -> dict[str, Estimator | Settings]:
    return {
        "Ridge": LinearRegression(
            labelCol="log_minutes", featuresCol="features", regParam=1 / max(rows, 1),
            elasticNetParam=0.0, standardization=False,
        ),
        "Random Forest Regressor": Settings(loss="squared", **BASELINE_FOREST),
        "HistGradientBoosting Regressor": Settings(loss="squared", **BASELINE_BOOSTING),
    }


def majority_scores(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Scores of the model that always answers with the more frequent class."""
    share = train.agg(F.avg("y")).scalar()
    return rows.withColumn("p", F.when(share > 0.5, 1.0).otherwise(0.0))


def median_minutes(train: DataFrame, rows: DataFrame) -> DataFrame:
    middle = median(train, [], "log_minutes").select("median").scalar()
    return rows.withColumn("pred_min", F.greatest(F.expm1(middle), F.lit(0.0)))


def _judged(train: ModelFrame, test: DataFrame, trees: dict[str, Settings], target: str) -> DataFrame:
    """Scores of the rows of ``test`` by every model of ``trees`` fitted to ``train``: unit, y, p.
    Rows of both are binned together, so that no model leaves the tasks that fit it."""
    used = [*train.numeric, *train.categorical, target, "order", "tie"]
    rows = train.rows.select(*used, F.lit(0).alias("fold")).unionByName(test.select(*used, F.lit(1).alias("fold")))
    binning = fit_binning(train.rows, train.numeric, train.categorical)
    table = bin_rows(rows, binning, target, F.col("fold"))
    return persist_table(fold_scores(table, [Unit(e, 1) for e in trees.values()]), "scored")


def compare_classifiers(
    train: ModelFrame, test: DataFrame, estimators: dict[str, Estimator | Settings], stage: str, threshold: float = 0.5
) -> DataFrame:
    """Metrics per model, best first by average precision, ROC-AUC and F1."""
    scored = {"Dummy most_frequent": majority_scores(train.rows, test)} if stage == "baseline" else {}
    trees = {n: e for n, e in estimators.items() if isinstance(e, Settings)}
    for name, model in fit_all(train, {n: e for n, e in estimators.items() if n not in trees}).items():
        scored[name] = persist_table(with_probability(model, test, scaled=True).select("y", "p"), "scored")
    if trees:
        judged = _judged(train, test, trees, "y")
        scored |= {n: judged.where(F.col("unit") == u).select(F.col("y").cast("int"), "p") for u, n in enumerate(trees)}
    return leaderboard(scored, stage, threshold)


def leaderboard(scored: dict[str, DataFrame], stage: str, threshold: float = 0.5) -> DataFrame:
    """Metrics of scored rows (``y``, ``p``) per model from one aggregation of all of them,
    best first; a model without scored rows is left out."""
    rows = _stack({name: s.select("y", "p") for name, s in scored.items()})
    found = classifier_metrics(rows, threshold, ["model"])
    return found.select("model", F.lit(stage).alias("stage"), *found.columns[1:]).orderBy(
        F.desc("pr_auc"), F.desc("roc_auc"), F.desc("f1"), "model"
    )


def compare_regressors(
    train: ModelFrame, test: DataFrame, estimators: dict[str, Estimator | Settings], stage: str
) -> DataFrame:
    """Metrics per regressor on late rows, best first by MAE and RMSE."""
    scored = {"Dummy median": median_minutes(train.rows, test)} if stage == "baseline" else {}
    trees = {n: e for n, e in estimators.items() if isinstance(e, Settings)}
    for name, model in fit_all(train, {n: e for n, e in estimators.items() if n not in trees}).items():
        scored[name] = persist_table(with_minutes(model, test).select("minutes", "pred_min"), "scored")
    if trees:
        judged = _judged(train, test.withColumn("log_minutes", F.log1p("minutes")), trees, "log_minutes")
        minutes, guess = F.expm1("y").alias("minutes"), F.greatest(F.expm1("p"), F.lit(0.0)).alias("pred_min")
        scored |= {n: judged.where(F.col("unit") == u).select(minutes, guess) for u, n in enumerate(trees)}
    return regressor_leaderboard(scored, stage)


def regressor_leaderboard(scored: dict[str, DataFrame], stage: str) -> DataFrame:
    """Metrics of scored late rows (``minutes``, ``pred_min``) per model, best first; a model
    without scored rows is left out."""
    rows = _stack({name: s.select("minutes", "pred_min") for name, s in scored.items()})
    found = regression_metrics(rows, ["model"])
    return found.select("model", F.lit(stage).alias("stage"), *found.columns[1:]).orderBy("mae", "rmse", "model")


def _stack(frames: dict[str, DataFrame]) -> DataFrame:
    """The rows of all frames with the name of theirs in ``model``."""
    return reduce(DataFrame.unionByName, [f.select(F.lit(n).alias("model"), "*") for n, f in frames.items()])


# -------------------------------------------------------------- random search
def sample_settings(space: dict[str, list], n: int, seed: int = 42) -> list[dict]:
    """``n`` distinct settings of the grid, the same ones for the same seed."""
    grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(n, len(grid)))


def random_search(
    frame: ModelFrame, make, space: dict[str, list], n: int, kind: str, folds: int = 4, seed: int = 42
) -> list[dict]:
    """Mean validation score per setting over expanding time folds, best first.

    ``kind`` is ``classifier`` (average precision) or ``regressor`` (MAE). The loop
    runs over settings and folds; each step is a distributed fit.
    """
    marked = expanding_folds(frame.rows, "order", "tie", folds)
    results = []
    for settings in sample_settings(space, n, seed):
        scores = []
        for fold in range(1, folds + 1):
            train, valid = marked.where(F.col("fold") < fold), marked.where(F.col("fold") == fold)
            model = fit(frame.on(train), make(**settings))
            if kind == "classifier":
                scored = with_probability(model, valid).select("y", "p")
                scores.append(ranking_metrics(scored).first()["pr_auc"] or 0.0)
            else:
                scored = with_minutes(model, valid)
                error = F.abs(F.col("pred_min") - F.col("minutes"))
                scores.append(scored.agg(F.avg(error)).first()[0])
        results.append({**settings, "score": sum(scores) / len(scores)})
    return sorted(results, key=lambda r: r["score"], reverse=kind == "classifier")


def search_trees(
    frame: ModelFrame, family: str, space: dict[str, list], n: int, target: str, folds: int = FOLDS, seed: int = 42
) -> list[dict]:
    """Mean validation score per setting over expanding time folds, best first, as
    ``random_search`` gives it: average precision, or MAE in minutes.

    Rows are binned once and the models of all settings and folds are fitted together.
    Bounds of the bins come from all rows of ``frame``, the labels of a fold from none of it.
    """
    marked = persist_table(expanding_folds(frame.rows, "order", "tie", folds), "folds")
    table = bin_rows(marked, fit_binning(marked, frame.numeric, frame.categorical), target, F.col("fold"))
    settings = sample_settings(space, n, seed)
    loss = "log" if target == "y" else "squared"
    units = [Unit(Settings(family, loss, **s), fold) for s in settings for fold in range(1, folds + 1)]
    scored = persist_table(fold_scores(table, units), "fold-scores")
    if loss == "log":
        found = ranking_metrics(scored, ["unit"]).select("unit", F.coalesce("pr_auc", F.lit(0.0)).alias("score"))
    else:
        error = F.abs(F.greatest(F.expm1("p"), F.lit(0.0)) - F.expm1("y"))
        found = scored.groupBy("unit").agg(F.avg(error).alias("score"))
    by_unit = {r["unit"]: r["score"] for r in found.collect()}
    results = [
        {**s, "score": sum(by_unit.get(k * folds + f, 0.0) for f in range(folds)) / folds} for k, s in enumerate(settings)
    ]
    return sorted(results, key=lambda r: r["score"], reverse=loss == "log")


def refitted(frame: ModelFrame, family: str, target: str, results: list[dict]) -> BinnedModel:
    """The best setting of a search, fitted to all rows of ``frame``."""
    best = {k: v for k, v in results[0].items() if k != "score"}
    return fit(frame, Settings(family, "log" if target == "y" else "squared", **best))


# ------------------------------------------------------ permutation importance
def paired_rows(rows: DataFrame, features: list[str], seed: int) -> DataFrame:
    """Every row with the ``features`` of another one in ``_donor``: both sides are numbered in
    an order of their own and meet on the number. The number of partitions is given, as
    adaptive execution would size them for the rows alone, not for what is made of them.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.withColumn("_h", F.xxhash64("order", "tie", F.lit(2 * seed)))
    donors = rows.select(
        F.struct(*features).alias("_donor"), F.xxhash64("order", "tie", F.lit(2 * seed + 1)).alias("_h")
    )
    left = dense_index(keyed, "_h", "_i").drop("_h").repartition(parts, "_i")
    right = dense_index(donors, "_h", "_i").drop("_h").repartition(parts, "_i")
    return left.join(right, "_i").drop("_i")


def permuted_rows(rows: DataFrame, features: list[str], seed: int) -> DataFrame:
    """Every row once per feature, named in ``_feature``, with that feature taken from
    another row. One permutation serves all features, since only one of them is replaced
    at a time; rows are shuffled once, before they are multiplied.
    """
    paired = paired_rows(rows, features, seed).withColumn("_feature", F.explode(F.array(*map(F.lit, features))))
    mixed = {
        c: F.when(F.col("_feature") == c, F.col("_donor").getField(c)).otherwise(F.col(c)).alias(c)
        for c in features
    }
    return paired.select("_feature", *[mixed.get(c, F.col(c)) for c in rows.columns])


def permutation_importance(
    model: Model, rows: DataFrame, features: list[str], repeats: int = 5, seed: int = 42
) -> list[dict]:
    """Loss of average precision when one feature is shuffled, largest first. Each repeat
    scores all features in one pass; binned trees, which know the features that they look at,
    leave the rows unmultiplied."""
    base = ranking_metrics(with_probability(model, rows).select("y", "p")).first()["pr_auc"]
    drops: dict[str, list[float]] = {f: [] for f in features}
    for r in range(repeats):
        if isinstance(model, BinnedModel):
            scored = model.score_permuted(paired_rows(rows, features, seed + r), features, "_donor", "y")
        else:
            shuffled = permuted_rows(rows, features, seed + r)
            scored = with_probability(model, shuffled).select("_feature", "y", "p")
        for row in ranking_metrics(scored, ["_feature"]).collect():
            drops[row["_feature"]].append(base - row["pr_auc"])
    out = []
    for feature, lost in drops.items():
        mean = sum(lost) / len(lost)
        spread = (sum((d - mean) ** 2 for d in lost) / len(lost)) ** 0.5
        out.append({"feature": feature, "importance_mean": mean, "importance_std": spread})
    return sorted(out, key=lambda r: -r["importance_mean"])
