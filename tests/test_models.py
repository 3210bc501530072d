"""Properties of the fitted models on a small planted signal."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from slotwise.catalog import modelling
from slotwise.plans import cleaning, models, scoring
from slotwise.plans.binned_trees import BinnedModel, Settings, Unit, bin_rows, fit_binning, fit_units
from slotwise.plans.evaluate import ranking_metrics
from slotwise.plans.splits import expanding_folds

SMALL = {"numTrees": 8, "maxDepth": 4}


@pytest.fixture(scope="module")
def frame(spark):
    random.seed(13)
    start = datetime(2026, 4, 10)
    rows = []
    for i in range(900):
        signal = random.random()
        late = random.random() < (0.9 if signal > 0.5 else 0.1)
        rows.append(
            (int(late), float(random.randint(16, 60) if late else random.randint(0, 15)),
             str(start + timedelta(minutes=i)) + "+00:00", signal if i % 20 else None, random.random(),
             random.choice(["a", "b", None]), random.randint(0, 20))
        )
    df = spark.createDataFrame(
        rows,
        "is_delayed int, dep_delay_min double, dep_scheduled_utc string, signal double, noise double, cat string, notam_count_dep int",
    )
    return models.model_frame(cleaning.prepare_features(df))


@pytest.fixture(scope="module")
def fitted(frame):
    train = frame.on(models.balanced(frame.rows.where("minutes is not null")))
    return train, models.fit(train, models.forest_classifier(**SMALL))


def test_balanced_weights(fitted):
    sums = fitted[0].rows.groupBy("y").agg(F.sum("weight").alias("w")).collect()
    assert sums[0]["w"] == pytest.approx(sums[1]["w"])


def test_threshold_tuning_and_signal(fitted):
    best, sweep = models.tune_threshold(fitted[0], models.forest_classifier(**SMALL))
    assert best["precision"] > 0.7 and sweep.count() == 181


def test_unknown_category_and_missing_values_are_scored(spark, fitted, tmp_path):
    train, model = fitted
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    rows = spark.createDataFrame(
        [(1, 0.9, "never seen", 4), (2, None, None, None)], "id int, signal double, cat string, notam_count_dep int"
    )
    expected = {"signal": "double", "noise": "double", "notam_count_dep": "double", "cat": "string"}
    late = models.delayed_rows(train)
    regressor = models.fit(late, models.forest_regressor(**SMALL))
    out = scoring.score(rows, expected, loaded, 0.5, regressor, carry=["id"]).orderBy("id").collect()
    assert len(out) == 2 and 0 <= out[1]["delay_probability"] <= 1
    assert out[0]["prediction_label"] == "delayed" and out[0]["risk_level"] in ("medium", "high")
    assert out[0]["predicted_delay_minutes_if_delayed"] > 15
    assert out[0]["top_factors"] == ["departure airport NOTAM activity"] and out[1]["top_factors"] == []


def test_prepared_rows_are_dealt_out(spark):
    cleaned, frame = modelling._prepared(spark, "/root/testdata/sf0.001")
    files = [cleaned.inputFiles(), frame.rows.inputFiles()]
    assert all(len(f) >= 4 for f in files)
    shares = [r["count"] for r in cleaned.groupBy(F.input_file_name()).count().collect()]
    assert len(shares) == 4 and max(shares) < sum(shares) / 2
    assert frame.rows.count() == sum(shares)


def test_too_few_delayed_rows(fitted):
    with pytest.raises(ValueError):
        models.delayed_rows(fitted[0], minimum=10_000)


def test_permuted_rows_change_one_feature_at_a_time(frame):
    rows = frame.rows
    both = models.permuted_rows(rows, ["noise", "signal"], 1)
    assert both.columns == ["_feature", *rows.columns]
    for name in ("noise", "signal"):
        shuffled = both.where(F.col("_feature") == name).drop("_feature")
        assert sorted(map(str, shuffled.select(name).collect())) == sorted(map(str, rows.select(name).collect()))
        assert sorted(map(str, shuffled.drop(name).collect())) == sorted(map(str, rows.drop(name).collect()))
    moved = both.where("_feature = 'noise'").select("tie", F.col("noise").alias("n")).join(rows, "tie")
    assert moved.where("n <> noise").count() > 800


def test_permutation_importance_finds_the_signal(fitted):
    train, model = fitted
    found = models.permutation_importance(model, train.rows, ["noise", "signal"], repeats=1)
    assert found[0]["feature"] == "signal" and found[0]["importance_mean"] > 0.1


def test_baselines_beat_the_majority(fitted):
    train, _ = fitted
    estimators = models.baseline_classifiers(200)
    trees = {n: replace(e, trees=20) for n, e in estimators.items() if isinstance(e, Settings)}
    rows = models.compare_classifiers(train, train.rows, trees, "baseline").collect()
    assert {r["model"] for r in rows[:2]} == {"Random Forest", "HistGradientBoosting"} and rows[2]["model"] == "Dummy most_frequent"
    assert rows[2]["roc_auc"] == pytest.approx(0.5) and rows[1]["roc_auc"] > 0.85


def test_random_search_is_seeded(fitted):
    assert models.sample_settings(models.FOREST_SPACE, 5) == models.sample_settings(models.FOREST_SPACE, 5)
    linear = lambda **s: LinearRegression(labelCol="log_minutes", featuresCol="features", maxIter=5, **s)
    found = models.random_search(
        models.delayed_rows(fitted[0]), linear, {"regParam": [0.1, 0.5]}, 2, "regressor", folds=2
    )
    assert len(found) == 2 and found[0]["score"] <= found[1]["score"]


def test_tree_search_scores_each_fold_with_models_of_earlier_rows(fitted, tmp_path, spark):
    train = fitted[0]
    space = {"trees": [5], "depth": [1, 4], "balanced": [False, True]}
    found = models.search_trees(train, "forest", space, 4, "y", folds=2)
    assert len(found) == 4 and found == models.search_trees(train, "forest", space, 4, "y", folds=2)
    assert found[0]["score"] >= found[-1]["score"] and found[0]["score"] > 0.8
    # One setting by hand: a fit on the earlier folds, average precision on the fold.
    marked = expanding_folds(train.rows, "order", "tie", 2)
    binning = fit_binning(marked, train.numeric, train.categorical)
    scores = []
    for fold in (1, 2):
        table = bin_rows(marked.where(F.col("fold") < fold), binning, "y")
        model = fit_units(table, [Unit(Settings("forest", "log", 5, depth=4, balanced=True))])[0]
        scored = model.score(marked.where(F.col("fold") == fold), "p")
        scores.append(ranking_metrics(scored.select("y", "p")).first()["pr_auc"])
    mine = next(r["score"] for r in found if r["depth"] == 4 and r["balanced"])
    assert mine == pytest.approx(sum(scores) / 2, abs=1e-6)
    minutes = models.search_trees(models.delayed_rows(train), "boosting", {"trees": [5], "rate": [0.1, 0.3], "leaves": [4]}, 2, "log_minutes", folds=2)
    assert [r["rate"] for r in minutes] and minutes[0]["score"] <= minutes[1]["score"] < 60
    best = models.refitted(train, "forest", "y", found)
    best.save(spark, str(tmp_path / "best"))
    again = BinnedModel.load(spark, str(tmp_path / "best"))
    assert [r.p for r in again.score(train.rows, "p").collect()] == [r.p for r in best.score(train.rows, "p").collect()]


def test_linear_models_score_in_a_session_that_observes(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    spark = spark.newSession()
    spark._jsparkSession.observationManager()
    rows = spark.createDataFrame([(float(i), i % 3 > 0, float(i)) for i in range(30)], "x double, late boolean, log_minutes double")
    rows = rows.withColumn("y", F.col("late").cast("int"))
    made = [VectorAssembler(inputCols=["x"], outputCol="features")]
    model = Pipeline(stages=[*made, LogisticRegression(labelCol="y")]).fit(rows)
    assert all(0 < r.p < 1 for r in models.with_probability(model, rows).collect())
    linear = Pipeline(stages=[*made, LinearRegression(labelCol="log_minutes")]).fit(rows)
    assert models.with_minutes(linear, rows).count() == 30
    assert model.stages[-1].hasSummary and linear.stages[-1].hasSummary
