"""Fills learned inside a pipeline, against plain medians and counts."""

import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from slotwise.plans import models
from slotwise.plans.evaluate import classifier_metrics, ranking_metrics
from slotwise.plans.fills import ExactFills

SCHEMA = "id int, number double, whole long, `odd.name` double, word string, empty string, nothing double"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [
        (i, rng.choice([None, float("nan"), rng.random(), 0.25]), rng.choice([None, rng.randint(0, 9)]), rng.random(),
         rng.choice(["b", "a", "it's \\ so", None]), None, None)
        for i in range(400)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def plain_fills(data):
    known = {c: [r[c] for r in data if r[c] is not None and not math.isnan(r[c])] for c in ("number", "whole", "odd.name")}
    words = Counter(r["word"] for r in data if r["word"] is not None)
    return {c: float(statistics.median(v)) for c, v in known.items()}, min(words, key=lambda w: (-words[w], w))


def test_fitted_values_are_exact_and_survive_saving(spark, rows, tmp_path):
    numeric, categorical = ["number", "whole", "odd.name", "nothing"], ["word", "empty"]
    early = rows.where("id < 251")
    Pipeline(stages=[ExactFills(numeric=numeric, categorical=categorical)]).fit(early).save(str(tmp_path / "fills"))
    loaded = PipelineModel.load(str(tmp_path / "fills"))
    medians, mode = plain_fills(early.collect())
    stage = loaded.stages[0]
    assert stage.getOrDefault("medians") == [*(medians[c] for c in numeric[:3]), 0.0]
    assert stage.getOrDefault("modes") == [mode, ""]
    for r in loaded.transform(rows).collect():
        for c, v in medians.items():
            missing = r[c] is None or math.isnan(r[c])
            assert r[f"{c}__num"] == (v if missing else float(r[c]))
        assert r["word__cat"] == (mode if r["word"] is None else r["word"])
        assert r["nothing__num"] == 0.0 and r["empty__cat"] == ""


def test_most_frequent_value_of_a_tie_is_the_smallest(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "word string")
    assert ExactFills(categorical=["word"]).fit(rows).getOrDefault("modes") == ["a"]


def test_rows_without_columns_or_rows(spark, rows):
    nothing = rows.where("id < 0")
    model = ExactFills(numeric=["number"], categorical=["word"]).fit(nothing)
    assert model.getOrDefault("medians") == [0.0] and model.getOrDefault("modes") == [""]
    assert model.transform(nothing).count() == 0
    assert ExactFills().fit(rows).transform(rows).columns == rows.columns


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(8)
    data = [(float(x), int(x + rng.gauss(0, 0.5) > 0)) for x in (rng.uniform(-2, 2) for _ in range(300))]
    return spark.createDataFrame(data, "x double, y int")


def test_margins_become_probabilities(points):
    parts = [VectorAssembler(inputCols=["x"], outputCol="features")]
    margin = Pipeline(stages=[*parts, LinearSVC(labelCol="y")]).fit(points)
    raw = {r["x"]: r["rawPrediction"][1] for r in margin.transform(points).collect()}
    for r in models.with_probability(margin, points).collect():
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-raw[r["x"]])))
    low, high = min(raw.values()), max(raw.values())
    scaled = models.with_probability(margin, points, scaled=True)
    assert scaled.columns == ["x", "y", "p"]
    for r in scaled.collect():
        assert r["p"] == pytest.approx((raw[r["x"]] - low) / (high - low))
    both = [ranking_metrics(models.with_probability(margin, points, scaled=s)).first()["roc_auc"] for s in (False, True)]
    assert both[0] == pytest.approx(both[1])


def test_probabilities_are_taken_as_they_are(points):
    parts = [VectorAssembler(inputCols=["x"], outputCol="features")]
    model = Pipeline(stages=[*parts, LogisticRegression(labelCol="y")]).fit(points)
    known = {r["x"]: r["probability"][1] for r in model.transform(points).collect()}
    assert {r["x"]: r["p"] for r in models.with_probability(model, points, scaled=True).collect()} == known


def test_grouped_measures_equal_those_of_each_group(spark):
    rng = random.Random(3)
    data = [(rng.choice("abc"), rng.randint(0, 1), rng.choice([0.1, 0.5, 0.50001, 0.9, rng.random()])) for _ in range(500)]
    rows = spark.createDataFrame(data, "model string, y int, p double")
    found = {r["model"]: r.asDict() for r in classifier_metrics(rows, 0.5, ["model"]).collect()}
    for name in "abc":
        mine = [(y, p) for m, y, p in data if m == name]
        alone = classifier_metrics(rows.where(F.col("model") == name).drop("model"), 0.5).first().asDict()
        for measure, value in alone.items():
            assert found[name][measure] == pytest.approx(value)
        pairs = [(a, b) for ya, a in mine if ya for yb, b in mine if not yb]
        wins = sum((a > b) + (a == b) / 2 for a, b in pairs)
        assert alone["roc_auc"] == pytest.approx(wins / len(pairs))
        assert alone["brier"] == pytest.approx(sum((p - y) ** 2 for y, p in mine) / len(mine))
        assert alone["tp"] == sum(y == 1 and p >= 0.5 for y, p in mine)
        assert alone["fp"] == sum(y == 0 and p >= 0.5 for y, p in mine)


def test_measures_of_no_rows(spark):
    found = classifier_metrics(spark.createDataFrame([], "y int, p double"), 0.5).first()
    assert (found["tn"], found["fp"], found["fn"], found["tp"]) == (0, 0, 0, 0)
    assert found["precision"] == 0 and found["brier"] is None


def test_leaderboard_puts_the_better_ranking_first(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.7), (0, 0.8)], "y int, p double")
    board = models.leaderboard({"worse": rows.selectExpr("y", "1 - p AS p"), "better": rows}, "tuned").collect()
    assert [(r["model"], r["stage"]) for r in board] == [("better", "tuned"), ("worse", "tuned")]
