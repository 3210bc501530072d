"""Splits, metrics, drift and search against direct formulas."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.plans import drift, evaluate, explore, scoring, splits


@pytest.fixture(scope="module")
def sample():
    random.seed(4)
    p = [random.choice([0.05, 0.3, 0.685, 0.95, 1.0, 0.0, round(random.random(), 3)]) for _ in range(600)]
    y = [int(random.random() < 0.3 + 0.4 * v) for v in p]
    return pd.DataFrame({"y": y, "p": p, "minutes": [random.randint(0, 90) * 1.0 for _ in p], "pred_min": [random.randint(-5, 90) * 1.0 for _ in p]})


@pytest.fixture(scope="module")
def scored(spark, sample):
    return spark.createDataFrame(sample).withColumn("y", F.col("y").cast("int"))


def test_auc_and_average_precision(scored, sample):
    got = evaluate.ranking_metrics(scored).first()
    pos, neg = sample[sample.y == 1].p.values, sample[sample.y == 0].p.values
    pairs = pos[:, None] - neg[None, :]
    assert got["roc_auc"] == pytest.approx(((pairs > 0).sum() + 0.5 * (pairs == 0).sum()) / pairs.size)
    ap, seen = 0.0, 0.0
    for t in sorted(sample.p.unique(), reverse=True):
        chosen = sample[sample.p >= t]
        recall = chosen.y.sum() / sample.y.sum()
        ap += (recall - seen) * chosen.y.mean()
        seen = recall
    assert got["pr_auc"] == pytest.approx(ap)


def test_sweep_equals_direct_counts(scored, sample):
    got = {r["threshold_index"]: r for r in evaluate.threshold_sweep(scored).collect()}
    grid = np.linspace(0.05, 0.95, 181)
    assert len(got) == 181
    for i, t in enumerate(grid):
        chosen = sample[sample.p >= t]
        assert got[i]["threshold"] == t
        assert got[i]["predicted_positive_count"] == len(chosen)
        assert got[i]["true_positive_count"] == chosen.y.sum()
        assert got[i]["false_negative_count"] == sample.y.sum() - chosen.y.sum()
        assert got[i]["precision"] == (chosen.y.mean() if len(chosen) else 0)


def test_best_threshold_or_error(scored):
    sweep = evaluate.threshold_sweep(scored)
    best = evaluate.best_threshold(sweep)
    assert best["recall"] >= 0.25 and best["predicted_positive_rate"] >= 0.03
    better = sweep.where((F.col("recall") >= 0.25) & (F.col("precision") > best["precision"]) & (F.col("predicted_positive_rate") >= 0.03))
    assert better.count() == 0
    with pytest.raises(ValueError):
        evaluate.best_threshold(sweep, min_recall=1.1)


def test_classifier_metrics_with_nothing_predicted(scored):
    row = evaluate.classifier_metrics(scored, 2.0).first()
    assert (row["precision"], row["recall"], row["f1"], row["tp"], row["fp"]) == (0, 0, 0, 0, 0)


def test_regression_metrics(scored, sample):
    got = evaluate.regression_metrics(scored).first()
    error = sample.pred_min.clip(lower=0) - sample.minutes
    assert got["mae"] == pytest.approx(error.abs().mean())
    assert got["median_absolute_error"] == pytest.approx(error.abs().median())
    assert got["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert got["r2"] == pytest.approx(1 - (error**2).sum() / ((sample.minutes - sample.minutes.mean()) ** 2).sum())


def test_two_stage(scored, sample):
    got = evaluate.two_stage_metrics(scored, 0.5).first()
    late, passed = sample.y == 1, (sample.y == 1) & (sample.p >= 0.5)
    minutes = sample.pred_min.clip(lower=0)
    assert got["passed_rows"] == passed.sum() and got["coverage"] == pytest.approx(passed.sum() / late.sum())
    assert got["covered_mae"] == pytest.approx((minutes - sample.minutes)[passed].abs().mean())
    assert got["two_stage_mae"] == pytest.approx((minutes.where(sample.p >= 0.5, 0) - sample.minutes)[late].abs().mean())


def test_class_report_sums_to_rows(scored, sample):
    rows = evaluate.class_report(scored, F.col("p") >= 0.5).collect()
    assert sum(r["support"] for r in rows) == len(sample) and {r["label"] for r in rows} == {0, 1}


def test_min_max_scores(spark):
    same = spark.createDataFrame([(3.0,), (3.0,)], "s double")
    assert {r["p"] for r in evaluate.min_max_scores(same, "s").collect()} == {0.5}
    wide = spark.createDataFrame([(-1.0,), (0.0,), (3.0,)], "s double")
    assert sorted(r["p"] for r in evaluate.min_max_scores(wide, "s").collect()) == [0.0, 0.25, 1.0]


def times(spark, seconds):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seconds)], "id long, s long")
    return df.withColumn("ts", F.timestamp_seconds("s"))


def test_split_keeps_equal_times_together(spark):
    seconds = [1, 2, 3, 4, 5, 6, 7, 8, 8, 10]
    train, test, cutoff = splits.chronological_split(times(spark, seconds), "ts")
    assert cutoff == 8_000_000
    assert sorted(r["s"] for r in train.collect()) == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(r["s"] for r in test.collect()) == [8, 8, 10]


@pytest.mark.parametrize("seconds, size", [([5] * 10, 0.2), ([1], 0.2), ([1, 2], 1.5)])
def test_split_errors(spark, seconds, size):
    with pytest.raises(ValueError):
        splits.chronological_split(times(spark, seconds), "ts", size)


def test_positional_split_and_folds(spark):
    random.seed(8)
    seconds = [random.choice([3, 3, 3, random.randint(0, 50)]) for _ in range(53)]
    df = times(spark, seconds)
    order = [i for _, i in sorted((s, i) for i, s in enumerate(seconds))]
    early, late = splits.positional_split(df, "s", "id", 0.8)
    assert sorted(r["id"] for r in early.collect()) == sorted(order[:42])
    assert early.count() + late.count() == 53
    folds = {r["id"]: r["fold"] for r in splits.expanding_folds(df, "s", "id", 4).collect()}
    expected = [0] * (53 - 40) + [f for f in range(1, 5) for _ in range(10)]
    assert [folds[i] for i in order] == expected


def test_ks_is_symmetric_and_exact(spark):
    random.seed(10)
    a = [random.gauss(0, 1) for _ in range(200)]
    b = [random.choice([0.0, 0.0, random.gauss(0.4, 1)]) for _ in range(150)]
    rows = [("train", v) for v in a] + [("test", v) for v in b] + [("train", None)]
    df = spark.createDataFrame(rows, "split string, v double")
    one = drift.numeric_drift(df, ["v"], "split", "train", "test").first()
    two = drift.numeric_drift(df, ["v"], "split", "test", "train").first()
    grid = np.array(sorted(a + b))
    want = np.abs(np.searchsorted(np.sort(a), grid, "right") / 200 - np.searchsorted(np.sort(b), grid, "right") / 150).max()
    assert one["ks_stat"] == pytest.approx(want) == pytest.approx(two["ks_stat"])
    assert one["train_median"] == pytest.approx(np.median(a)) and one["test_mean"] == pytest.approx(np.mean(b))


def test_exact_ks_p_value_equals_enumeration(spark):
    def enumerated(d, n, m):
        """Share of all orders of n and m values whose statistic is at least ``d``."""
        hits = total = 0
        for chosen in itertools.combinations(range(n + m), n):
            x = y = most = 0
            for k in range(n + m):
                x, y = (x + 1, y) if k in chosen else (x, y + 1)
                most = max(most, abs(x * m - y * n))
            total, hits = total + 1, hits + (most >= round(d * n * m))
        return hits / total

    rows = [(abs(x / n - y / m), n, m) for n, m in ((1, 1), (3, 3), (2, 5), (6, 4), (5, 7)) for x in range(n + 1) for y in range(m + 1)]
    df = spark.createDataFrame(rows, "s double, n long, m long")
    got = [r[0] for r in df.select(drift.exact_ks_p_value(F.col("s"), F.col("n"), F.col("m"))).collect()]
    assert got == pytest.approx([enumerated(*r) for r in rows], abs=1e-12)


def test_ks_by_group_takes_the_exact_value_up_to_its_bound(spark):
    rows = [("a", s, float(v)) for s, vs in (("train", [1, 2, 3, 4]), ("test", [3.5, 5, 6])) for v in vs]
    rows += [("b", "train", float(i)) for i in range(9)] + [("b", "test", i + 0.5) for i in range(4)] + [("c", "train", 1.0), (None, "train", 1.0), (None, "test", 2.0)]
    df = spark.createDataFrame(rows, "g string, split string, v double")
    got = {r["g"]: r for r in drift.ks_by_group(df, ["g"], "v", "split", "train", "test", exact_rows=5).collect()}
    assert set(got) == {"a", "b", None} and [got[g]["exact"] for g in ("a", "b", None)] == [True, False, True]
    assert got["a"]["ks_stat"] == 0.75 and got["a"]["ks_p_value"] == pytest.approx(8 / 35)
    assert (got["b"]["train_rows"], got["b"]["test_rows"], got[None]["ks_p_value"]) == (9, 4, 1.0)


def test_p_values(spark):
    rows = [(0.0, 10, 10), (0.9, 100, 100), (0.1923, 100, 100), (1.0, 0, 5)]
    df = spark.createDataFrame(rows, "s double, n long, m long")
    p = [r[0] for r in df.select(drift.ks_p_value(F.col("s"), F.col("n"), F.col("m"))).collect()]
    assert p[0] == 1.0 and p[1] < 1e-6 and p[2] == pytest.approx(0.05, abs=2e-3)
    # Tabled critical values of the correlation at 5 %, two-sided.
    rows = [(0.57598, 12), (-0.19460, 102), (0.9969, 3), (0.0, 50), (0.5, 2), (0.3, 100000)]
    df = spark.createDataFrame(rows, "r double, n long")
    p = [r[0] for r in df.select(explore.correlation_p_value(F.col("r"), F.col("n"))).collect()]
    assert p[:4] == pytest.approx([0.05, 0.05, 0.05, 1.0], abs=1e-3) and p[4] is None and p[5] == 0.0


def test_category_shift(spark):
    rows = [("train", "a")] * 3 + [("train", None)] + [("test", "a")] * 2 + [("test", "b")] * 2
    df = spark.createDataFrame(rows, "split string, c string")
    got = drift.categorical_shift(df, ["c"], "split", "train", "test").first()
    assert (got["n_train_categories"], got["n_test_categories"], got["unseen_categories_in_test"]) == (2, 2, 1)
    assert got["total_variation_distance"] == pytest.approx(0.5)
    unseen = drift.unseen_categories(df.where("split = 'train'"), df.where("split = 'test'"), "c")
    assert [r["c"] for r in unseen.collect()] == ["b"]


def test_equal_width_bins_of_one_value(spark):
    for value in (0, -4):
        df = spark.createDataFrame([(value, True), (value, False)], "v int, late boolean")
        got = explore.equal_width_rates(df, "v", F.col("late"), 4).orderBy("bin").collect()
        assert [r.rows for r in got] == [0, 2, 0, 0] and got[1].delay_rate == 0.5 and got[0].low < value < got[3].high


def test_equal_width_bins_match_pandas(spark):
    random.seed(12)
    values = [random.random() * 700 for _ in range(300)] + [0.0, 700.0, None]
    late = [random.random() < 0.5 for _ in values]
    df = spark.createDataFrame(list(zip(values, late)), "v double, late boolean")
    got = explore.equal_width_rates(df, "v", F.col("late")).orderBy("bin").collect()
    frame = pd.DataFrame({"v": values, "late": late}).dropna()
    want = frame.groupby(pd.cut(frame.v, bins=8), observed=False)["late"].agg(["mean", "count"])
    assert [r["rows"] for r in got] == want["count"].tolist()
    assert [r["delay_rate"] for r in got] == pytest.approx(want["mean"].tolist())


def test_search_and_row_lookup(spark):
    df = spark.createDataFrame(
        [("KC1", "ALA", "OTHER", 3, 30), ("KC2", "ALA", "IST", 1, 10), ("TK.1", "GUW", "IST", 1, 20), ("TK1", None, "IST", 2, 40)],
        "flight_iata string, dep_iata string, arr_iata_grp string, dep_scheduled_utc int, tie int",
    )
    find = lambda **w: [r["flight_iata"] for r in scoring.search(df, ["dep_scheduled_utc", "tie"], 10, **w).collect()]
    assert find(dep_iata="la") == ["KC2", "KC1"]
    assert find(flight_iata="k.1") == ["TK.1"]
    assert find(arr_iata="ist", flight_iata="TK") == ["TK.1", "TK1"]
    assert find(route="x") == []
    assert find() == ["KC2", "TK.1", "TK1", "KC1"]
    at = lambda n: scoring.row_at(df.withColumn("o", F.col("dep_scheduled_utc").cast("long")).withColumn("t", F.col("tie").cast("long")), "o", "t", n)
    assert [at(n).first()["flight_iata"] for n in range(4)] == ["KC2", "TK.1", "TK1", "KC1"]
    for n in (-1, 4):
        with pytest.raises(IndexError):
            at(n)


def test_align(spark):
    df = spark.createDataFrame([(1, "x", "gone")], "a int, b string, c string")
    out = scoring.align(df, {"b": "string", "a": "double", "z": "double"})
    assert out.columns == ["b", "a", "z"] and tuple(out.first()) == ("x", 1.0, None)
