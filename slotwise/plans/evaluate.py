"""Evaluation of scored rows.

Inputs carry the truth ``y`` (0/1), the probability ``p`` and, where minutes are
judged, ``minutes`` and ``pred_min``. Every measure is a sum over distinct scores
or over all rows; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.operators.ranks import median, running_sums, value_counts

# Threshold grid and selection limits (fixed values).
GRID_START, GRID_STOP, GRID_SIZE = 0.05, 0.95, 181
MIN_RECALL = 0.25
MIN_POSITIVE_RATE = 0.03
_STEP = (GRID_STOP - GRID_START) / (GRID_SIZE - 1)


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def classification_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def confusion(scored: DataFrame, predicted: Column, groups: list[str] = ()) -> DataFrame:
    """TN, FP, FN, TP with false positive and false negative rates."""
    y = F.col("y")
    counts = scored.groupBy(*groups).agg(
        F.count_if((y == 0) & (predicted == 0)).alias("tn"),
        F.count_if((y == 0) & (predicted == 1)).alias("fp"),
        F.count_if((y == 1) & (predicted == 0)).alias("fn"),
        F.count_if((y == 1) & (predicted == 1)).alias("tp"),
    )
    return counts.withColumns(
        {
            "false_positive_rate": F.try_divide(F.col("fp"), F.col("fp") + F.col("tn")),
            "false_negative_rate": F.try_divide(F.col("fn"), F.col("fn") + F.col("tp")),
        }
    )


def score_counts(scored: DataFrame, groups: list[str] = ()) -> DataFrame:
    """Rows and positives per distinct score."""
    return value_counts(scored, list(groups), "p", pos=F.col("y"))


def _ranking_columns() -> list[Column]:
    """ROC-AUC and average precision as sums over ranked score counts."""
    pos, neg = F.col("pos"), F.col("n") - F.col("pos")
    total_pos = F.col("total_pos").cast("double")
    total_neg = F.col("total_n") - total_pos
    above = F.col("total_pos") - F.col("cum_pos")
    reached = F.col("total_n") - F.col("cum_n") + F.col("n")
    hits = above + pos
    return [
        F.sum(F.try_divide(neg * (above + pos / 2), total_pos * total_neg)).alias("roc_auc"),
        F.sum(F.try_divide(pos / total_pos * hits, reached)).alias("pr_auc"),
    ]


def _ranked_scores(scored: DataFrame, groups: list[str]) -> DataFrame:
    return running_sums(score_counts(scored, groups), groups, "p", ["n", "pos"])


def ranking_metrics(scored: DataFrame, groups: list[str] = ()) -> DataFrame:
    """Tie-aware ROC-AUC and step-wise average precision."""
    groups = list(groups)
    return _ranked_scores(scored, groups).groupBy(*groups).agg(*_ranking_columns())


def classifier_metrics(scored: DataFrame, threshold: float, groups: list[str] = ()) -> DataFrame:
    """Every classification measure at a threshold, one row per group.

    All of them are sums over the rows and positives per distinct score, so the scored
    rows are read once.
    """
    groups = list(groups)
    p, pos, neg = F.col("p"), F.col("pos"), F.col("n") - F.col("pos")
    reached = p >= F.lit(threshold)
    squares = neg * F.pow(p, 2.0) + pos * F.pow(1 - p, 2.0)
    known = F.sum(F.when(p.isNotNull(), F.col("n")))

    def total(condition: Column, count: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, count)), F.lit(0))

    sums = _ranked_scores(scored, groups).groupBy(*groups).agg(
        *_ranking_columns(),
        F.try_divide(F.sum(squares), known).alias("brier"),
        total(~reached, neg).alias("tn"),
        total(reached, neg).alias("fp"),
        total(~reached, pos).alias("fn"),
        total(reached, pos).alias("tp"),
    )
    measures = classification_columns(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return sums.select(
        *groups,
        F.lit(float(threshold)).alias("threshold"),
        "roc_auc", "pr_auc",
        *[c.alias(name) for name, c in measures.items()],
        "brier", "tn", "fp", "fn", "tp",
    )


def grid_threshold(index: Column) -> Column:
    return F.lit(GRID_START) + index * F.lit(_STEP)


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Measures at every grid threshold from one histogram of the scores.

    A row counts for all thresholds up to its own index, so the table is the
    reverse running sum over at most 182 histogram rows.
    """
    guess = F.floor((F.col("p") - GRID_START) / _STEP).cast("int")
    near = F.filter(
        F.array(guess + 1, guess, guess - 1), lambda i: grid_threshold(i) <= F.col("p")
    )
    index = F.greatest(F.least(F.element_at(near, 1), F.lit(GRID_SIZE - 1)), F.lit(-1))
    histogram = scored.groupBy(index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")
    )
    # One array of at most 182 structs; each threshold sums the bins at or above it.
    bins = histogram.agg(F.collect_list(F.struct("bin", "n", "pos")).alias("bins"))
    rows = bins.select("bins", F.explode(F.sequence(F.lit(0), F.lit(GRID_SIZE - 1))).alias("i"))

    def total(name: str, reached: bool) -> Column:
        kept = F.filter("bins", lambda b: b["bin"] >= F.col("i")) if reached else F.col("bins")
        return F.aggregate(kept, F.lit(0).cast("long"), lambda a, b: a + b[name])

    tp, predicted = total("pos", True), total("n", True)
    counted = rows.select(
        "i", tp.alias("tp"), predicted.alias("pp"),
        total("pos", False).alias("pos"), total("n", False).alias("n"),
    )
    fp, fn = F.col("pp") - F.col("tp"), F.col("pos") - F.col("tp")
    tn = F.col("n") - F.col("pp") - fn
    measures = classification_columns(F.col("tp"), fp, fn, tn)
    return counted.select(
        F.col("i").cast("long").alias("threshold_index"),
        grid_threshold(F.col("i")).alias("threshold"),
        measures["precision"].alias("precision"),
        measures["recall"].alias("recall"),
        measures["f1"].alias("f1"),
        F.col("pp").alias("predicted_positive_count"),
        (F.col("pp") / F.col("n")).alias("predicted_positive_rate"),
        F.col("tp").alias("true_positive_count"),
        fp.alias("false_positive_count"),
        fn.alias("false_negative_count"),
    )


def eligible_thresholds(
    sweep: DataFrame, min_recall: float = MIN_RECALL, min_rate: float = MIN_POSITIVE_RATE
) -> DataFrame:
    return sweep.where(
        (F.col("recall") >= min_recall) & (F.col("predicted_positive_rate") >= min_rate)
    )


def top_thresholds(sweep: DataFrame, k: int = 10, **limits: float) -> DataFrame:
    order = ["precision", "recall", "f1", "predicted_positive_rate"]
    return (
        eligible_thresholds(sweep, **limits)
        .orderBy(*[F.desc(c) for c in order], F.asc("threshold_index"))
        .limit(k)
    )


def best_threshold(sweep: DataFrame, **limits: float) -> dict:
    best = top_thresholds(sweep, 1, **limits).first()
    if best is None:
        raise ValueError("no threshold reaches the wanted recall and positive rate")
    return best.asDict()


def regression_metrics(scored: DataFrame, groups: list[str] = ()) -> DataFrame:
    """MAE, median absolute error, RMSE and R2 of predictions clipped at zero."""
    groups = list(groups)
    error = F.greatest(F.col("pred_min"), F.lit(0)) - F.col("minutes")
    judged = scored.select(*groups, F.col("minutes"), error.cast("double").alias("_e"), F.abs(error).alias("_ae"))
    spread = F.var_pop("minutes") * F.count("minutes")
    sums = judged.groupBy(*groups).agg(
        F.count("_e").alias("rows"),
        F.avg("_ae").alias("mae"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse"),
        (1 - F.try_divide(F.sum(F.col("_e") * F.col("_e")), spread)).alias("r2"),
    )
    middle = median(judged, groups, "_ae").withColumnRenamed("median", "median_absolute_error")
    if groups:
        return sums.join(middle, groups)
    return sums.withColumn("median_absolute_error", middle.scalar())


def two_stage_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    """How many late trips reach the second stage, and the error with and without them."""
    late = F.col("y") == 1
    passed = late & (F.col("p") >= F.lit(threshold))
    minutes = F.greatest(F.col("pred_min"), F.lit(0)).cast("double")
    error = F.abs(F.when(F.col("p") >= F.lit(threshold), minutes).otherwise(0.0) - F.col("minutes"))
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(late).alias("actual_delayed_rows"),
        F.count_if(passed).alias("passed_rows"),
        F.try_divide(F.count_if(passed), F.count_if(late)).alias("coverage"),
        F.avg(F.when(passed, error)).alias("covered_mae"),
        F.avg(F.when(late, error)).alias("two_stage_mae"),
    )


def class_report(scored: DataFrame, predicted: Column) -> DataFrame:
    """Precision, recall, F1 and support for both labels."""
    pred = scored.select("y", predicted.cast("int").alias("_pred"))
    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("label")
    is_true, is_pred = F.col("y") == F.col("label"), F.col("_pred") == F.col("label")
    counts = pred.groupBy("y", "_pred").count().select("*", sides).groupBy("label").agg(
        F.sum(F.when(is_true & is_pred, F.col("count")).otherwise(0)).alias("tp"),
        F.sum(F.when(~is_true & is_pred, F.col("count")).otherwise(0)).alias("fp"),
        F.sum(F.when(is_true & ~is_pred, F.col("count")).otherwise(0)).alias("fn"),
    )
    m = classification_columns(F.col("tp"), F.col("fp"), F.col("fn"), F.lit(0))
    return counts.select(
        "label", m["precision"].alias("precision"), m["recall"].alias("recall"),
        m["f1"].alias("f1"), (F.col("tp") + F.col("fn")).alias("support"),
    )


def rank_models(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Rank of every model per measure, best first, equal values share the better rank."""
    from pyspark.sql import Window

    # One row per model, a handful by nature.
    return metrics.select(
        "model", *[F.rank().over(Window.orderBy(F.desc(c))).alias(f"{c}_rank") for c in columns]
    )


def stage_pivot(metrics: DataFrame, measure: str) -> DataFrame:
    """Best value per model family and stage."""
    family = F.replace(F.col("model"), F.lit("Tuned "), F.lit(""))
    return (
        metrics.where("model <> 'Dummy most_frequent'")
        .groupBy(family.alias("model_family"))
        .pivot("stage", ["baseline", "tuned"])
        .agg(F.max(measure))
    )


def min_max_scores(scores: DataFrame, score: str) -> DataFrame:
    """Margins scaled to [0, 1]; 0.5 when all are equal."""
    span = scores.agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    return scores.withColumn(
        "p", F.coalesce(F.try_divide(F.col(score) - lo, hi - lo), F.lit(0.5))
    )
